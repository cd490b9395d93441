"""Byte-pair merges of many words at once, in rounds over flat numpy arrays.

The symbols of all words lie in one flat array. A round finds the least rank
among the pairs of each word, merges the leftmost of the word's pairs of that
rank at once, closes the gaps and sets finished words aside, until no pair is
left. Only a word that needs more than ``ROUNDS`` rounds is finished from a
queue. The result is that of merging one pair at a time, the leftmost of least
rank.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np

NEVER = np.iinfo(np.int32).max
GONE = np.iinfo(np.int32).min
# a word open after so many rounds, such as a thousand spaces, is finished pair by pair
ROUNDS = 256


def sooner_of(size: int, keys: np.ndarray, rank: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Symbols whose making can bring about a pair that comes before the others of its rank."""
    latest, soonest = np.full(size, -1, np.int32), np.full(size, NEVER, np.int32)
    np.maximum.at(latest, made, rank)
    np.minimum.at(soonest, keys // size, rank)
    np.minimum.at(soonest, keys % size, rank)
    return soonest <= latest


class Merger:
    """Merges by a table of pairs: ``keys`` are ``left * size + right``, sorted, with the rank and the symbol made."""

    def __init__(self, size: int, keys: np.ndarray, rank: np.ndarray, made: np.ndarray, sooner: np.ndarray) -> None:
        self.size, self.keys, self.rank, self.made, self.sooner = size, keys, rank, made, sooner

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and the piece it makes; ``NEVER`` if it makes none."""
        key = left.astype(np.int64) * self.size + right
        if not len(self.keys):
            return np.full(len(key), NEVER, np.int32), np.zeros(len(key), np.int32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER), self.made[at]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of words given as flat letters, and the word of each, ordered by word."""
        done_symbols, done_words = [], []
        same = np.append(word[1:] == word[:-1], False)
        rank, made = np.full(len(symbols), NEVER, np.int32), np.zeros(len(symbols), np.int32)
        asked = np.flatnonzero(same)
        rank[asked], made[asked] = self.pairs(symbols[asked], symbols[asked + 1])
        for turn in itertools.count():
            if not len(symbols):
                break
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            if turn == ROUNDS:
                for part, of in zip(np.split(symbols, first[1:]), word[first].tolist()):
                    done_symbols.append(self._in_order(part.tolist()))
                    done_words.append(np.full(len(done_symbols[-1]), of, word.dtype))
                break
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.minimum.reduceat(rank, first)
            open_ = np.repeat(least < NEVER, sizes)
            if not open_.all():  # compaction: finished words leave
                done_symbols.append(symbols[~open_])
                done_words.append(word[~open_])
                symbols, word, rank, made = symbols[open_], word[open_], rank[open_], made[open_]
                least, sizes = least[least < NEVER], sizes[least < NEVER]
                if not len(symbols):
                    break
            hit = rank == np.repeat(least, sizes)
            # of a row of pairs that overlap, the first, third and so on; a pair of the next word starts a new row
            place = np.arange(len(symbols))
            starts = hit & ~np.append(False, hit[:-1])
            chosen = np.flatnonzero(hit & ((place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 0))
            chosen = self._first_only(chosen, symbols, word, rank, made)
            symbols[chosen] = made[chosen]
            kept = np.ones(len(symbols), bool)
            kept[chosen + 1] = False
            touched = np.zeros(len(symbols), bool)
            touched[chosen] = True
            symbols, word, rank, made, touched = symbols[kept], word[kept], rank[kept], made[kept], touched[kept]
            same = np.append(word[1:] == word[:-1], False)
            changed = touched | np.append(touched[1:], False)
            rank[changed & ~same] = NEVER
            asked = np.flatnonzero(changed & same)
            rank[asked], made[asked] = self.pairs(symbols[asked], symbols[asked + 1])
        symbols = np.concatenate(done_symbols) if done_symbols else symbols
        word = np.concatenate(done_words) if done_words else word
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _in_order(self, symbols: list[int]) -> np.ndarray:
        """Final symbols of one word, merged pair by pair from a queue."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def pair(at: int) -> None:
            if at < 0 or after[at] >= len(symbols):
                return
            key = symbols[at], symbols[after[at]]
            if key not in known:
                rank, made = self.pairs(np.array(key[:1]), np.array(key[1:]))
                known[key] = int(rank[0]), int(made[0])
            if known[key][0] < NEVER:
                heapq.heappush(queue, (known[key][0], at, *key))

        queue: list[tuple[int, int, int, int]] = []
        for at in range(len(symbols)):
            pair(at)
        while queue:
            _, at, left, right = heapq.heappop(queue)
            if symbols[at] != left or after[at] >= len(symbols) or symbols[after[at]] != right:
                continue  # one of the two has been merged since
            gone = after[at]
            symbols[at], after[at] = known[left, right][1], after[gone]
            symbols[gone] = GONE
            if after[at] < len(symbols):
                before[after[at]] = at
            pair(before[at])
            pair(at)
        return np.array([s for s in symbols if s != GONE], np.int32)

    def _first_only(self, chosen, symbols, word, rank, made) -> np.ndarray:
        """Of each word's merges those up to the first one that makes a pair of no higher rank, which then comes before the rest."""
        risky = np.flatnonzero(self.sooner[made[chosen]])
        if not len(risky):
            return chosen
        at = chosen[risky]
        now = rank[at]
        before = np.maximum(at - 1, 0)
        follows = np.zeros(len(symbols), np.int64)
        follows[chosen + 1] = 1
        merged_before = (at >= 2) & (follows[before] == 1)
        left = np.where(merged_before, made[np.maximum(at - 2, 0)], symbols[before])
        has_left = (at > 0) & (word[before] == word[at])
        after = np.minimum(at + 2, len(symbols) - 1)
        has_right = (at + 2 < len(symbols)) & (word[after] == word[at])
        sooner = (has_left & (self.pairs(left, made[at])[0] <= now)) | (has_right & (self.pairs(made[at], symbols[after])[0] <= now))
        if not sooner.any():
            return chosen
        stops = np.zeros(len(chosen), np.int64)
        stops[risky[sooner]] = 1
        word_of = word[chosen]
        begin = np.flatnonzero(np.append(True, word_of[1:] != word_of[:-1]))
        earlier = np.cumsum(stops) - stops  # stops before each merge, of all words
        earlier -= np.repeat(earlier[begin], np.diff(np.append(begin, len(chosen))))
        return chosen[earlier == 0]
