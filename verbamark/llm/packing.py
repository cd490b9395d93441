"""Packing of tokenised documents into windows of a fixed length, by minimum bin slack.

Every task packs the documents of its partition, so nothing is shuffled. Full
windows are cut off long documents; of the remainders, the longest one opens a
window and a subset-sum over the lengths at hand, kept as a bitset, tells how
close the others can come to filling it. The counts found on the way back are
used for as many windows as there are documents of these lengths.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.llm.merging import Merger, sooner_of

END_ID = 1
HOLD = 1 << 21
WORDS_KEPT = 400_000
BYTES_AT_ONCE = 1 << 21
# small letters below are their own normal form, and words of them one piece to the tokenizer
PLAIN = "\u0250"
WORD_END = "</w>"
CLOSING = r"([a-z0-9])([.,])([\x20\x09-\x0D]|$)"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = (b for b in range(256) if b not in seen)
    return [chr(b) if b in seen else chr(256 + k) for b, k in sorted([(b, 0) for b in seen] + [(b, k) for k, b in enumerate(others)])]


class Encoder:
    """Ids of texts by a tokenizer that lower-cases, never joins across white space and marks the ends of words.

    Each different word is encoded once and looked up from then on. To see
    fewer of them, letters A-Z are lower-cased and a closing point or comma is
    set apart first, which this kind of tokenizer does anyway. New words of
    small Latin letters are merged here, all at once; the others go to the
    tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        size = max(vocabulary.values()) + 1
        left, right, made = (np.array(x, np.int64) for x in zip(*[
            (vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]))
        keys, first = np.unique(left * size + right, return_index=True)
        rank = first.astype(np.int32)
        self.merger = Merger(size, keys, rank, made[first].astype(np.int32), sooner_of(size, keys, rank, made[first]))
        letters = _byte_letters()
        self.inner, self.last = (np.array([vocabulary[c + end] for c in letters], np.int32) for end in ("", WORD_END))
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha() and max(w) < PLAIN and w == w.lower()]
        known = set(plain)
        others = [w for w in words if w not in known]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        self.place.update(zip(plain + others, range(len(self.place), len(self.place) + len(words))))
        if plain:
            held = [w.encode() for w in plain]
            lengths = np.array([len(w) for w in held])
            letters = np.frombuffer(b"".join(held), np.uint8)
            symbols = self.inner[letters]
            ends = np.cumsum(lengths) - 1
            symbols[ends] = self.last[letters[ends]]
            ids, of = self.merger.merge(symbols, np.repeat(np.arange(len(plain), dtype=np.int32), lengths))
            self.ids.append(ids.astype(np.uint32))
            self.size.append(np.bincount(of, minlength=len(plain)).astype(np.int64))
        self.ids.append(np.array([k for f in found for k in f], np.uint32))
        self.size.append(np.array([len(f) for f in found], np.int64))

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        if len(self.place) > WORDS_KEPT:
            self._forget()
        coded = words.dictionary_encode()
        different = coded.dictionary.to_pylist()
        if new := [w for w in different if w not in self.place]:
            self._learn(new)
        self.ids, self.size = [np.concatenate(self.ids)], [np.concatenate(self.size)]
        size = self.size[0]
        start = np.cumsum(size) - size
        at = np.array([self.place[w] for w in different], np.int64)[np.asarray(coded.indices)]
        size, start = size[at], start[at]
        return self.ids[0][np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())], size

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text and its end id."""
        texts = pc.fill_null(texts, "")
        bounds = np.cumsum(np.asarray(pc.binary_length(texts), np.int64)) // BYTES_AT_ONCE
        cuts = np.flatnonzero(np.diff(bounds, prepend=0, append=-1))
        for first, last in zip([0, *cuts[:-1]], cuts):
            part = texts.slice(first, last - first)
            apart = pc.replace_substring_regex(pc.ascii_lower(part), CLOSING, r"\1 \2\3")
            # a special token's name must stay as it is
            words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(part, "<|"), part, apart))
            ids, size = self._encode(words.flatten()) if len(words.flatten()) else (np.zeros(0, np.uint32), np.zeros(0, int))
            ends = np.concatenate([[0], np.cumsum(size)])
            at = 0
            for n in words.value_lengths().to_pylist():
                yield np.append(ids[ends[at]:ends[at + n]], np.uint32(END_ID))
                at += n


def best_fill(counts: dict[int, int], room: int) -> tuple[dict[int, int], int]:
    """Lengths and how many of each, of those in ``counts``, that fill ``room`` best, and what stays free."""
    reach, steps, full = 1, [], 1 << room
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach & full:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & (full << 1) - 1
            left, take = left - take, 2 * take
        if reach & full:
            break
    total, chosen = reach.bit_length() - 1, {}
    slack = room - total
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen, slack


class Packer:
    """Collects documents of one partition and gives back rows of full windows."""

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window, self.sequence = window, first_sequence
        self.held: dict[int, list] = defaultdict(list)
        self.counts: Counter = Counter()
        self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self._emit([(doc_id, start, ids[start:start + self.window], len(ids))])
        if whole < len(ids):
            # a copy, as a view would hold the whole document
            self._hold((doc_id, whole, ids[whole:].copy(), len(ids)))

    def _hold(self, piece: tuple) -> None:
        n = len(piece[2])
        self.held[n].append(piece)
        self.counts[n] += 1
        self.tokens += n

    def _take(self, length: int) -> tuple:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length]
        self.tokens -= length
        return self.held[length].pop()

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def pack(self, until: int) -> None:
        """Fill windows until fewer than ``until`` tokens are held, or too few for a full one."""
        while self.tokens >= max(until, self.window):
            longest = max(self.counts)
            rest = {n: k for n, k in self.counts.items() if n != longest or k > 1}
            if longest in rest:
                rest[longest] -= 1
            chosen, slack = best_fill(rest, self.window - longest)
            need = Counter(chosen)
            need[longest] += 1
            for _ in range(1 if slack else min(self.counts[n] // k for n, k in need.items())):
                pieces = [self._take(n) for n in sorted(need, reverse=True) for _ in range(need[n])]
                if slack:  # no set fits: what is still held is longer, so one piece of it is cut
                    doc_id, start, ids, total = self._take(min(n for n in self.counts if n > slack))
                    pieces.append((doc_id, start, ids[:slack], total))
                    self._hold((doc_id, start + slack, ids[slack:], total))
                self._emit(pieces)
                if self.tokens < max(until, self.window):
                    break

    def finish(self) -> None:
        """Pack everything; the last, partial window is cut into sequences of powers of two, which need no padding."""
        self.pack(0)
        pieces = [self._take(n) for n in sorted(self.counts.elements(), reverse=True)]
        room = 1 << max(sum(len(p[2]) for p in pieces).bit_length() - 1, 0)
        now: list[tuple] = []
        left = sum(len(p[2]) for p in pieces)
        while pieces:
            doc_id, start, ids, total = pieces.pop(0)
            now.append((doc_id, start, ids[:room], total))
            if len(ids) > room:
                pieces.insert(0, (doc_id, start + room, ids[room:], total))
            room -= len(now[-1][2])
            left -= len(now[-1][2])
            if not room:
                self._emit(now)
                now, room = [], 1 << max(left.bit_length() - 1, 0)


def pack(documents: DataFrame, tokenizer: str, window: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of a document: where it starts, its length and checksum, its sequence and place there.

    ``tokenizer`` is the path of a tokenizer file that every executor can
    read. A document's ids are those of its text and an end id, so null and
    empty texts, and texts of white space, are one id long. Repeated rows are
    packed once each, a null ``doc_id`` stays null. Sequences are ``window``
    ids long, or a power of two at the end of a partition; none needs padding.
    An empty table gives no rows. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = Encoder(tokenizer), Packer(window, TaskContext.get().partitionId() << 40)

        def rows() -> Iterator[pa.RecordBatch]:
            if packer.rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*packer.rows)], names=NAMES)
                packer.rows.clear()

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                packer.add(key, ids)
                if packer.tokens >= HOLD:
                    packer.pack(HOLD // 4)
                if len(packer.rows) >= 1 << 14:
                    yield from rows()
        packer.finish()
        yield from rows()

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
