"""Character n-gram F-score (Popović, 2015) for a batch of text pairs.

An addition of this library: a reference-based score that needs no model.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

ORDER = 6
BETA = 2.0
# pairs scored together, in characters: sorts stay in cache and memory bounded
CHARS_AT_ONCE = 32_000
KEY_LIMIT = 1 << 62
KEY_BITS = 64
# up to this character a table tells its number in the alphabet, beyond it a sort
TABLE_LIMIT = 1 << 16


def _numbered(codes: np.ndarray) -> tuple[np.ndarray, int]:
    """Every character's number in the alphabet, from 0, and the alphabet's size."""
    if codes.max(initial=0) >= TABLE_LIMIT:
        alphabet, char = np.unique(codes, return_inverse=True)
        return char, len(alphabet)
    there = np.zeros(codes.max(initial=0) + 1, bool)
    there[codes] = True
    return (np.cumsum(there) - 1)[codes], int(there.sum())


def _score(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Scores of ``(text, reference)`` pairs, whose grams are counted together by sorting."""
    n = len(pairs)
    bare = [t for pair in pairs for t in pair]
    lengths = np.fromiter(map(len, bare), dtype=np.int64, count=2 * n)
    codes = np.frombuffer("".join(bare).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def fits(size: int) -> bool:
        return ORDER * size.bit_length() + n.bit_length() + 1 <= KEY_BITS

    char, size = codes.astype(np.int64), int(codes.max(initial=0)) + 1
    if not fits(size):
        char, size = _numbered(char)
    shared = (_by_prefix if fits(size) else _by_order)(n, lengths, char, size)
    precision, recall, orders = np.zeros(n), np.zeros(n), np.zeros(n)
    for order in range(1, ORDER + 1):
        grams = np.maximum(lengths - order + 1, 0)
        of_text, of_reference = grams[0::2], grams[1::2]
        both = (of_text > 0) & (of_reference > 0)
        precision[both] += shared[order - 1, both] / of_text[both]
        recall[both] += shared[order - 1, both] / of_reference[both]
        orders += both
    seen = np.maximum(orders, 1)
    p, r = precision / seen, recall / seen
    weighted = BETA**2 * p + r
    return np.divide((1 + BETA**2) * p * r, weighted, out=np.zeros(n), where=weighted > 0)


def _by_prefix(n: int, lengths: np.ndarray, char: np.ndarray, size: int) -> np.ndarray:
    """Grams each pair has on both sides, repeats counted, a row per order, by one sort of the longest grams.

    A key holds the pair's number, the characters (from 1; 0 stands behind a
    text's end) and the side. Sorted keys have the grams of every order side
    by side, as prefixes, so one order's groups are made of the next one's.
    """
    bits, owner = size.bit_length(), np.repeat(np.arange(2 * n), lengths)
    where = np.arange(len(char)) + owner * ORDER
    padded = np.zeros(len(char) + 2 * n * ORDER, np.int64)
    padded[where] = char + 1
    padded = padded.view(np.uint64)
    gram = padded[:len(padded) - ORDER + 1].copy()
    for k in range(1, ORDER):
        gram <<= np.uint64(bits)
        gram |= padded[k:len(padded) - ORDER + 1 + k]
    key = ((owner >> 1) << (ORDER * bits)).view(np.uint64) | gram[where]
    key = key << np.uint64(1) | (owner & 1).view(np.uint64)
    key.sort()
    n_reference = np.concatenate([[0], np.cumsum(key & np.uint64(1), dtype=np.int64)])
    key >>= np.uint64(1)
    # where neighbours differ, and how far up; the ends differ from nothing
    differ = np.concatenate([key[:1] | ~key[:1], key[1:] ^ key[:-1]])
    start = np.flatnonzero(differ)
    differ, key = differ.take(start), key.take(start)
    of_pair = np.arange(n, dtype=np.uint64)
    shared = np.zeros((ORDER, n), np.int64)
    for order in range(ORDER, 0, -1):
        low = bits * (ORDER - order)
        if order < ORDER:
            kept = np.flatnonzero(differ >= np.uint64(1 << low))
            start, differ, key = start.take(kept), differ.take(kept), key.take(kept)
        ends = np.append(start, len(char))
        of_reference = np.diff(n_reference.take(ends))
        least = np.minimum(of_reference, np.diff(ends) - of_reference)
        least *= key & np.uint64((1 << bits) - 1 << low) != 0  # the others run over a text's end
        total = np.concatenate([[0], np.cumsum(least)])
        shared[order - 1] = np.diff(total[np.append(np.searchsorted(key, of_pair << np.uint64(ORDER * bits)), len(key))])
    return shared


def _by_order(n: int, lengths: np.ndarray, char: np.ndarray, size: int) -> np.ndarray:
    """The same by one sort per order, for alphabets too large for one key.

    A gram's key starts with its pair's number, so that sorted keys lie pair
    by pair, and ends with its side, so that a gram's two sides lie together.
    """
    owner = np.repeat(np.arange(2 * n), lengths)
    side = owner & 1
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(char))  # characters to the text's end
    key, limit = owner >> 1, n
    shared = np.zeros((ORDER, n), np.int64)
    for order in range(1, min(ORDER, lengths.max(initial=0)) + 1):
        if limit * size >= KEY_LIMIT:
            known, key = np.unique(key, return_inverse=True)
            limit = len(known)
        # windows over two texts get a key as well, and are left out below
        key = key[:len(char) - order + 1] * size + char[order - 1:]
        limit *= size
        inside = left[:len(key)] >= order
        grams = np.maximum(lengths - order + 1, 0)
        shared[order - 1] = _shared((key * 2 + side[:len(key)])[inside], grams[0::2] + grams[1::2])
    return shared


def _shared(keys: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Grams each pair has on both sides, repeats counted; ``grams`` is how many keys it has."""
    keys.sort()
    first = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
    size = np.diff(first, append=len(keys))
    distinct = keys[first]
    met = np.flatnonzero((distinct[:-1] ^ 1) == distinct[1:])  # a gram of the text, then the reference's
    pair = np.searchsorted(np.cumsum(grams), first[met], side="right")
    return np.bincount(pair, np.minimum(size[met], size[met + 1]), minlength=len(grams))


def _bare(texts: pd.Series) -> list[str]:
    # spaces first, as taking a text apart at each of them costs more; most texts are one word then
    words = (t.replace(" ", "").split() for t in texts)
    return [w[0] if len(w) == 1 else "".join(w) for w in words]


def chrf(texts: pd.Series, references: pd.Series) -> pd.Series:
    """Score 0..1 per pair, whitespace ignored; null where a side is null."""
    known = (texts.notna() & references.notna()).to_numpy()
    pairs = list(zip(_bare(texts[known]), _bare(references[known])))
    # equal texts share every gram, so only the others need counting
    scores = np.array([float(t == r != "") for t, r in pairs])
    rest = np.array([k for k, (t, r) in enumerate(pairs) if t != r], dtype=np.int64)
    chunk = np.cumsum([len(pairs[k][0]) + len(pairs[k][1]) for k in rest]) // CHARS_AT_ONCE
    for rows in np.split(rest, np.flatnonzero(np.diff(chunk)) + 1):
        if len(rows):
            scores[rows] = _score([pairs[k] for k in rows])
    whole = np.full(len(texts), np.nan)
    whole[known] = scores
    return pd.Series(whole, index=texts.index, dtype="Float64").mask(~known)
