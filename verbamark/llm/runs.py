"""Periodic runs of words: maximal stretches that repeat with a smallest period, found online by a sparse diagonal DP.

A text is read word by word. Earlier occurrences of the word at hand open a
lag's diagonal, each further word that equals the one a lag before adds one to
the match length of that lag, and a diagonal that ends long enough is emitted
at once. What keeps the diagonals few loses no run:

* a run matches its lag ``WIDTH`` words or more in a row, so an occurrence
  counts with the words that follow it, by a hash of ``WIDTH`` words;
* a diagonal opens where the words before differ, else it is open already;
* the last ``WIDTH`` words of the least run with this lag must match, too;
* a lag is passed over while a divisor of it is open over all words back to
  the earlier occurrence, as that divisor is a period of the whole stretch.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BYTES_AT_ONCE = 1 << 21
ROWS_PAIRED = 8
SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def least_match(least: int, times: int) -> int:
    """The fewest words in a row that equal the one a lag before, over all lags a run can have."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def _grams(word: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on; beyond the end the places wrap around."""
    power, have, out, skip = _mixed(word.astype(np.uint64) + np.uint64(1)), 1, None, 0
    while True:
        if width & have:
            out = power if out is None else _mixed(out * np.uint64(0x9E3779B97F4A7C15) + np.roll(power, -skip))
            skip += have
        have *= 2
        if have > width:
            return out
        power = _mixed(power * np.uint64(0xD1B54A32D192ED03) + np.roll(power, -(have // 2)))


def _openings(word: np.ndarray, ends: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """``(text, place, lag)`` of diagonals that can hold a run, in order; texts lie one after another in ``word``."""
    width = least_match(least, times)
    counts = np.diff(np.append(0, ends))
    text = np.repeat(np.arange(len(counts)), counts)
    gram = _grams(word, width) ^ _mixed(text.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    places = np.flatnonzero(np.arange(len(word)) + width <= ends[text])
    places = places[counts[text[places]] >= least]
    if not len(places):
        return
    left = np.append(-1, word[:-1])
    left[(ends - counts)[counts > 0]] = -1
    places = places[np.argsort(gram[places], kind="stable")]
    same = gram[places[1:]] == gram[places[:-1]]
    # a row holds members of a group, in order, that follow the same word; groups of one row open nothing
    differ = left[places[1:]] != left[places[:-1]]
    group = np.cumsum(np.append(True, ~same))
    used = np.isin(group, group[1:][same & differ])
    places, group = places[used], group[used]
    found: list[tuple[int, int, int]] = []

    def keep(place: np.ndarray, earlier: np.ndarray, end: int, of: int) -> None:
        lag = place - earlier
        need = np.maximum(least - lag, (times - 1) * lag)
        fits = place + need <= end
        place, lag, last = place[fits], lag[fits], (place + need - width)[fits]
        same = gram[last] == gram[last - lag]
        found.extend((of, p, q) for p, q in zip(place[same].tolist(), lag[same].tolist()))

    for members in np.split(places, np.flatnonzero(np.diff(group)) + 1) if len(places) else []:
        before, of = left[members], int(text[members[0]])
        end = int(ends[of])
        firsts = np.append(0, np.flatnonzero(before[1:] != before[:-1]) + 1)
        if len(firsts) > ROWS_PAIRED:
            reach = np.searchsorted(members, members - (end - members) // (times - 1))
            for k in range(1, len(members)):
                earlier = members[reach[k]:k][before[reach[k]:k] != before[k]]
                keep(np.full(len(earlier), members[k]), earlier, end, of)
            continue
        rows = np.split(members, firsts[1:])
        for a, b in itertools.combinations(range(len(rows)), 2):
            if before[firsts[a]] != before[firsts[b]]:
                few, many = sorted((rows[a], rows[b]), key=len)
                for one in few:
                    at = np.full(len(many), one)
                    keep(*((many, at) if few is rows[a] else (at, many)), end, of)
    yield from sorted(found)


def _scan(word: list[int], openings: list[tuple[int, int]], least: int, times: int) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of one text, by start and period; openings are ``(place, lag)`` in order."""
    active: dict[int, int] = {}  # match length by lag
    runs: list[tuple[int, int, int]] = []
    waiting, n = 0, len(word)

    def ended(lag: int, place: int) -> None:
        length = active.pop(lag) + lag
        if length >= max(least, times * lag):
            runs.append((place - length, length, lag))

    place = openings[0][0]
    while place < n:
        here = word[place]
        for lag in list(active):
            if word[place - lag] == here:
                active[lag] += 1
            else:
                ended(lag, place)
        while waiting < len(openings) and openings[waiting][0] == place:
            lag = openings[waiting][1]
            waiting += 1
            if not any(lag % q == 0 and length + q > lag for q, length in active.items()):
                active[lag] = 1
        if active:
            place += 1
        elif waiting < len(openings):
            place = openings[waiting][0]
        else:
            break
    for lag in list(active):
        ended(lag, n)
    return sorted((s, length, q) for s, length, q in runs)


def find_runs(texts: list[list[int]], least: int = 24, times: int = 3) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, given as lists of word numbers."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    ends = np.cumsum([len(t) for t in texts])
    word = np.array([w for t in texts for w in t], np.int64)
    by_text: dict[int, list[tuple[int, int]]] = {}
    for text, place, lag in _openings(word, ends, least, times):
        by_text.setdefault(text, []).append((place - int(ends[text]) + len(texts[text]), lag))
    for text, openings in by_text.items():
        out[text] = sorted(_scan(texts[text], openings, least, times), key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[k] for k in np.flatnonzero(kept).tolist()]
    return b" ".join(words).decode()


def periodic_runs(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """``(key, n_words, runs, collapsed)`` of each whole text, its words being what ASCII white space sets apart.

    A run is a stretch of words with smallest period q that is at least
    ``least`` words and ``times`` (two or more) periods long and can't be
    extended; ``runs`` are ordered by start and period. ``collapsed`` is the
    text without the words that a run holds beyond its first period, joined by
    single spaces. A null or empty text has no words, no runs and an empty
    ``collapsed``. One row per row of ``documents``, repeated rows and null
    keys included; an empty table gives none. Other columns are not read.
    Nothing is shuffled; memory is in proportion to the longest text.
    """
    if times < 2 or least < 2:
        raise ValueError("a run has at least two words and two periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            bounds = np.cumsum(np.asarray(pc.binary_length(texts), np.int64)) // BYTES_AT_ONCE
            cuts = (np.flatnonzero(np.diff(bounds, append=-1)) + 1).tolist()
            for i, j in zip([0, *cuts], cuts):
                words = [t.encode().split() for t in texts.slice(i, j - i).to_pylist()]
                number: dict[bytes, int] = {}
                runs = find_runs([[number.setdefault(w, len(number)) for w in t] for t in words], least, times)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array([len(t) for t in words], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], RUN),
                    pa.array([_collapsed(t, found) for t, found in zip(words, runs)], pa.string()),
                ], names=["key", "n_words", "runs", "collapsed"])

    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)
