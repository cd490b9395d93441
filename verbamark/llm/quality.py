"""Quality of whole texts by naive Bayes support vectors.

A text's features are its runs of one and two words and of one to three word
shapes, each counted once, hashed to ``DIMENSIONS`` numbers. The class
log-count ratio of every feature comes from all labelled texts; a linear
hinge-loss model on the features scaled by these ratios is fitted by dual
coordinate descent on a bounded sample, and its margins are turned into
probabilities on other labelled texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.llm.sharing import share
from verbamark.session import discard, stage

DIMENSIONS = 1 << 18
SAMPLE = 8000
BYTES_AT_ONCE = 1 << 21
EPOCHS, COST, SMOOTHING = 20, 1.0, 1.0
SHAPES = [(re.compile(p), s) for p, s in ((r"[^\W\d_]+", lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a"),
                                          (r"\d+", "9"), (r"(.)\1+", r"\1+"))]
REPEATED = 0x9E3779B97F4A7C15
STEP = np.uint64(0xD6E8FEB86659FD93)


def shape(word: str) -> str:
    """A word with its letters as ``a``, or ``A`` if all are capitals, its digits as ``9``, and repeats as ``+``."""
    for pattern, new in SHAPES:
        word = pattern.sub(new, word)
    return word


def _mixed(*parts: np.ndarray) -> np.ndarray:
    out = parts[0]
    for part in parts[1:]:
        out = (out ^ (out >> np.uint64(29))) * STEP + part
    return out


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows and features of parts of a batch of texts, each pair once, rows in ascending order."""
    texts = pc.fill_null(texts, "")
    bounds = np.cumsum(np.asarray(pc.binary_length(texts), np.int64)) // BYTES_AT_ONCE
    cuts = np.flatnonzero(np.diff(bounds, prepend=0, append=-1))
    for first, last in zip([0, *cuts[:-1]], cuts):
        split = pc.ascii_split_whitespace(texts.slice(first, last - first))
        coded = split.flatten().dictionary_encode()
        if not len(coded):
            continue
        words, at = coded.dictionary.to_pylist(), np.asarray(coded.indices)
        row = first + np.repeat(np.arange(len(split)), split.value_lengths().to_numpy())
        word = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)[at]
        form = np.array([xxhash.xxh64_intdigest(shape(w), 1) for w in words], np.uint64)[at]
        empty = np.array([not w for w in words])[at]  # at the ends of texts
        row, at, word, form = (x[~empty] for x in (row, at, word, form))
        near, next_near = row[1:] == row[:-1], row[2:] == row[:-2]
        form[1:][near & (at[1:] == at[:-1])] = np.uint64(REPEATED)
        found = [(row, word), (row[1:][near], _mixed(word[:-1], word[1:])[near]), (row, _mixed(form, form)),
                 (row[1:][near], _mixed(form[:-1], form[1:], form[1:])[near]),
                 (row[2:][next_near], _mixed(form[:-2], form[1:-1], form[2:])[next_near])]
        row, feature = (np.concatenate(x) for x in zip(*found))
        both = np.unique(row.astype(np.int64) * DIMENSIONS + (feature >> np.uint64(40)).astype(np.int64) % DIMENSIONS)
        yield both // DIMENSIONS, both % DIMENSIONS


def _by_row(row: np.ndarray, feature: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    yield from zip(row[start].tolist(), np.split(feature, start[1:]))


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, by dual coordinate descent; both classes weigh the same."""
    rng = np.random.default_rng(0)
    sign = np.where(labels == 1, 1.0, -1.0)
    share = max((labels == 1).mean(), 1e-9)
    cost = COST * np.where(labels == 1, 0.5 / share, 0.5 / max(1 - share, 1e-9))
    values = [ratio[f] / np.sqrt(max(len(f), 1)) for f in rows]
    square = np.array([v @ v + 1 for v in values])
    weight, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(rows))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (weight[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weight[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return weight, bias


def _platt(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, by Newton's method on smoothed labels."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    x = np.stack([margin, np.ones_like(margin)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (p - target))
        slope, offset = slope - np.clip(step[0], -2, 2), offset - np.clip(step[1], -2, 2)
    return max(slope, 1e-6), offset


@dataclass
class Model:
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for row, feature in features(texts):
            n = np.bincount(row, minlength=len(texts))
            out += np.bincount(row, self.weight[feature], len(texts)) / np.sqrt(np.maximum(n, 1))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


def fit(training: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id") -> Model:
    """A model of label 1 against label 0, from rows with a text, a label of 0 or 1 and a key.

    One fifth of the rows, by a hash of the key, calibrates the scores, the
    others give the log-count ratios. Of both parts about ``SAMPLE`` rows, by
    another hash, go to the fit on the driver. With no rows of one class every
    text gets a middling score.
    """
    spark = training.sparkSession
    rows = training.where(F.col(text).isNotNull() & F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("int").alias("y"),
        (F.pmod(F.xxhash64(F.lit("part"), key), F.lit(5)) == 0).alias("aside"),
        (F.pmod(F.xxhash64(F.lit("draw"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("draw"))
    total = max(training.where(F.col(label).isin(0, 1)).select(label).count(), 1)
    fitted, aside = SAMPLE / (0.8 * total), SAMPLE / (0.2 * total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, DIMENSIONS), np.int64)
        schema = pa.schema([("y", pa.int32()), ("aside", pa.bool_()), ("features", pa.list_(pa.int32())),
                            ("ones", pa.list_(pa.int64()))])
        for batch in batches:
            y, held, draw = (np.asarray(batch.column(i).to_pylist()) for i in (1, 2, 3))
            taken = draw < np.where(held, aside, fitted)
            out = [[], [], []]
            for row, feature in features(batch.column(0)):
                for c in (0, 1):
                    counts[c] += np.bincount(feature[(y[row] == c) & ~held[row]], minlength=DIMENSIONS)
                for i, own in _by_row(row, feature):
                    if taken[i]:
                        for column, value in zip(out, (int(y[i]), bool(held[i]), own.astype(np.int32))):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*out, [None] * len(out[0])], schema)],
                                             schema=schema)
        for c in (0, 1):
            there = np.flatnonzero(counts[c])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([None], pa.bool_()), pa.array([there.astype(np.int32)], schema[2].type),
                 pa.array([counts[c][there]], schema[3].type)], schema=schema)

    found = stage(rows.mapInArrow(run, "y int, aside boolean, features array<int>, ones array<long>"), "quality")
    sums = (found.where("aside is null").select("y", F.explode(F.arrays_zip("features", "ones")).alias("f"))
            .groupBy("y", "f.features").agg(F.sum("f.ones").alias("n")).toArrow())
    drawn = found.where("aside is not null").select("y", "aside", "features").toArrow()
    discard(found)
    count = np.zeros((2, DIMENSIONS))
    count[np.asarray(sums["y"]), np.asarray(sums["features"])] = np.asarray(sums["n"])
    count += SMOOTHING
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    y, aside_rows = np.asarray(drawn["y"].to_pylist(), int), np.asarray(drawn["aside"].to_pylist(), bool)
    own = [np.asarray(f.values, np.int64) for f in drawn["features"]]
    first = np.flatnonzero(~aside_rows)
    if len(set(y[first].tolist())) < 2:
        return Model(np.zeros(DIMENSIONS), 0.0)
    weight, bias = descend([own[i] for i in first], y[first], ratio)
    model = Model(weight * ratio, bias)
    rest = np.flatnonzero(aside_rows)
    if len(set(y[rest].tolist())) == 2:
        margin = np.array([model.weight[own[i]].sum() / np.sqrt(max(len(own[i]), 1)) + bias for i in rest])
        model.slope, model.offset = _platt(margin, y[rest])
    return model


def classify(documents: DataFrame, training: DataFrame, text: str = "text", label: str = "quality",
             key: str = "doc_id") -> DataFrame:
    """``documents`` with ``score``, the probability of label 1.

    Null and empty texts have no features and get the score of the bias. Rows
    of ``training`` with a null text, label or key teach nothing; repeated rows
    of it count each. Columns of ``documents`` pass through, except one named
    ``score``.
    """
    documents = documents.drop("score")
    shared, schema = share(documents, fit(training, text, label, key)), documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            score = model.scores(batch.column(schema.names.index(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*schema.names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return documents.mapInArrow(run, f"{fields}, score double")
