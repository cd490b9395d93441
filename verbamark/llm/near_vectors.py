"""Near-copies among vectors by an inverted multi-index.

The two halves of the vectors, scaled to length one, have a codebook each; a
pair of codewords is a cell of the product grid. Every vector lies in one home
cell and looks into its nearest cells, in the order of the summed squared
distances of the halves. How many cells that takes is measured on vectors
turned away just as far as the threshold allows, so that the wanted share of
such pairs is found from either side. All candidates are then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.llm.components import connected_components
from verbamark.llm.sharing import share
from verbamark.llm.vectors import bounded_sample, lists, matrix, usable
from verbamark.session import discard, stage

SAMPLE = 20_000
PER_CELL = 2048
MAX_WORDS = 256
PART = 1024
RECALL = 0.995
TEST_VECTORS = 2000
MARGIN = 1e-9
AT_ONCE = 4096


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(0)
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = _squared(x, words).argmin(axis=1)
        n = np.bincount(own, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, own, x)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def _squared(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (words * words).sum(axis=1) - 2 * x @ words.T, 0)


@dataclass
class Grid:
    """The two codebooks and the number of cells that a vector looks into."""

    first: np.ndarray
    second: np.ndarray
    visits: int = 1

    def _distances(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _squared(u[:, :half], self.first), _squared(u[:, half:], self.second)

    def cells(self, u: np.ndarray) -> np.ndarray:
        """The nearest cells of each vector in the order of the traversal, the home cell first."""
        a, b = self._distances(u)
        near_a, near_b = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
        a, b = np.take_along_axis(a, near_a, 1), np.take_along_axis(b, near_b, 1)
        # the cell of the i-th and j-th nearest words comes after (i + 1) (j + 1) - 1 others at least
        i, j = np.nonzero(np.outer(np.arange(1, a.shape[1] + 1), np.arange(1, b.shape[1] + 1)) <= self.visits)
        order = np.argsort(a[:, i] + b[:, j], axis=1, kind="stable")[:, :self.visits]
        return (np.take_along_axis(near_a[:, i], order, 1) * b.shape[1] + np.take_along_axis(near_b[:, j], order, 1))

    def calibrate(self, u: np.ndarray, cosine: float, recall: float) -> None:
        rng = np.random.default_rng(1)
        aside = rng.normal(size=u.shape)
        aside -= (aside * u).sum(axis=1, keepdims=True) * u
        turned = cosine * u + np.sqrt(1 - cosine ** 2) * _unit(aside)
        a, b = self._distances(u)
        ta, tb = self._distances(turned)
        row = np.arange(len(u))
        home = a[row, ta.argmin(axis=1)] + b[row, tb.argmin(axis=1)]
        rank = np.concatenate([(a[k:k + 16, :, None] + b[k:k + 16, None, :] <= home[k:k + 16, None, None]).sum(axis=(1, 2))
                               for k in range(0, len(u), 16)])
        self.visits = int(np.quantile(rank, recall, method="higher"))


def fit(classes: DataFrame, cosine: float) -> Grid | None:
    total = classes.count()
    if not total:
        return None
    table = bounded_sample(classes.select("node", "v"), "node", SAMPLE, total).sort_by("node")
    if not len(table):
        table = classes.select("node", "v").limit(1).toArrow()
    u = _unit(matrix(table["v"]))
    half = (u.shape[1] + 1) // 2
    k = int(min(MAX_WORDS, max(1, round((total / PER_CELL) ** 0.5))))
    grid = Grid(_codebook(u[:, :half], k), _codebook(u[:, half:], k))
    if u.shape[1] > 1:
        grid.calibrate(u[:TEST_VECTORS], cosine, RECALL)
    return grid


def _dealt(classes: DataFrame, grid: Grid) -> DataFrame:
    """``classes`` with ``cells``, those each vector looks into, its home first."""
    shared = share(classes, grid)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared()
        for batch in batches:
            for part in (batch.slice(i, AT_ONCE) for i in range(0, batch.num_rows, AT_ONCE)):
                cells = grid.cells(_unit(matrix(part.column(3))))
                yield pa.RecordBatch.from_arrays([*part.columns, lists(cells.astype(np.int32))],
                                                 ["node", "n", "label", "v", "cells"])

    kind = classes.schema["v"].dataType.simpleString()
    return classes.select("node", "n", "label", "v").mapInArrow(
        run, f"node long, n long, label string, v {kind}, cells array<int>")


def _linked(q: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of q, row of b) whose cosine is ``cosine`` at least; close calls are computed pair by pair."""
    score = _unit(q) @ _unit(b).T
    row, at = np.nonzero(score >= cosine - MARGIN)
    close = np.flatnonzero(score[row, at] < cosine + MARGIN)
    x, y = q[row[close]], b[at[close]]
    exact = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    keep = np.ones(len(row), bool)
    keep[close] = exact >= cosine
    return row[keep], at[keep]


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of a list of links with the smallest node it can reach, itself left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, least = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        before = least.copy()
        np.minimum.at(least, i, before[j])
        np.minimum.at(least, j, before[i])
        least = least[least]
        if (least == before).all():
            return nodes[least != np.arange(len(nodes))], nodes[least[least != np.arange(len(nodes))]]


def near_vectors(vectors: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding",
                 label: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Vectors link if their labels are equal and not null and their cosine, in
    doubles, is ``cosine`` at least. Vectors that are null, zero, or hold null
    or non-finite components link with nothing. Equal vectors of a label are
    one class, so copies, repeated rows among them, count as links of each
    other but are compared once. ``component_id`` is the smallest id that links
    reach. Rows without an id link with nothing and have no component. All
    usable vectors have one length. Other columns are not read.
    """
    free = usable(vector) & F.col(label).isNotNull() & F.col(vec_id).isNotNull()
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.when(free, F.col(label).cast("string")).alias("label"), F.when(free, F.col(vector)).alias("v"))
    classes = stage(rows.where("label is not null").groupBy("label", "v").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("n")), "vector-classes")
    grid = fit(classes, cosine)
    if grid is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    dealt = stage(_dealt(classes, grid), "cells")
    homes = dealt.withColumn("cell", F.col("cells")[0])
    # a cogroup can't take two sides that share columns, so these get new ones
    looks = dealt.select(*(F.col(c).alias(f"q_{c}") for c in ("node", "n", "v")), F.col("label").alias("q_label"),
                         F.col("cells")[0].alias("home"), F.explode("cells").alias("cell")).withColumnsRenamed(
                             {"q_node": "node", "q_n": "n", "q_v": "v", "q_label": "label"})
    sizes = stage(homes.groupBy("label", "cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("n_b")).join(
        looks.groupBy("label", "cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("n_q")), ["label", "cell"]), "cell-sizes")

    def cut(table: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
        return (table.join(sizes, ["label", "cell"]).withColumn(own, mine)
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.int64())] * 3, names=["a", "b", "n"])
        node, n, other, m = (np.asarray(t[c]) for t in (left, right) for c in ("node", "n"))
        row, at = _linked(matrix(right["v"]), matrix(left["v"]), cosine)
        differ = other[row] != node[at]
        row, at = row[differ], at[differ]
        # the looking vector counts the other; the other counts back where it does not look this way itself
        cells, home = matrix(left["cells"]).astype(int), np.asarray(right["home"])
        blind = ~(cells[at] == home[row][:, None]).any(axis=1)
        count = np.bincount(row, n[at], len(other)).astype(np.int64)
        back = np.bincount(at[blind], m[row[blind]], len(node)).astype(np.int64)
        child, root = _stars(other[row], node[at])
        none = pa.nulls(int((count > 0).sum() + (back > 0).sum()), pa.int64())
        return pa.table([pa.array(np.concatenate([other[count > 0], node[back > 0], child])),
                         pa.chunked_array([none, pa.array(root)]),
                         pa.array(np.concatenate([count[count > 0], back[back > 0], np.zeros(len(child), np.int64)]))],
                        names=["a", "b", "n"])

    keys = ["label", "cell", "n_b", "n_q"]
    found = stage(cut(homes, "n_b", "n_q").groupBy(*keys).cogroup(cut(looks, "n_q", "n_b").groupBy(*keys))
                  .applyInArrow(compare, "a long, b long, n long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("found"))
    components = connected_components(found.where("b is not null"))
    known = stage(classes.join(counts, "node", "left").join(components, "node", "left").select(
        "label", "v", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id")), "vector-components")
    discard(dealt, sizes, found)
    out = rows.join(known, ["label", "v"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
