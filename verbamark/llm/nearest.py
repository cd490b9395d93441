"""Nearest vectors by inner product from balanced posting lists.

Vectors get one more component, ``sqrt(M^2 - |x|^2)`` with the greatest norm
``M``, so that the largest inner product is the least distance. The centroids
come from a bounded sample, halved again and again at the median between two
means, so all lists are about equally long. They are joined to a graph of
near centroids, which a best-first search walks for every vector and query. A
vector goes to its nearest lists within ``CLOSURE`` times the least distance,
a query to all lists within a ratio that is calibrated on the sample to reach
the wanted recall. A long list is cut into parts, and the queries of a list as
well, so no task holds more than one part of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.llm.sharing import share
from verbamark.llm.vectors import bounded_sample, lists, matrix, usable
from verbamark.session import stage

SAMPLE = 20_000
MAX_LISTS = 1024
PART = 1024
DEGREE, BEAM, ENTRIES = 24, 16, 8
COPIES, CLOSURE = 4, 1.2
RECALL = 0.97
TEST_QUERIES = 512
SLACK = 2
AT_ONCE = 256


def _mean_split(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    a, b = x[rng.choice(rows, 2, replace=False)]
    for _ in range(8):
        order = np.argsort(x[rows] @ (b - a), kind="stable")
        first, second = rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]
        a, b = x[first].mean(axis=0), x[second].mean(axis=0)
    return first, second


def balanced_centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Means of ``k`` groups that differ by few members, by halving the largest group."""
    rng, groups = np.random.default_rng(0), [np.arange(len(x))]
    while len(groups) < k:
        groups.sort(key=len)
        if len(groups[-1]) < 2:
            break
        groups.extend(_mean_split(x, groups.pop(), rng))
    return np.stack([x[g].mean(axis=0) for g in groups])


@dataclass
class Index:
    """Centroids, the graph between them, where a search starts and the ratio of distances that a query goes to."""

    norm: float
    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    ratio: float = 1.0
    typical: float = 0.0

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    def search(self, x: np.ndarray, ratio: float, typical: float = 0.0) -> np.ndarray:
        """Distances to the centroids that the walk reached, others infinite.

        Reached are all that are nearer than ``ratio`` times the least distance,
        or ``typical`` if that is more, as far as the graph leads to them.
        """
        far = np.full((len(x), len(self.centroids)), np.inf)
        done = np.zeros(far.shape, bool)
        row, at = np.repeat(np.arange(len(x)), len(self.entries)), np.tile(self.entries, len(x))
        beam = min(BEAM, len(self.centroids)) - 1
        while len(row):
            far[row, at] = np.sqrt(np.maximum(((x[row] - self.centroids[at]) ** 2).sum(axis=1), 0))
            limit = np.maximum(np.maximum(far.min(axis=1), typical) * ratio, np.partition(far, beam, axis=1)[:, beam])
            row, at = np.nonzero((far <= limit[:, None]) & ~done & np.isfinite(far))
            done[row, at] = True
            row, at = np.repeat(row, self.graph.shape[1]), self.graph[at].ravel()
            new = np.unique((row * far.shape[1] + at)[np.isinf(far[row, at])])
            row, at = new // far.shape[1], new % far.shape[1]
        return far

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists of each vector, as (row, list)."""
        far = self.search(self.lifted(x), CLOSURE)
        near = np.argsort(far, axis=1, kind="stable")[:, :COPIES]
        found = np.take_along_axis(far, near, axis=1)
        row, k = np.nonzero(found <= found[:, :1] * CLOSURE)
        return row, near[row, k]

    def probes(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists that each query goes to, as (row, list)."""
        if np.isinf(self.ratio):
            return np.divmod(np.arange(len(q) * len(self.centroids)), len(self.centroids))
        far = self.search(np.hstack([q, np.zeros((len(q), 1))]), self.ratio, self.typical)
        return np.nonzero(far <= np.maximum(far.min(axis=1, keepdims=True), self.typical) * self.ratio)

    def floor(self, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """A score that more than ``k`` vectors reach, by the sample; nothing below it can be among the nearest."""
        if not len(self.sample):
            return np.full(len(q), -np.inf)
        score = q @ self.sample.T
        score[ids[:, None] == self.sample_ids] = -np.inf
        k *= SLACK
        if score.shape[1] <= k:
            return np.full(len(q), -np.inf)
        return np.partition(score, -k, axis=1)[:, -k]


def fit(rows: DataFrame, k: int) -> Index | None:
    """An index for ``rows`` of ``(vec_id, v)``; centroids and ratio come from at most ``SAMPLE`` of them."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    total, greatest = rows.agg(F.count("*"), F.max(norm)).first()
    if not total:
        return None
    table = bounded_sample(rows, "vec_id", SAMPLE, total).sort_by("vec_id")
    if not len(table):
        table = rows.limit(1).toArrow()
    ids, x = np.asarray(table["vec_id"]), matrix(table["v"])
    index = Index(greatest, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), ids, x)
    lifted = index.lifted(x)
    n_lists = int(min(MAX_LISTS, max(1, round(total ** 0.5)), max(1, len(x) // 16)))
    index.centroids = balanced_centroids(lifted, n_lists)
    length = (index.centroids ** 2).sum(axis=1)
    between = length[:, None] + length - 2 * index.centroids @ index.centroids.T
    np.fill_diagonal(between, -1)
    index.graph = np.argsort(between, axis=1, kind="stable")[:, 1:DEGREE + 1]
    if index.graph.shape[1] == 0:
        index.graph = np.zeros((1, 1), int)
    index.entries = np.arange(0, len(index.centroids), max(1, len(index.centroids) // ENTRIES))
    index.ratio = _ratio(index, ids, x, k)
    return index


def _ratio(index: Index, ids: np.ndarray, x: np.ndarray, k: int) -> float:
    """The least ratio with which ``RECALL`` of the sample's true neighbours stand in a list that is probed."""
    tests = np.arange(0, len(x), max(1, len(x) // TEST_QUERIES))
    near = []
    for part in (tests[i:i + AT_ONCE // 4] for i in range(0, len(tests), AT_ONCE // 4)):
        score = x[part] @ x.T
        score[np.arange(len(part)), part] = -np.inf
        near.append(np.argsort(-score, axis=1, kind="stable")[:, :min(k, len(x) - 1)].copy())
    near = np.concatenate(near)
    if not near.size:
        return 1.0
    wanted = np.unique(near)
    holds = np.zeros((len(x), len(index.centroids)), bool)
    for part in (wanted[i:i + AT_ONCE] for i in range(0, len(wanted), AT_ONCE)):
        row, at = index.places(x[part])
        holds[part[row], at] = True
    q = np.hstack([x[tests], np.zeros((len(tests), 1))])
    far = np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + (index.centroids ** 2).sum(axis=1) - 2 * q @ index.centroids.T, 0))
    least = far.min(axis=1)
    # a query with a centroid right beside it still has most neighbours as far away as others have
    index.typical = float(np.median(least))
    least = np.maximum(least, index.typical)
    needed = np.concatenate([np.where(holds[near[i]], far[i], np.inf).min(axis=1) / max(least[i], 1e-12)
                             for i in range(len(tests))])
    return float(np.quantile(needed, RECALL)) * (1 + 1e-9)


def _dealt(rows: DataFrame, index: Index, queries: bool, k: int) -> DataFrame:
    shared = share(rows, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared()
        for batch in batches:
            for part in (batch.slice(i, AT_ONCE) for i in range(0, batch.num_rows, AT_ONCE)):
                ids, v = np.asarray(part.column(0)), matrix(part.column(1))
                row, at = index.probes(v) if queries else index.places(v)
                floor = index.floor(ids, v, k) if queries else np.zeros(len(v))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array(ids[row]), pa.array(floor[row]),
                     lists(v[row].astype(np.float32 if small else np.float64))], ["list", "id", "floor", "v"])

    small = rows.schema["v"].dataType.elementType.typeName() == "float"
    return rows.select("vec_id", "v").mapInArrow(
        run, f"list int, id long, floor double, v array<{'float' if small else 'double'}>")


def _best(ids: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each row, ties to the smaller id."""
    order = np.lexsort((ids, -score, row))
    start = np.flatnonzero(np.concatenate([[True], row[order][1:] != row[order][:-1]]))
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < k]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``k`` nearest other vectors that were found.

    The score is the inner product in doubles, ties go to the smaller id.
    Vectors and queries that are null, zero, or hold null or non-finite
    components, or have no id take no part. All vectors have one length.
    Repeated rows of one id count once, those that differ by the vector that
    sorts first. Empty tables give no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    clean = lambda df: df.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    base, asked = stage(clean(vectors), "vectors"), stage(clean(queries), "queries")
    index = fit(base, k)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    postings = stage(_dealt(base, index, False, k), "postings")
    found = _found(postings, stage(_dealt(asked, index, True, k), "probes"), k)
    # an odd query whose lists held too few goes to all lists
    full = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
    rest = asked.join(full.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    everywhere = replace(index, ratio=np.inf, sample_ids=index.sample_ids[:0], sample=index.sample[:0])
    found = found.union(_found(postings, stage(_dealt(rest, everywhere, True, k), "probes"), k))
    best = F.slice(F.sort_array(F.collect_set(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k)
    return (found.groupBy("query_id").agg(best.alias("best"))
            .select("query_id", F.posexplode("best").alias("rank", "b"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", (-F.col("b.far")).alias("score")))


def _found(postings: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """``(query_id, vec_id, score)``: the best of every list that a query goes to, those above its floor."""
    sizes = postings.groupBy("list").agg(F.ceil(F.count("*") / PART).cast("int").alias("n_v")).join(
        probes.groupBy("list").agg(F.ceil(F.count("*") / PART).cast("int").alias("n_q")), "list")
    sizes = F.broadcast(sizes)  # at most MAX_LISTS rows

    def cut(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        return (rows.join(sizes, "list").withColumn(own, mine)
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if len(left) and len(right):
            ids, v = np.asarray(left["id"]), matrix(left["v"])
            names, q, floor = np.asarray(right["id"]), matrix(right["v"]), np.asarray(right["floor"])
            score = q @ v.T
            same = names[:, None] == ids
            score[same] = -np.inf
            slack = 1e-9 * (1 + np.sqrt((q * q).sum(axis=1)) * np.sqrt((v * v).sum(axis=1).max()))
            bar = floor
            if len(ids) > k:
                bar = np.maximum(bar, np.partition(score, -k, axis=1)[:, -k])
            row, at = np.nonzero((score >= (bar - slack)[:, None]) & ~same)
            exact = np.concatenate([np.empty(0)] + [(q[row[i:i + 65536]] * v[at[i:i + 65536]]).sum(axis=1)
                                                    for i in range(0, len(row), 65536)])
            best = _best(ids[at], exact, row, k)
            out = [names[row[best]], ids[at[best]], exact[best]]
        return pa.table([pa.array(x) for x in out], names=["query_id", "vec_id", "score"])

    keys = ["list", "n_v", "n_q"]
    found = (cut(postings, "n_v", "n_q").groupBy(*keys).cogroup(cut(probes, "n_q", "n_v").groupBy(*keys))
             .applyInArrow(compare, "query_id long, vec_id long, score double"))
    return stage(found, "found")
