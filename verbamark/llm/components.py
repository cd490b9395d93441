"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.session import discard, stage


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(hi, lo) as decimal(38, 0)))")).first()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label every node of an edge list with the smallest node it can reach.

    Returns ``(node, component)``, one row per node that has a link to another
    one. Loops, repeated edges and edges with a null end change nothing; no
    edges give no rows. Both stars only send each edge to the smaller end of
    its neighbourhood, whose minimum is combined before it is shuffled, so a
    node with very many links makes no large group. Rounds are written to the
    shared folder; only two figures per round reach the driver.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    now = stage(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(hi.alias("hi"), lo.alias("lo"))
                .where("hi <> lo").distinct(), "edges")
    state = _state(now)
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi")
                 .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")),
                                           F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
                 .select("e.hi", "e.lo").where("hi <> lo").distinct())
        after = stage(small, "edges")
        new_state = _state(after)
        discard(now)
        now = after
        if new_state == state:
            break
        state = new_state
    roots = now.select(F.col("lo").alias("node")).distinct()
    return (now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
