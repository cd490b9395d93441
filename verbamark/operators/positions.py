"""Running totals over a corpus, by levels of key ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# keys of a range differ in their lowest bits only, and so do ranges of a range
BITS = 21


def prefix_sums(counts: DataFrame, group: Sequence[str], key: str, value: str, bits: int = BITS,
                width: int = 64) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the group with a smaller ``key``.

    ``key`` is a long integer, unique in its group, and may be sparse or
    negative, and fits in ``width`` bits with its sign. Sums are taken per range of ``2**bits`` keys, per range of as
    many ranges, and so on up to the sign, and carried down again. A window
    holds the rows of one range, never a whole group, whatever the keys are.
    """
    within = Window.partitionBy(*group, "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = (counts.withColumn("_range", F.shiftright(F.col(key).cast("long"), min(bits, 63)))
            .withColumn("before", F.coalesce(F.sum(value).over(within), F.lit(0))))
    if width <= bits + 1:  # all that is left of the key is its sign, and the negative half comes first
        below = counts.where(F.col(key) < 0).groupBy(*group).agg(F.sum(value).alias("_below"))
        return (rows.join(below, list(group), "left")
                .withColumn("before", F.col("before") + F.when(F.col("_range") >= 0, F.coalesce("_below", F.lit(0))).otherwise(0))
                .drop("_range", "_below"))
    sums = rows.groupBy(*group, F.col("_range").alias(key)).agg(F.sum(value).alias(value))
    above = prefix_sums(sums, group, key, value, bits, width - bits)
    above = above.select(*group, F.col(key).alias("_range"), F.col("before").alias("_carried"))
    return (rows.join(above, [*group, "_range"])
            .withColumn("before", F.col("before") + F.col("_carried")).drop("_range", "_carried"))
