"""Candidate translations: wide and long form, attempts, credential slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbamark.schemas import FAILURE_TEXT


def status_of(text: Column) -> Column:
    """``missing`` for null, ``error`` for the failure literal, else ``ok``."""
    return F.when(text.isNull(), "missing").when(text == FAILURE_TEXT, "error").otherwise("ok")


def with_status(candidates: DataFrame) -> DataFrame:
    """Replace the failure literal by null and say in ``status`` what it was."""
    status = status_of(F.col("text"))
    text = F.when(F.col("text") != FAILURE_TEXT, F.col("text"))
    return candidates.withColumns({"status": status, "text": text})


def scorable(candidates: DataFrame, score_failures: bool = False) -> DataFrame:
    """Candidates with a text to judge or score.

    ``score_failures`` takes all of them instead, a failed one with the failure
    literal as if it were its translation.
    """
    if not score_failures:
        return candidates.where(F.col("text").isNotNull())
    if "status" not in candidates.columns:
        return candidates
    return candidates.withColumn(
        "text", F.when(F.col("status") == "error", FAILURE_TEXT).otherwise(F.col("text")))


def to_long(wide: DataFrame, systems: Sequence[str],
            keys: Sequence[str] = ("seg_id", "source", "reference")) -> DataFrame:
    """One row per segment and system; missing candidates are kept."""
    return wide.unpivot(list(keys), list(systems), "system", "text")


def to_wide(long: DataFrame, systems: Sequence[str],
            keys: Sequence[str] = ("seg_id", "source", "reference")) -> DataFrame:
    """One row per segment and a text column per named system."""
    per_system = [F.max(F.when(F.col("system") == s, F.col("text"))).alias(s) for s in systems]
    first, rest = keys[0], list(keys[1:])
    return (long.groupBy(first).agg(*[F.first(k).alias(k) for k in rest], *per_system)
            .select(*keys, *systems))


def fan_out(segments: DataFrame, systems: Sequence[str]) -> DataFrame:
    """Each segment once per system, before there are candidates; no shuffle."""
    return segments.select("*", F.explode(F.array(*map(F.lit, systems))).alias("system"))


def system_table(wide: DataFrame, system: str,
                 keys: Sequence[str] = ("seg_id", "source", "reference")) -> DataFrame:
    """The narrow table of one system."""
    return wide.select(*keys, system)


def resolve_attempts(attempts: DataFrame) -> DataFrame:
    """Settle each candidate: its first attempt other than a failure.

    A null is an answer, not a failure, so it ends the search. Where every
    attempt failed the candidate is a failure. Spark keeps one row per key
    before it shuffles, as only the first rank is asked for.
    """
    failed = F.coalesce(F.col("text") == FAILURE_TEXT, F.lit(False))
    order = Window.partitionBy("seg_id", "system").orderBy(failed, "attempt")
    first = (attempts.withColumn("rank", F.row_number().over(order))
             .where("rank = 1").drop("rank"))
    return with_status(first.select("seg_id", "system", "attempt", "text"))


def assign_slots(calls: DataFrame, position: Column, n_slots: int) -> DataFrame:
    """Add ``slot``: calls take ``n_slots`` credentials in turn, by position."""
    return calls.withColumn("slot", F.pmod(position, F.lit(n_slots)).cast("int"))


def failure_report(attempts: DataFrame) -> DataFrame:
    """Per system: candidates settled, missing and failed, and attempts in vain.

    Candidates are settled as in ``resolve_attempts``, here as one number per
    candidate, so that no text is shuffled: twice the first attempt that did
    not fail, plus one where its answer was null.
    """
    is_failed = F.coalesce(F.col("text") == FAILURE_TEXT, F.lit(False))
    answer = F.col("attempt") * 2 + F.col("text").isNull().cast("int")
    settled = attempts.groupBy("seg_id", "system").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_failed).alias("failed"),
        F.min(F.when(~is_failed, answer)).alias("answer"))
    is_missing = F.col("answer") % 2 == 1
    return settled.groupBy("system").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.count_if(~is_missing).alias("n_ok"),
        F.count_if(is_missing).alias("n_missing"),
        F.count_if(F.col("answer").isNull()).alias("n_error"),
        F.sum("n").alias("n_attempts"), F.sum("failed").alias("n_failed_attempts"))
