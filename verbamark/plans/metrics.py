"""The metric evaluation: scores with and without reference, and their tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.functions.stats import known, mean
from verbamark.operators.hooks import apply_scorer
from verbamark.operators.scores import score_table_with_average, scoring_input
from verbamark.plans.timing import RunMetrics
from verbamark.sources.tables import append_tables

WITH_REFERENCE, REFERENCE_FREE = "reference_based", "reference_free"
METRICS = ("MQM_reference", WITH_REFERENCE, REFERENCE_FREE)
# Fixed value: rows a model is given at a time.
BATCH_ROWS = 8

Loader = Callable[[], Callable[..., pd.Series]]


def score_candidates(candidates: DataFrame, scorers: Mapping[str, tuple[Loader, bool]], *,
                     batch_rows: int | None = BATCH_ROWS, score_failures: bool = False,
                     tasks: int | None = None, metrics: RunMetrics | None = None) -> DataFrame:
    """Long scores of each named scorer, given as ``(loader, takes_reference)``.

    Scores are staged, as models are dear. Every candidate has a row per
    metric. ``status`` says how it came by its score: ``ok``, ``missing`` (the
    model gave none), ``error`` (the model failed on this row, ``error`` says
    how) or ``no text`` (it was not given to the model).
    """
    scored = None
    for metric, (load, takes_reference) in scorers.items():
        inputs = scoring_input(candidates, takes_reference, score_failures)
        columns = ("src", "mt", "ref") if takes_reference else ("src", "mt")
        part = (apply_scorer(inputs, load, columns, batch_rows=batch_rows, tasks=tasks, outcome=True)
                .select("seg_id", "system", F.lit(metric).alias("metric"), "score",
                        F.col("score_status").alias("status"), F.col("score_error").alias("error")))
        scored = part if scored is None else scored.unionByName(part)
    if not score_failures:
        metric = F.explode(F.array(*map(F.lit, scorers))).alias("metric")
        scored = scored.unionByName(
            candidates.where(F.col("text").isNull())
            .select("seg_id", "system", metric, F.lit(None).cast("double").alias("score"),
                    F.lit("no text").alias("status"), F.lit(None).cast("string").alias("error")))
    return (metrics or RunMetrics()).staged("scoring", scored, F.col("status") == "error", "scores")


def metric_scorecard(scores: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per system: how many segments each metric scored, and their mean."""
    score = known(F.col("score"))
    columns = []
    for m in metrics:
        of_metric = F.when(F.col("metric") == m, score)
        columns += [F.count(of_metric).alias(f"{m}_n"), mean(of_metric).alias(f"{m}_mean")]
    return scores.groupBy("system").agg(*columns)


def store_metrics(wide: DataFrame, scores: DataFrame, systems: Sequence[str], directory: str,
                  metrics: Sequence[str] = (WITH_REFERENCE, REFERENCE_FREE)) -> None:
    """Add each metric's score table, with its average row, to an existing store."""
    append_tables({m: score_table_with_average(wide, scores, m, systems) for m in metrics}, directory)
