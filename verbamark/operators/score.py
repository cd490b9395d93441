"""Built-in scorers for the hooks, so that they work without a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.functions.chrf import chrf
from verbamark.functions.stats import cosine
from verbamark.operators.hooks import apply_scorer


def score_with_reference(inputs: DataFrame, tasks: int | None = None) -> DataFrame:
    """Character n-gram F-score of ``mt`` against ``ref``."""
    return apply_scorer(inputs, lambda: chrf, ("mt", "ref"), tasks=tasks)


def score_reference_free(vectors: DataFrame, source: str = "source_vector",
                         candidate: str = "candidate_vector") -> DataFrame:
    """Cosine of the caller's source and candidate vectors."""
    return vectors.withColumn("score", cosine(F.col(source), F.col(candidate)))
