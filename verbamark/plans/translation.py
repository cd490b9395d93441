"""From two aligned corpora to stored candidates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.operators.align import align, aligned_only
from verbamark.operators.candidates import resolve_attempts, to_wide
from verbamark.operators.hooks import Translator, apply_translators
from verbamark.plans.timing import RunMetrics
from verbamark.schemas import FAILURE_TEXT
from verbamark.sources.tables import write_candidates


def translate_corpus(source: DataFrame, reference: DataFrame, translators: Mapping[str, Translator],
                     *, position: str | None = None, strict: bool = True,
                     metrics: RunMetrics | None = None, **hook: object) -> tuple[DataFrame, DataFrame]:
    """``(candidates, attempts)`` of every system for every aligned segment.

    Attempts are staged, so that nothing read from them calls a service again.
    ``metrics`` counts segments and attempts.
    """
    run = metrics or RunMetrics()
    segments = aligned_only(align(source, reference, position, strict))
    attempts = run.staged("translation", apply_translators(run.reads("translation", segments), translators, **hook),
                          F.col("text") == FAILURE_TEXT, "attempts")
    settled = resolve_attempts(attempts)
    return segments.join(settled, "seg_id"), attempts


def store_candidates(candidates: DataFrame, systems: list[str], directory: str) -> None:
    """Write the wide and the per-system form of ``candidates``."""
    kept = candidates.select("seg_id", "source", "reference", "system", "text", "status")
    write_candidates(to_wide(kept, systems), kept, directory)
