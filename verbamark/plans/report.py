"""The tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from verbamark.operators.breakdown import count_errors, error_names, error_shares
from verbamark.operators.scores import model_comparison, score_series, series_at_width, system_averages
from verbamark.plans.metrics import METRICS
from verbamark.schemas import TYPOLOGY


def chart_tables(scores: DataFrame, judgements: DataFrame, metrics: Sequence[str] = METRICS,
                 with_average: bool = True, typology=TYPOLOGY, match: str = "exact",
                 width: int | None = None) -> dict[str, DataFrame]:
    """Line, bar, grouped-bar and two-ring chart data; pass staged inputs.

    With ``width`` there is also ``score_pixels``, the points that a line
    chart of so many pixel columns shows.
    """
    pixels = {} if width is None else {"score_pixels": series_at_width(scores, width)}
    return pixels | {
        "score_series": score_series(scores, with_average),
        "system_averages": system_averages(scores),
        "model_comparison": model_comparison(scores, metrics),
        "error_shares": error_shares(count_errors(error_names(judgements), typology, match)),
    }
