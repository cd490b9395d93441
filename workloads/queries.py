"""The registered queries: each runs one operator over whole tables.

Means are rounded to six places here, and only here, as engines add doubles
up in different orders.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verbamark.functions.text import clean_text
from verbamark.operators import align as al
from verbamark.operators import breakdown as bd
from verbamark.operators import candidates as ca
from verbamark.operators import judge as ju
from verbamark.operators import score as sc
from verbamark.operators import scores as st
from verbamark.operators.annotate import annotate
from verbamark.operators.hooks import apply_translators
from verbamark.plans.metrics import METRICS, REFERENCE_FREE, WITH_REFERENCE, metric_scorecard
from verbamark.plans.mqm import judge_candidates, mqm_scorecard
from verbamark.schemas import typology_table
from verbamark.sources.lines import lines_of
from workloads import inputs as i

N_SLOTS, N_KEYS = 4, 3
CHART_WIDTH = 500


def _r(column: str | Column, name: str | None = None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, 6).alias(name or column)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


def _round_where(df, condition, *columns):
    """Round means only; a row's own score is exact in both engines."""
    return df.withColumns({c: F.when(condition, F.round(F.col(c), 6)).otherwise(F.col(c)) for c in columns})


def _sides(spark, d):
    lines = i.lines(spark, d)
    return [lines.where(F.col("corpus") == c) for c in ("source", "reference")]


def line_scan(spark, d):
    return lines_of(i.table(spark, d, "documents"), "text", "doc_id")


def clean(spark, d):
    return i.table(spark, d, "documents").select("doc_id", clean_text(F.col("text")).alias("text"))


def align_segments(spark, d):
    numbered = al.number_texts(i.corpora(spark, d))
    return al.align(*[numbered.where(F.col("corpus") == c) for c in ("source", "reference")])


def alignment_check(spark, d):
    return al.alignment_check(*_sides(spark, d))


def candidates_long(spark, d):
    return i.candidates(spark, d)


def system_projection(spark, d):
    return ca.system_table(i.wide(spark, d), "sys_3")


def resolve_attempts(spark, d):
    return ca.resolve_attempts(i.attempts(spark, d))


def quota_slots(spark, d):
    calls = i.raw_candidates(spark, d).select("seg_id", "system")
    ordinal = F.array_position(F.array(*map(F.lit, i.SYSTEMS)), F.col("system"))
    return ca.assign_slots(calls, F.col("seg_id") * len(i.SYSTEMS) + ordinal, N_SLOTS)


def failure_report(spark, d):
    return ca.failure_report(i.attempts(spark, d))


def typology_dim(spark, d):
    """The typology with how often the judged errors fall on each type."""
    used = bd.count_errors(_names(spark, d)).groupBy("error_type").agg(F.sum("n_errors").alias("n_errors"))
    return typology_table(spark).join(used, "error_type", "left").fillna(0, ["n_errors"])


def category_members(spark, d):
    return bd.category_members(bd.count_errors(_names(spark, d)))


def judge_prompts(spark, d):
    return ju.judge_prompts(i.candidates(spark, d))


def _judged(spark, d, strict=True, texts=False):
    return ju.parse_reports(i.replies(spark, d), strict, texts)


def _names(spark, d):
    return bd.error_names(_judged(spark, d))


def parse_reports(spark, d):
    """One row per parsed error; reports without errors keep a row of nulls."""
    judged = _judged(spark, d, texts=True)
    return (judged.select("seg_id", "system", "status", "score", F.posexplode_outer("errors").alias("at", "e"))
            .select("seg_id", "system", "status", "score", "at", "e.*"))


def first_report(spark, d):
    first = ju.first_report(i.replies(spark, d))
    return first.select("seg_id", "system", "reply", F.size("report.errors").alias("n_errors"),
                        F.col("report.scores").alias("score"))


def report_validity(spark, d):
    return ju.report_validity(_judged(spark, d))


def judged_defaults(spark, d):
    # judgements of replies that gave a report; the join fills in the others
    usable = _judged(spark, d).where(F.col("status") == "ok")
    joined = ju.attach_judgements(i.candidates(spark, d), usable)
    return joined.select("seg_id", "system", "text_status", "status", F.size("errors").alias("n_errors"), "score")


def judged_export(spark, d):
    return ju.export_judgements(_judged(spark, d, texts=ju.EXPORTED))


def error_breakdown(spark, d):
    return bd.error_breakdown(_names(spark, d))


def error_breakdown_dense(spark, d):
    return bd.error_breakdown_dense(_names(spark, d), i.SYSTEMS)


def error_breakdown_from_text(spark, d):
    return bd.error_breakdown(bd.error_names_from_text(ju.export_judgements(_judged(spark, d, texts=ju.EXPORTED))))


def error_breakdown_trimmed(spark, d):
    return bd.error_breakdown(_names(spark, d), match="trimmed")


def error_breakdown_lenient(spark, d):
    return bd.error_breakdown(bd.error_names(_judged(spark, d, strict=False)))


def unknown_error_types(spark, d):
    return bd.unknown_error_types(_names(spark, d))


def category_totals(spark, d):
    return bd.category_totals(bd.count_errors(_names(spark, d)))


def error_shares(spark, d):
    return _rounded(bd.error_shares(bd.count_errors(_names(spark, d))), "category_share", "error_share")


def system_averages(spark, d):
    judged = ju.with_defaults(_judged(spark, d))
    return _rounded(st.system_averages(st.judgement_scores(judged)), "mean_score")


def _table(spark, d, metric):
    return st.score_table(i.wide(spark, d), i.scores(spark, d), metric, i.SYSTEMS)


def numeric_means(spark, d):
    means = st.numeric_means(_table(spark, d, WITH_REFERENCE))
    return _rounded(means, *means.columns)


def score_table_wide(spark, d):
    return _table(spark, d, REFERENCE_FREE)


def score_table_with_average(spark, d):
    whole = st.score_table_with_average(i.wide(spark, d), i.scores(spark, d), METRICS[0], i.SYSTEMS, fill="")
    return _round_where(whole, F.col("seg_id").isNull(), *st.suffix_columns(whole))


def score_series(spark, d):
    series = st.score_series(i.scores(spark, d), with_average=True)
    return _round_where(series, F.col("is_average"), "score")


def model_comparison(spark, d):
    return _rounded(st.model_comparison(i.scores(spark, d), METRICS), *METRICS)


def scoring_input_ref(spark, d):
    return st.scoring_input(i.candidates(spark, d))


def scoring_input_noref(spark, d):
    return st.scoring_input(i.candidates(spark, d), with_reference=False)


def rule_annotations(spark, d):
    judged = annotate(i.candidates(spark, d))
    return judged.select("seg_id", "system", F.array_join("errors.error_type", "|").alias("error_types"),
                         F.size("errors").alias("n_errors"), _r("score"))


def rule_breakdown(spark, d):
    """The breakdown over the built-in rules' reports."""
    return bd.error_breakdown(bd.error_names(annotate(i.candidates(spark, d))))


def severity_score(spark, d):
    judged = _judged(spark, d)
    return judged.select("seg_id", "system", _r(ju.severity_score(F.col("errors")), "severity_score"))


def score_with_reference(spark, d):
    scored = sc.score_with_reference(st.scoring_input(i.candidates(spark, d)))
    return scored.select("seg_id", "system", _r("score"))


def score_reference_free(spark, d):
    scored = sc.score_reference_free(i.vectors(spark, d))
    return scored.select("vec_id", _r("score"))


def hooked_attempts(spark, d):
    """Attempts of two translators, one of which fails on some slots."""
    def flaky(source: str, slot: int) -> str | None:
        turn = (len(source) + slot) % N_KEYS
        if turn == 0:
            raise ConnectionError("busy")
        if turn == 1:
            return "Error"
        return None if len(source) % 7 == 0 else f"{source} ({slot})"

    translators = {"steady": lambda source, slot: f"{source}!", "flaky": flaky}
    return apply_translators(i.segments(spark, d), translators, slots=N_KEYS)


def hooked_judgements(spark, d):
    """Every candidate with the judgement of a judge that reads no more than its prompt's length."""
    names = i.NAMES

    def judge(prompt: str, slot: int) -> list:
        n = len(prompt)
        if n % 11 == 0:
            raise RuntimeError("quota")
        if n % 13 == 0:
            return []
        if n % 17 == 0:
            raise ValueError("odd")
        error = {"source_chunk": "s", "target_chunk": "t", "reference_chunk": "r", "error_type": names[n % 7],
                 "severity": n % 12, "explanation": "e"}
        return [{"name": "ErrorReport", "args": {"errors": [error] if n % 3 else [], "scores": n % 10 / 10}}]

    judged = judge_candidates(i.candidates(spark, d), judge, retry_on=lambda e: "quota" in str(e))
    return judged.select("seg_id", "system", "text_status", "status", "score", F.size("errors").alias("n_errors"),
                         F.get("errors.error_type", F.lit(0)).alias("error_type"), "judge_calls", "judge_error")


def score_pixels(spark, d):
    return st.series_at_width(i.scores(spark, d), CHART_WIDTH)


def mqm_card(spark, d):
    return _rounded(mqm_scorecard(_judged(spark, d)), "mean_score")


def metric_card(spark, d):
    return _rounded(metric_scorecard(i.scores(spark, d)), *[f"{m}_mean" for m in METRICS])


QUERIES = {
    "line_scan": line_scan,
    "clean_text": clean,
    "align_segments": align_segments,
    "alignment_check": alignment_check,
    "candidates_long": candidates_long,
    "system_projection": system_projection,
    "resolve_attempts": resolve_attempts,
    "quota_slots": quota_slots,
    "failure_report": failure_report,
    "typology_dim": typology_dim,
    "category_members": category_members,
    "judge_prompts": judge_prompts,
    "parse_reports": parse_reports,
    "first_report": first_report,
    "report_validity": report_validity,
    "judged_defaults": judged_defaults,
    "judged_export": judged_export,
    "error_breakdown": error_breakdown,
    "error_breakdown_dense": error_breakdown_dense,
    "error_breakdown_from_text": error_breakdown_from_text,
    "error_breakdown_trimmed": error_breakdown_trimmed,
    "error_breakdown_lenient": error_breakdown_lenient,
    "unknown_error_types": unknown_error_types,
    "category_totals": category_totals,
    "error_shares": error_shares,
    "system_averages": system_averages,
    "numeric_means": numeric_means,
    "score_table_wide": score_table_wide,
    "score_table_with_average": score_table_with_average,
    "score_series": score_series,
    "model_comparison": model_comparison,
    "scoring_input_ref": scoring_input_ref,
    "scoring_input_noref": scoring_input_noref,
    "rule_annotations": rule_annotations,
    "rule_breakdown": rule_breakdown,
    "severity_score": severity_score,
    "score_with_reference": score_with_reference,
    "score_reference_free": score_reference_free,
    "hooked_attempts": hooked_attempts,
    "hooked_judgements": hooked_judgements,
    "score_pixels": score_pixels,
    "mqm_scorecard": mqm_card,
    "metric_scorecard": metric_card,
}
