"""Judge input, and judge replies as nested error reports."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbamark.functions.text import PROMPT_LABELS, WHITESPACE, clean_text, judge_prompt, number_text
from verbamark.schemas import ERROR, SCORE_RANGE, SENT_ARGS, SEVERITY_RANGE, read_args

# a report without one of these is void; only the severity may be absent
REQUIRED = ("source_chunk", "target_chunk", "reference_chunk", "error_type", "explanation")
CLEANED = ("source_chunk", "target_chunk", "reference_chunk", "explanation")
# the texts that an export shows beside the types
EXPORTED = ("explanation",)
# closes the text of a reply, so that nothing behind its first value is passed over
CLOSING = "end of reply"


def judge_prompts(candidates: DataFrame, with_reference: bool = True,
                  labels: Sequence[str] = PROMPT_LABELS) -> DataFrame:
    prompt = judge_prompt(F.col("source"), F.col("text"),
                          F.col("reference") if with_reference else None, labels)
    return candidates.select("seg_id", "system", prompt.alias("prompt"))


def _closed(text: Column) -> Column:
    """The text as the first of two values of a list.

    Spark reads the first value of a text and passes over the rest; within a
    list that has to end as it should, the rest is an error.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f', "{CLOSING}"]')))


def _is_whole(closed: Column) -> Column:
    # counted by reading each value as what none of them is, which copies nothing; a path to a third
    # value that is not there, as in nearly every reply, would cost an exception inside Spark
    values = F.size(F.try_variant_get(closed, "$", "array<struct<none:boolean>>"))
    return (values == 2) & (F.try_variant_get(closed, "$[1]", "string") == CLOSING)


def _first(replies: DataFrame, args: T.StructType) -> DataFrame:
    """``(seg_id, system, reply, args, score)`` of the first tool call, its arguments read as ``args``."""
    # generated rather than projected: a filter on what is read from the calls
    # would otherwise be pushed below, and parse every reply once more
    parsed = replies.select("seg_id", "system", "tool_calls",
                            F.inline_outer(F.array(F.struct(_closed(F.col("tool_calls")).alias("closed")))))

    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("closed", path, kind)

    # every part of the reply is read at most once, a call as a whole only where it has no arguments
    # and the whole list only where it has no first call
    reply = (F.when(F.col("tool_calls").isNull(), "missing")
             .when(~F.coalesce(_is_whole(F.col("closed")), F.lit(False)), "garbage")
             .when(F.col("args").isNotNull() | get("$[0][0]", "variant").isNotNull(), "report")
             .when(get("$[0]", "array<variant>").isNotNull(), "empty").otherwise("garbage"))
    first = (parsed.withColumn("args", get("$[0][0].args", args.simpleString()))
             .select("seg_id", "system", reply.alias("reply"), "args")
             .withColumn("args", F.when(F.col("reply") == "report", F.col("args"))))
    given = F.col("args.scores")
    score = F.when(F.is_variant_null(given), 0.0).otherwise(F.try_variant_get(given, "$", "double"))
    return first.select("seg_id", "system", "reply", "args", F.when(F.col("args").isNotNull(), score).alias("score"))


def first_report(replies: DataFrame) -> DataFrame:
    """The first tool call of each reply, later ones ignored.

    ``reply`` tells an answer that is no list (``garbage``), or has text behind
    the list, from an empty list (``empty``) and from none at all
    (``missing``). A score given as null is 0. The errors are as they came.
    """
    report = F.struct(F.col("args.errors").alias("errors"), F.col("score").alias("scores"))
    return _first(replies, SENT_ARGS).select(
        "seg_id", "system", "reply", F.when(F.col("args").isNotNull(), report).alias("report"))


def _complete(error: Column, read: Collection[str]) -> Column:
    """Whether all required fields are there and are texts; of those that are not read the kind alone is looked at."""
    return reduce(and_, [error[field].isNotNull() if field in read else F.schema_of_variant(error[field]) == "STRING"
                         for field in REQUIRED])


def _text(sent: Column) -> Column:
    return sent.cast("string")


def _severity(sent: Column) -> Column:
    """The number, also one sent as text; null if absent, null or no number."""
    return F.try_variant_get(sent, "$", "double")


def _severity_sent(sent: Column) -> Column:
    return F.try_variant_get(sent, "$", "string")


def _cleaned(error: Column, read: Collection[str]) -> Column:
    fields = {f.name: _severity(error[f.name]) if f.name == "severity" else
              clean_text(_text(error[f.name])) if f.name in CLEANED else _text(error[f.name])
              for f in ERROR if f.name == "severity" or f.name in read}
    return F.struct(*[c.alias(name) for name, c in fields.items()],
                    _severity_sent(error["severity"]).alias("severity_sent"))


def parse_reports(replies: DataFrame, strict: bool = True, texts: bool | Collection[str] = True) -> DataFrame:
    """Replies as ``(seg_id, system, status, errors, score)``.

    ``strict`` takes a report whole or not at all: one incomplete error or an
    absent score makes it ``void``. Otherwise incomplete errors are left out
    and an absent score stays null. A required field that is no text counts as
    absent. A severity that is no number is null, has no weight and is flagged
    by ``report_validity``; ``severity_sent`` has it as it came. Without a usable report ``errors`` and
    ``score`` are null. Values out of range are kept as they came. Without
    ``texts`` the errors hold their type and severity only, which is all that
    counts and averages read; named texts (of ``CLEANED``) are held beside them.
    """
    errors, score = F.col("args.errors"), F.col("score")
    read = ("error_type", *((CLEANED if texts else ()) if isinstance(texts, bool) else texts))
    if unknown := set(read[1:]) - set(CLEANED):
        raise ValueError(f"no texts of an error: {sorted(unknown)}")
    args = read_args(read)

    def complete(error: Column) -> Column:
        return _complete(error, read)

    if strict:
        kept = errors
        usable = score.isNotNull() & errors.isNotNull() & F.forall(errors, complete)
    else:
        kept = F.coalesce(F.filter(errors, complete), F.array().cast(args["errors"].dataType))
        usable = F.col("args").isNotNull()
    status = (F.when(F.col("reply") != "report", F.col("reply"))
              .when(usable, "ok").otherwise("void"))
    judged = _first(replies, args).withColumn("status", status)
    ok = F.col("status") == "ok"
    return judged.select(
        "seg_id", "system", "status",
        F.when(ok, F.transform(kept, lambda e: _cleaned(e, read))).alias("errors"),
        F.when(ok, score).alias("score"))


def with_defaults(judgements: DataFrame, on_failure: str = "zero") -> DataFrame:
    """No report counts as no errors and, unless ``on_failure='null'``, score 0."""
    if on_failure not in ("zero", "null"):
        raise ValueError(f"on_failure must be 'zero' or 'null', not {on_failure!r}")
    none = F.array().cast(judgements.schema["errors"].dataType)
    filled = {"errors": F.coalesce("errors", none),
              "status": F.coalesce("status", F.lit("missing"))}
    if on_failure == "zero":
        filled["score"] = F.coalesce("score", F.lit(0.0))
    return judgements.withColumns(filled)


def attach_judgements(candidates: DataFrame, judgements: DataFrame,
                      on_failure: str = "zero") -> DataFrame:
    """Every candidate with its judgement, or the defaults where it has none."""
    found = judgements.withColumnRenamed("status", "report_status")
    joined = candidates.join(found, ["seg_id", "system"], "left")
    renamed = joined.withColumnRenamed("status", "text_status") if "status" in candidates.columns else joined
    return with_defaults(renamed.withColumnRenamed("report_status", "status"), on_failure)


def report_validity(judgements: DataFrame) -> DataFrame:
    """Flag values outside the declared ranges, and severities that are no numbers; nothing is clamped."""
    def bad(e: Column) -> Column:
        unread = e["severity"].isNull() & e["severity_sent"].isNotNull()
        return unread | F.coalesce(~e["severity"].between(*map(F.lit, SEVERITY_RANGE)), F.lit(False))

    outside = F.filter("errors", bad)
    in_range = F.col("score").between(*map(F.lit, SCORE_RANGE))
    ok = F.col("status") == "ok"
    return judgements.select(
        "seg_id", "system", "status",
        F.when(ok, F.size("errors")).alias("n_errors"),
        F.when(ok, F.size(outside)).alias("n_bad_severity"),
        F.when(ok, in_range).alias("score_in_range"),
        (ok & F.coalesce(in_range, F.lit(False)) & (F.size(outside) == 0)).alias("valid"))


def export_judgements(judgements: DataFrame, on_failure: str = "zero") -> DataFrame:
    """Flat text columns, one row per judgement, for people to read."""
    filled = with_defaults(judgements, on_failure)
    severities = F.transform("errors", lambda e: F.coalesce(e["severity_sent"], number_text(e["severity"], missing="None")))
    return filled.select(
        "seg_id", "system",
        F.array_join("errors.error_type", ", ").alias("error_type"),
        F.array_join(severities, ", ").alias("severity"),
        F.array_join("errors.explanation", "\n").alias("explanation"),
        "score")


def severity_score(errors: Column, tolerance: int = 5) -> Column:
    """1 without errors, down to 0 at ``tolerance`` errors of the top severity.

    Null where the list of errors is: ``greatest`` alone would make that a 0.
    """
    total = F.aggregate(errors, F.lit(0.0), lambda t, e: t + F.coalesce(e["severity"], F.lit(0.0)))
    score = F.greatest(F.lit(0.0), 1 - total / F.lit(float(SEVERITY_RANGE[1] * tolerance)))
    return F.when(errors.isNotNull(), score)
