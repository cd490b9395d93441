"""Rule-based error reports, for use where no judge is at hand.

An addition of this library: it fills the report format from rules about the
texts and does not imitate any language model's judgement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbamark.functions.text import count_marks, digit_runs, strip
from verbamark.operators.judge import severity_score
from verbamark.schemas import ERROR

MARKS = ".,;:!?"
SHORTEST, LONGEST = 0.7, 1.3  # length bounds, as a share of the reference's


def _rules(source: Column, text: Column, reference: Column) -> list[tuple[str, int, str, Column]]:
    """Name, severity and explanation of each rule, and whether it holds."""
    missing = F.coalesce(strip(text), F.lit("")) == ""
    ratio = F.length(text) / F.length(reference)
    comparable = ~missing & (F.length(reference) > 0)
    differs = ~missing & (text != reference)  # spares equal texts the patterns
    return [
        ("Missing Text", 10, "no text", missing),
        ("Untranslated", 9, "same as the source", ~missing & (text == source)),
        ("Omission", 6, "much shorter than the reference", comparable & (ratio < SHORTEST)),
        ("Addition", 4, "much longer than the reference", comparable & (ratio > LONGEST)),
        ("Number Format", 5, "numbers differ from the reference",
         differs & (digit_runs(text) != digit_runs(reference))),
        ("Punctuation", 2, "punctuation count differs from the reference",
         differs & (count_marks(text, MARKS) != count_marks(reference, MARKS))),
        ("Character Encoding ", 7, "holds a replacement character",
         ~missing & F.contains(text, F.lit("\ufffd"))),
    ]


def rules_held(source: Column, text: Column, reference: Column) -> Column:
    """Numbers of the rules that hold for a candidate, which ``rule_errors`` takes."""
    none = F.array().cast("array<int>")
    rules = _rules(source, text, reference)
    return F.concat(*[F.when(holds, F.array(F.lit(k))).otherwise(none) for k, (*_, holds) in enumerate(rules)])


def rule_errors(held: Column, source: Column, text: Column, reference: Column) -> Column:
    """Errors a candidate shows against its source and reference, for the rules that hold."""
    facts = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(severity)).alias("severity"),
                               F.lit(why).alias("why")) for name, severity, why, _ in _rules(source, text, reference)])

    def error(k: Column) -> Column:
        fact = F.get(facts, k)
        values = {"source_chunk": source, "target_chunk": F.coalesce(text, F.lit("")), "reference_chunk": reference,
                  "error_type": fact["name"], "severity": fact["severity"], "explanation": fact["why"]}
        return F.struct(*[values[f.name].alias(f.name) for f in ERROR], F.lit(None).cast("string").alias("severity_sent"))

    # held is read twice, so it stays a column of its own: its rules are then compiled and share
    # their parts, while all that stands inside a transform is interpreted, each part again
    errors = F.transform(held, error)
    return F.when(F.size(held) > 0, errors).otherwise(F.slice(errors, 1, 0))


def annotate(candidates: DataFrame, tolerance: int = 5) -> DataFrame:
    """Judgements from the rules: ``(seg_id, system, status, errors, score)``."""
    texts = [F.col(c) for c in ("source", "text", "reference")]
    judged = (candidates.select("seg_id", "system", *texts, rules_held(*texts).alias("_held"))
              .select("seg_id", "system", F.lit("ok").alias("status"), rule_errors(F.col("_held"), *texts).alias("errors")))
    return judged.withColumn("score", severity_score(F.col("errors"), tolerance))
