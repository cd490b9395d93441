"""Text functions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() takes for whitespace.
WHITESPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))

# the last byte of each of them, in UTF-8
LAST_BYTES = bytes(sorted({c.encode()[-1] for c in WHITESPACE}))

# The labels of the judge's input, in the language it is asked in.
PROMPT_LABELS = ("原文", "中文", "参考译文")
# Fixed value: how a missing text is printed inside a prompt.
MISSING_IN_PROMPT = "nan"


def strip(text: Column) -> Column:
    """Drop Unicode whitespace at both ends (Spark's ``trim`` drops spaces only)."""
    # the right end is looked at first, as trimming it takes two arrays as long as the whole text;
    # its last byte before its last character, as that is found by counting from the start
    left, space = F.ltrim(text, F.lit(WHITESPACE)), F.lit(WHITESPACE)
    last = F.substring(text.cast("binary"), -1, 1)
    ended = F.when(F.contains(space, F.substring(text, -1, 1)), F.rtrim(left, space)).otherwise(left)
    return F.when(F.contains(F.lit(LAST_BYTES), last), ended).otherwise(left)


def clean_text(text: Column) -> Column:
    """Line feeds to spaces, carriage returns away, then strip."""
    # both are whitespace, so the text may be stripped first, which reads it as it is;
    # replace skips a text without a hit, while translate looks up every character
    return F.replace(F.replace(strip(text), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))


def split_lines(text: Column) -> Column:
    """Lines of a text held in a column, under universal newlines.

    A terminator ends a line, so a final one starts no further line and an
    empty text has none.
    """
    # one plain character is looked for without a pattern
    parts = F.when(F.contains(text, F.lit("\r")), F.split(text, "\r\n|\r|\n")).otherwise(F.split(text, "\n"))
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def judge_prompt(source: Column, text: Column, reference: Column | None = None,
                 labels: Sequence[str] = PROMPT_LABELS) -> Column:
    """Input text for the judge; a missing field is printed, not dropped."""
    def shown(c: Column) -> Column:
        return F.coalesce(c, F.lit(MISSING_IN_PROMPT))

    parts = [F.lit(f"{labels[0]}: "), shown(source), F.lit(f";{labels[1]}: "), shown(text), F.lit(";")]
    if reference is not None:
        parts += [F.lit(f"{labels[2]}: "), shown(reference)]
    return F.concat(*parts)


def number_text(number: Column, missing: str | None = None) -> Column:
    """A number as text, whole ones without a fraction (``3`` rather than ``3.0``)."""
    whole = number == F.floor(number)
    shown = F.when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string"))
    return shown if missing is None else F.coalesce(shown, F.lit(missing))


def percent_text(share: Column) -> Column:
    """A share of 1 as a percentage with one decimal, for display only."""
    return F.format_string("%.1f%%", share * 100)


def digit_runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("([0-9]+)"), 1)


def count_marks(text: Column, marks: str) -> Column:
    """How many characters of ``text`` are among ``marks`` (none of ``]``, ``^``, ``-``)."""
    return F.regexp_count(text, F.lit(f"[{marks}]"))
