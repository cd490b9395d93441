"""Positional alignment of a source corpus with a reference corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from verbamark.functions.text import split_lines, strip
from verbamark.operators.positions import BITS, prefix_sums
from verbamark.session import discard, stage


class AlignmentError(ValueError):
    """The two sides differ in their number of lines."""


def number_across(lines: DataFrame, unit: str = "doc_id", line: str = "line_no",
                  corpus: str = "corpus", bits: int = BITS) -> DataFrame:
    """Add ``position``: the 1-based line number over all units of a corpus.

    ``unit`` is an integer key that orders the texts of a corpus, ``line`` the
    number of a line in its text. Only ``(unit, count)`` rows are summed, by
    levels of key ranges (``prefix_sums``). The counts are staged, so that the
    texts are read once for them however often the positions are used. Where
    the texts are still whole, ``number_texts`` moves less.
    """
    counts = stage(lines.groupBy(corpus, unit).agg(F.count(F.lit(1)).alias("n")), "line-counts")
    starts = prefix_sums(counts, [corpus], unit, "n", bits).drop("n")
    return (lines.join(starts, [corpus, unit])
            .withColumn("position", F.col("before") + F.col(line)).drop("before"))


def number_texts(texts: DataFrame, text: str = "text", unit: str = "doc_id", corpus: str = "corpus",
                 bits: int = BITS) -> DataFrame:
    """Lines of whole texts as ``(corpus, unit, line_no, position, text)``, numbered as by ``number_across``.

    A text gets the number of lines before it while it is whole, so no line is
    moved to be numbered. ``unit`` must name one text of a corpus; a null or
    empty text has no lines.
    """
    pieces = texts.select(corpus, unit, split_lines(F.col(text)).alias("_lines"))
    counts = stage(pieces.select(corpus, unit, F.greatest(F.size("_lines"), F.lit(0)).cast("long").alias("n")), "line-counts")
    starts = prefix_sums(counts, [corpus], unit, "n", bits).select(corpus, unit, "before")
    lines = pieces.join(starts, [corpus, unit]).select(corpus, unit, "before", F.posexplode("_lines").alias("_at", "_line"))
    line_no = (F.col("_at") + 1).cast("bigint")
    return lines.select(corpus, unit, line_no.alias("line_no"), (F.col("before") + line_no).alias("position"),
                        strip(F.col("_line")).alias("text"))


def align_corpora(lines: DataFrame, source: str = "source", reference: str = "reference", corpus: str = "corpus",
                  position: str = "position") -> DataFrame:
    """``align`` of two corpora that lie in one frame, read once and shuffled once."""
    def of(name: str):
        return F.max(F.when(F.col(corpus) == name, F.struct("text"))).alias(name)

    pairs = lines.where(F.col(corpus).isin(source, reference)).groupBy(F.col(position).alias("seg_id")).agg(of(source), of(reference))
    side = (F.when(F.col(reference).isNull(), "source_only")
            .when(F.col(source).isNull(), "reference_only").otherwise("both"))
    return pairs.select("seg_id", F.col(f"{source}.text").alias("source"), F.col(f"{reference}.text").alias("reference"),
                        side.alias("side"))


def align(source: DataFrame, reference: DataFrame, position: str | None = None,
          strict: bool = False) -> DataFrame:
    """Pair the n-th source line with the n-th reference line.

    ``position`` is the column that numbers the lines of a corpus: if not
    named, ``position`` where both sides have it, else ``line_no``. Returns ``(seg_id, source, reference, side)``. Lines beyond the shorter
    side are kept, marked ``source_only`` or ``reference_only``; ``strict``
    raises instead. It writes the pairs, counts both sides as it does so, and
    goes on from what was written, so that nothing is read only to be counted.
    """
    if position is None:
        position = "position" if {"position"} <= set(source.columns) & set(reference.columns) else "line_no"
    s = source.select(F.col(position).alias("seg_id"), F.col("text").alias("source"),
                      F.lit(True).alias("in_source"))
    r = reference.select(F.col(position).alias("seg_id"), F.col("text").alias("reference"),
                         F.lit(True).alias("in_reference"))
    side = (F.when(F.col("in_reference").isNull(), "source_only")
            .when(F.col("in_source").isNull(), "reference_only").otherwise("both"))
    paired = s.join(r, "seg_id", "full_outer").select("seg_id", "source", "reference", side.alias("side"))
    return _strictly(paired) if strict else paired


def _strictly(paired: DataFrame) -> DataFrame:
    counts = Observation()
    written = stage(paired.observe(counts, F.count_if(F.col("side") != "reference_only").alias("n_source"),
                                   F.count_if(F.col("side") != "source_only").alias("n_reference")), "aligned")
    n = counts.get
    if n["n_source"] != n["n_reference"]:
        discard(written)
        raise AlignmentError(f"source has {n['n_source']} lines, reference has {n['n_reference']}")
    return written


def aligned_only(aligned: DataFrame) -> DataFrame:
    """The pairs proper, as a zip of both sides would give them."""
    return aligned.where(F.col("side") == "both").select("seg_id", "source", "reference")


def alignment_check(source: DataFrame, reference: DataFrame) -> DataFrame:
    """One row of line counts: per side, paired, left over, and whether they agree."""
    sides = source.select(F.lit("s").alias("side")).unionAll(reference.select(F.lit("r").alias("side")))
    n_source, n_reference = F.count_if(F.col("side") == "s"), F.count_if(F.col("side") == "r")
    counted = sides.agg(n_source.alias("n_source"), n_reference.alias("n_reference"))
    n_aligned = F.least("n_source", "n_reference")
    return counted.select(
        "n_source", "n_reference", n_aligned.alias("n_aligned"),
        (F.col("n_source") - n_aligned).alias("n_source_only"),
        (F.col("n_reference") - n_aligned).alias("n_reference_only"),
        (F.col("n_source") == F.col("n_reference")).alias("equal_length"),
    )


def require_aligned(source: DataFrame, reference: DataFrame) -> None:
    counts = alignment_check(source, reference).first()
    if not counts["equal_length"]:
        raise AlignmentError(
            f"source has {counts['n_source']} lines, reference has {counts['n_reference']}")
