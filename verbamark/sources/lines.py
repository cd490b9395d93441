"""Text as numbered lines: from files, and from a text column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbamark.functions.text import split_lines, strip
from verbamark.operators.positions import prefix_sums
from verbamark.session import stage


MAX_SPLITS_BROADCAST = 200_000
MOVED = "the splits of the files changed while their lines were numbered"


def read_lines(spark: SparkSession, corpora: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Stripped lines of UTF-8 files as ``(corpus, file, line_no, position, text)``.

    ``corpora`` names each corpus and its paths. ``line_no`` counts from 1 in
    each file, blank lines included, ``position`` over all files of the corpus
    in the given order, those of a folder or pattern by name. A path named
    twice is refused, as its lines could not be told apart.

    Files are read in splits, once for the number of lines of each split and
    once for the lines. The counts are summed over the splits of a file and
    over the files of a corpus; a line's number is the sum before its split
    plus its distance from the split's first row, so no line is moved or
    written. Row ids within a split would shift if Spark packed the splits
    otherwise the second time; a line beyond its split's count would be the
    result, and is an error.
    """
    whole = None
    for corpus, paths in corpora.items():
        given = [paths] if isinstance(paths, str) else list(paths)
        if len(set(given)) < len(given):
            raise ValueError(f"a path of {corpus!r} is named more than once")
        rows = _scan(spark, given)
        numbered = _numbered(rows, _starts(rows, _in_order(spark, given)))
        lines = numbered.select(F.lit(corpus).alias("corpus"), "file", "line_no", "position", "text")
        whole = lines if whole is None else whole.unionByName(lines)
    return whole


def _scan(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_id"), strip(F.col("value")).alias("text"))


def _in_order(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(file, file_no)`` of all files of a corpus; their names are on the driver anyway, as Spark lists them there."""
    seen: dict[str, int] = {}
    for path in paths:
        # a local file's address has one slash in a row's metadata and three in the listing
        for file in sorted(re.sub("^file:/+", "file:/", f) for f in spark.read.text(path).inputFiles()):
            if file in seen:
                raise ValueError(f"{file} belongs to more than one path of its corpus")
            seen[file] = len(seen)
    return spark.createDataFrame(list(seen.items()), "file string, file_no long")


def _starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Per split its first row id, its number of lines, and the lines before it in its file and its corpus."""
    splits = stage(rows.groupBy("file", "split_start").agg(F.min("row_id").alias("first_id"), F.count("*").alias("n")), "splits")
    in_file = prefix_sums(splits, ["file"], "split_start", "n").withColumnRenamed("before", "in_file")
    sizes = splits.groupBy("file").agg(F.sum("n").alias("n")).join(files, "file")
    in_corpus = prefix_sums(sizes.withColumn("corpus", F.lit(0)), ["corpus"], "file_no", "n", width=32)
    starts = stage(in_file.join(in_corpus.select("file", F.col("before").alias("in_corpus")), "file"), "line-starts")
    n = starts.count()
    if n != splits.count():
        raise RuntimeError("the files changed while their lines were numbered")
    # one row per split of perhaps 128 MB: few enough to go to every task, or else lines and splits are shuffled
    return F.broadcast(starts) if n <= MAX_SPLITS_BROADCAST else starts


def _numbered(rows: DataFrame, starts: DataFrame) -> DataFrame:
    joined = rows.join(starts, ["file", "split_start"], "left")
    at = F.col("row_id") - F.col("first_id")
    known, moved = (at >= 0) & (at < F.col("n")), F.raise_error(F.lit(MOVED)).cast("long")
    in_file = F.col("in_file") + at + 1
    return joined.select("file", F.when(known, in_file).otherwise(moved).alias("line_no"),
                         F.when(known, F.col("in_corpus") + in_file).otherwise(moved).alias("position"), "text")


def lines_of(texts: DataFrame, text: str, *keys: str) -> DataFrame:
    """Stripped lines of a text column as ``(*keys, line_no, text)``; no shuffle."""
    pieces = texts.select(*keys, F.posexplode(split_lines(F.col(text))).alias("at", "line"))
    return pieces.select(*keys, (F.col("at") + 1).cast("bigint").alias("line_no"),
                         strip(F.col("line")).alias("text"))
