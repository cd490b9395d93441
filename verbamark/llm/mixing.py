"""Mixing sources to target weights: raking of token weights, then sampling by calibrated probabilities."""

from __future__ import annotations

import re
import warnings
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbamark.session import discard, stage

TOLERANCE = 1e-10
MAX_ROUNDS = 1000
# weights this far from their targets, as a share, are no rounding any more
UNMET = 1e-4
MAX_CELLS = 200_000
TOPICS = 8
HEX_DIGITS = 13
LONG_WORD = re.compile(rb"[a-z]{5,}")
MEASURES = ["_tokens", "_keyword"]


class UnmetMargins(UserWarning, ValueError):
    """The targets contradict each other: no weights have all these sums."""


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``_tokens``, its number of words, and ``_keyword``.

    The keyword is the most frequent run of five or more letters a to z, the
    first in the alphabet among equals, and null if there is none.
    """
    schema = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, keywords = [], []
            for value in batch.column(schema.names.index(text)).cast(pa.binary()):
                low = value.as_buffer().to_pybytes().lower() if value.is_valid else b""
                tokens.append(len(low.split()))
                counts = Counter(LONG_WORD.findall(low))
                most = max(counts.values(), default=0)
                keywords.append(min((w for w, n in counts.items() if n == most), default=None))
            columns = [pa.array(tokens, pa.int64()), pa.array(keywords, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(batch.columns + columns, names=schema.names + MEASURES)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return documents.mapInArrow(run, f"{fields}, _tokens long, _keyword string")


def keyword_topic(keyword: Column, n: int = TOPICS) -> Column:
    """A stand-in for a topic label: one of ``n`` classes of keywords."""
    digit = F.conv(F.substr(F.md5(keyword), F.lit(1), F.lit(2)), 16, 10).cast("int") % n
    return F.coalesce(F.concat(F.lit("topic"), digit.cast("string")), F.lit("none"))


def tempered(cells: DataFrame, column: str, power: float, tokens: str = "tokens") -> DataFrame:
    """Target shares of a column's values, as its shares of tokens raised to ``power``."""
    sums = cells.groupBy(column).agg(F.pow(F.sum(tokens).cast("double"), F.lit(power)).alias("share"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("share").alias("total")))).select(  # one row
        column, (F.col("share") / F.col("total")).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE, strict: bool = False) -> DataFrame:
    """``cells`` with ``w``, weights that add up to each target's shares.

    ``cells`` has one row per combination of the target columns with its
    ``tokens``; a target has a column of that name and ``share``. Each round
    scales the weights to one margin after the other, until none had to be
    scaled by more than ``tolerance``. Values without a target get no weight,
    targets without tokens are left out and the other shares of that column
    scaled up. Only the largest deviation of a round reaches the driver.
    Targets that contradict each other are met for the last margin only; that
    raises ``UnmetMargins`` if ``strict``, and warns of it otherwise.
    """
    now, goals = cells.where("tokens > 0"), {}
    for k, (column, target) in enumerate(targets.items()):
        goals[column] = f"_goal{k}"
        now = now.join(target.where("share > 0").select(column, F.col("share").alias(goals[column])), column)
    sums = []
    for column, goal in goals.items():
        one = now.groupBy(column).agg(F.max(goal).alias(goal)).agg(F.sum(goal)).first()[0]
        sums.append(one or 1.0)
    now = stage(now.select(*cells.columns, F.col("tokens").cast("double").alias("w"), F.lit(1.0).alias("off"),
                           *((F.col(goal) / one).alias(goal) for goal, one in zip(goals.values(), sums))), "cells")
    # sums by cell, not documents: few enough are scaled in memory, any number by Spark
    scaled = _scaled_here if now.count() <= MAX_CELLS else _scaled_by_spark
    now, off = scaled(now, goals, tolerance)
    if off > UNMET:
        unmet = UnmetMargins(f"a margin is off its target by {off:.2g} of it, and no more rounds bring it nearer")
        if strict:
            raise unmet
        warnings.warn(unmet, stacklevel=2)
    rest = cells.join(now, [c for c in cells.columns if c != "tokens"], "left_anti")
    return now.select(*cells.columns, "w").union(rest.select(*cells.columns, F.lit(0.0)))


def _scaled_here(now: DataFrame, goals: Mapping[str, str], tolerance: float) -> tuple[DataFrame, float]:
    table = now.toArrow()
    w, off = np.asarray(table["w"]).copy(), np.inf if len(table) else 0.0
    margins = [(np.asarray(table[column].combine_chunks().dictionary_encode().indices), np.asarray(table[goal]))
               for column, goal in goals.items()] if len(table) else []
    for _ in range(MAX_ROUNDS):
        if off <= tolerance:
            break
        before, off = off, 0.0
        for at, goal in margins:
            factor = goal / np.bincount(at, w)[at]
            w, off = w * factor, max(off, np.abs(1 - factor).max())
        if off > UNMET and abs(before - off) <= tolerance * off:
            break  # the same again each round
    return now.sparkSession.createDataFrame(table.set_column(table.schema.get_field_index("w"), "w", pa.array(w)),
                                            now.schema), off


def _scaled_by_spark(now: DataFrame, goals: Mapping[str, str], tolerance: float) -> tuple[DataFrame, float]:
    off = 0.0
    for _ in range(MAX_ROUNDS):
        after = now.withColumn("off", F.lit(0.0))
        for column, goal in goals.items():
            margin = after.groupBy(column).agg(F.sum("w").alias("m"))
            factor = F.col(goal) / F.col("m")
            after = after.join(margin, column).withColumns(
                {"w": F.col("w") * factor, "off": F.greatest("off", F.abs(1 - factor))}).drop("m")
        after = stage(after.select(now.columns), "cells")
        discard(now)
        now = after
        before, off = off, now.agg(F.max("off")).first()[0] or 0.0
        if off <= tolerance or off > UNMET and abs(before - off) <= tolerance * off:
            break
    return now, off


def calibrated(cells: DataFrame, budget: float) -> DataFrame:
    """Raked ``cells`` with ``p``, the share of each cell to draw so that ``budget`` of all tokens are drawn.

    ``p`` is in proportion to weight over tokens; where that would exceed 1
    the cell is taken whole and the others are scaled up.
    """
    rate = F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0)
    rated = cells.withColumn("rate", rate)
    wanted = budget * (cells.agg(F.sum("tokens")).first()[0] or 0)
    scale = whole = None
    while True:
        over = F.lit(False) if scale is None else F.col("rate") * scale >= 1
        row = rated.agg(F.sum(F.when(over, F.col("tokens"))), F.sum(F.when(~over, F.col("w"))),
                        F.count(F.when(over, 1))).first()
        if row[2] == whole or not row[1]:
            break
        whole, scale = row[2], max(wanted - (row[0] or 0), 0.0) / row[1]
    p = F.lit(0.0) if scale is None else F.least(F.lit(1.0), F.col("rate") * scale)
    return rated.select(*cells.columns, p.alias("p"))


def mix(documents: DataFrame, margins: Sequence[str] = ("source", "lang"), *, text: str = "text",
        doc_id: str = "doc_id", shares: Mapping[str, DataFrame] | None = None, power: float = 0.5,
        budget: float = 0.5, seed: str = "mix", tolerance: float = TOLERANCE, strict: bool = False) -> DataFrame:
    """``documents`` with ``_tokens``, ``_topic``, ``_p`` and ``_selected``.

    The margins are the named columns and ``topic``, a class of keywords; a
    null value is a value of its own, the empty text. ``shares`` gives target
    shares per margin, else these are the corpus's own raised to ``power``. A
    document is drawn if a hash of the seed and its id falls below its cell's
    probability, so the same id is always drawn alike and repeated rows go or
    stay together. Texts without words weigh nothing and are drawn with their
    cell; documents of a cell without any words are not drawn, nor is anything
    of an empty table. Only sums by cell are shuffled. Columns of
    ``documents`` with the name of one of the four are replaced. Targets that
    contradict each other warn, or raise ``UnmetMargins`` if ``strict``.
    """
    documents = documents.drop("_tokens", "_keyword", "_topic", "_p", "_selected")
    lead = "_"
    while {f"{lead}{m}" for m in margins} & set(documents.columns):
        lead += "_"  # a name of the caller's own
    values = {f"{lead}{m}": F.coalesce(F.col(m).cast("string"), F.lit("")) for m in margins}
    values["_topic"] = keyword_topic(F.col("_keyword"))

    def keyed(rows: DataFrame) -> DataFrame:
        return measured(rows, text).withColumns(values).drop("_keyword")

    cells = stage(keyed(documents.select(text, *margins)).groupBy(*values).agg(F.sum("_tokens").alias("tokens")), "cells")
    names = {m: f"{lead}{m}" for m in margins} | {"topic": "_topic"}
    targets = {names[m]: target.withColumnRenamed(m, names[m]) for m, target in (shares or {}).items()}
    raked = rake(cells, {v: targets[v] if v in targets else tempered(cells, v, power) for v in values},
                 tolerance, strict)
    drawn = stage(calibrated(stage(raked, "raked"), budget).select(*values, F.col("p").alias("_p")), "drawn")
    discard(cells)
    selected = _unit(doc_id, seed) < F.coalesce("_p", F.lit(0.0))
    return keyed(documents).join(drawn, list(values), "left").select(
        *documents.columns, "_tokens", "_topic", "_p", selected.alias("_selected"))


def _unit(doc_id: str, seed: str) -> Column:
    """A number from 0 up to 1 that follows from the seed and the id."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(doc_id).cast("string")))
    return F.conv(F.substr(digest, F.lit(1), F.lit(HEX_DIGITS)), 16, 10).cast("double") / F.lit(float(16 ** HEX_DIGITS))
