"""Errors counted over the typology, with shares at both levels.

Counts are built by partial aggregation, so a system or an error type that
holds most of the errors costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbamark.schemas import TYPOLOGY, typology_dimension, typology_table

LEVELS = ("system", "category", "category_ord", "error_type", "error_ord")


def error_names(judgements: DataFrame) -> DataFrame:
    """One row per error: ``(system, error_type)``; empty and null lists add nothing."""
    return _listed(judgements, F.col("errors.error_type"))


def _listed(df: DataFrame, names: Column) -> DataFrame:
    # the outer form, as Spark guards the plain one with a filter on the list,
    # which repeats below whatever made the list
    return (df.select("system", F.explode_outer(names).alias("error_type"))
            .where(F.col("error_type").isNotNull()))


def error_names_from_text(exported: DataFrame, column: str = "error_type") -> DataFrame:
    """The same from the joined text form, where a name holding ``', '`` falls apart."""
    return _listed(exported, F.split(F.col(column), ", "))


def _match(names: DataFrame, match: str) -> tuple[DataFrame, Column]:
    if match not in ("exact", "trimmed"):
        raise ValueError(f"match must be 'exact' or 'trimmed', not {match!r}")
    key = F.col("error_type") if match == "exact" else F.rtrim(F.col("error_type"))
    return names.withColumn("error_key", key), key


def _dimension(names: DataFrame, typology, match: str) -> DataFrame:
    _, key = _match(names, match)
    return typology_dimension(names.sparkSession, typology).withColumn("error_key", key)


def count_errors(names: DataFrame, typology=TYPOLOGY, match: str = "exact") -> DataFrame:
    """Errors per system and type; names outside the typology are left out.

    ``match='trimmed'`` ignores spaces at the end of a name.
    """
    keyed, _ = _match(names, match)
    known = keyed.drop("error_type").join(_dimension(names, typology, match), "error_key")
    return known.groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("n_errors"))


def error_breakdown(names: DataFrame, typology=TYPOLOGY, match: str = "exact") -> DataFrame:
    """``count_errors`` in typology order; only types that occur have a row."""
    return count_errors(names, typology, match).orderBy("system", "category_ord", "error_ord")


def error_breakdown_dense(names: DataFrame, systems: Sequence[str], typology=TYPOLOGY,
                          match: str = "exact") -> DataFrame:
    """The breakdown with a row for every type of every named system, zeros included."""
    grid = typology_table(names.sparkSession, typology).select(
        F.explode(F.array(*map(F.lit, systems))).alias("system"), "*")
    counted = count_errors(names, typology, match).select("system", "category", "error_type", "n_errors")
    return (grid.join(counted, ["system", "category", "error_type"], "left")
            .fillna(0, ["n_errors"]).select(*LEVELS, "n_errors")
            .orderBy("system", "category_ord", "error_ord"))


def unknown_error_types(names: DataFrame, typology=TYPOLOGY, match: str = "exact") -> DataFrame:
    """The names the breakdown leaves out, with their counts."""
    keyed, _ = _match(names, match)
    unknown = keyed.join(_dimension(names, typology, match), "error_key", "left_anti")
    return unknown.groupBy("system", "error_type").agg(F.count(F.lit(1)).alias("n_errors"))


def category_totals(counts: DataFrame) -> DataFrame:
    return (counts.groupBy("system", "category", "category_ord")
            .agg(F.sum("n_errors").alias("n_errors")).orderBy("system", "category_ord"))


def category_members(counts: DataFrame, category: str | None = None) -> DataFrame:
    """Error types that occur in a category (or in each), in typology order."""
    chosen = counts if category is None else counts.where(F.col("category") == category)
    return (chosen.select("category", "category_ord", "error_type", "error_ord").distinct()
            .orderBy("category_ord", "error_ord"))


def error_shares(counts: DataFrame) -> DataFrame:
    """Share of a system's errors by category and by type.

    The windows run over counts, at most one row per type and system.
    """
    of_system = Window.partitionBy("system")
    of_category = Window.partitionBy("system", "category")
    total = F.sum("n_errors").over(of_system)
    in_category = F.sum("n_errors").over(of_category)
    return counts.select(
        *LEVELS, "n_errors", in_category.alias("n_category"),
        (in_category / total).alias("category_share"),
        (F.col("n_errors") / total).alias("error_share"))
