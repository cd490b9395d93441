"""Table shapes and the error typology."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Category and error names are matched exactly, so they are
# stated as they occur (two names end with a space).
TYPOLOGY: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Accuracy", ("Mistranslation", "Omission", "Addition", "Untranslated", "Over-translation",
                  "Under-translation", "Do Not Translate")),
    ("Audience Appropriateness", ("Specific Culture Reference",)),
    ("Design and Markup", ("Missing Text", "Character Formatting")),
    ("Fluency", ("Grammar", "Spelling", "Punctuation", "Unintelligible ", "Character Encoding ")),
    ("Locale Convention", ("Date Format", "Currency Format", "Number Format", "Measurement Format")),
    ("Style", ("Inconsistent Style", "Inappropriate Style", "Awkward Style", "Organizational Style",
               "Register", "Unidiomatic Style")),
    ("Terminology", ("Inconsistent Terminology", "Incorrect Terminology", "Wrong Term")),
)

# Fixed value: the literal a translation service leaves behind when it failed.
FAILURE_TEXT = "Error"

# Bounds the report format declares.
SEVERITY_RANGE = (0, 10)
SCORE_RANGE = (0, 1)

# A dimension built from driver-side literals is broadcast up to this many
# rows; a larger one is joined without a hint.
MAX_BROADCAST_DIMENSION = 10_000

SEGMENTS = T.StructType([
    T.StructField("seg_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("reference", T.StringType()),
])

ERROR = T.StructType([
    T.StructField("source_chunk", T.StringType()),
    T.StructField("target_chunk", T.StringType()),
    T.StructField("reference_chunk", T.StringType()),
    T.StructField("error_type", T.StringType()),
    # the format asks for an integer, but 3.5 read as one would be lost
    T.StructField("severity", T.DoubleType()),
    T.StructField("explanation", T.StringType()),
])

REPORT = T.StructType([
    T.StructField("errors", T.ArrayType(ERROR)),
    T.StructField("scores", T.DoubleType()),
])

# an error as a report gives it: the severity also as it was sent, which may be no number
REPORTED_ERROR = T.StructType([*ERROR, T.StructField("severity_sent", T.StringType())])

# nothing is read as a text or a number before its kind is known
SENT_ERROR = T.StructType([T.StructField(f.name, T.VariantType()) for f in ERROR])
SENT_ARGS = T.StructType([T.StructField("errors", T.ArrayType(SENT_ERROR)), T.StructField("scores", T.VariantType())])


def read_args(texts: Collection[str]) -> T.StructType:
    """The same with the bytes of the named texts; of what JSON knows only a text can be read as bytes, anything else is null."""
    fields = [T.StructField(f.name, T.BinaryType() if f.name in texts else T.VariantType()) for f in ERROR]
    return T.StructType([T.StructField("errors", T.ArrayType(T.StructType(fields))), T.StructField("scores", T.VariantType())])


ATTEMPTS = T.StructType([
    T.StructField("seg_id", T.LongType()),
    T.StructField("system", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])

REPLIES = T.StructType([
    T.StructField("seg_id", T.LongType()),
    T.StructField("system", T.StringType()),
    T.StructField("tool_calls", T.StringType()),
    T.StructField("calls", T.IntegerType()),
    T.StructField("error", T.StringType()),
])

# what a log keeps of every attempt of either kind
CALLS = T.StructType([
    T.StructField("seg_id", T.LongType()),
    T.StructField("system", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("answer", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("settled", T.BooleanType()),
])


def wide_schema(systems: Sequence[str]) -> T.StructType:
    """Schema of a wide candidate table: one text column per system."""
    return T.StructType([*SEGMENTS, *(T.StructField(s, T.StringType()) for s in systems)])


def typology_table(spark: SparkSession, typology=TYPOLOGY) -> DataFrame:
    """``(category, category_ord, error_type, error_ord)``; orders count from 1."""
    rows = [
        F.struct(F.lit(category).alias("category"), F.lit(c).alias("category_ord"),
                 F.lit(name).alias("error_type"), F.lit(e).alias("error_ord"))
        for c, (category, names) in enumerate(typology, 1)
        for e, name in enumerate(names, 1)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def typology_dimension(spark: SparkSession, typology=TYPOLOGY) -> DataFrame:
    """The typology as a join side, broadcast as its row count is known here."""
    table = typology_table(spark, typology)
    small = sum(len(names) for _, names in typology) <= MAX_BROADCAST_DIMENSION
    return F.broadcast(table) if small else table
