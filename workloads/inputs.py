"""Representative inputs derived from the whole given tables.

Every line of every document becomes a segment: the line is the source, the
document's next line (the first, after the last) stands for the reference.
Nothing is shuffled to build them, so a query's plan is its operator's plan.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbamark.functions.text import split_lines, strip
from verbamark.operators.candidates import to_long, with_status
from verbamark.plans.metrics import METRICS
from verbamark.session import spread
from verbamark.sources.lines import lines_of

SYSTEMS = [f"sys_{k}" for k in range(1, 7)]
LINES_PER_DOC = 1_000_000_000  # keeps (doc_id, line) in one integer

NAMES = ["Mistranslation", "Grammar", "Unintelligible ", "Unintelligible", "Wrong Term", "Register",
         "Date Format"]


SECOND_CALL = ',{"name":"ErrorReport","args":{"errors":[{"error_type":"Omission"}],"scores":0.9}}]'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English texts are the source corpus, all others the reference corpus."""
    corpus = F.when(F.col("lang") == "en", "source").otherwise("reference")
    return table(spark, sf_dir, "documents").select("doc_id", corpus.alias("corpus"), "text")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(corpora(spark, sf_dir), "text", "corpus", "doc_id")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", split_lines(F.col("text")).alias("l"))
    turned = F.concat(F.slice("l", 2, F.size("l")), F.slice("l", 1, 1))
    pairs = docs.select("doc_id", F.posexplode(F.arrays_zip(F.col("l").alias("s"), turned.alias("r")))
                        .alias("at", "pair"))
    return pairs.select(
        (F.col("doc_id") * LINES_PER_DOC + F.col("at") + 1).alias("seg_id"),
        strip(F.col("pair.s")).alias("source"), strip(F.col("pair.r")).alias("reference"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systems that are perfect, altered, short, long or missing, failing, untranslated."""
    r, s, k = F.col("reference"), F.col("source"), F.col("seg_id")
    texts = {
        "sys_1": r,
        "sys_2": F.translate(r, "aeiou.,", "AEIOU"),
        "sys_3": F.translate(r, "aeio0123", ""),
        "sys_4": F.when(k % 7 != 0, F.concat(r, F.lit(" "), s)),
        "sys_5": F.when(k % 5 == 0, "Error").otherwise(F.replace(r, F.lit(" "), F.lit("  "))),
        "sys_6": s,
    }
    return segments(spark, sf_dir).select("*", *[t.alias(n) for n, t in texts.items()])


def raw_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(wide(spark, sf_dir), SYSTEMS)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_status(raw_candidates(spark, sf_dir))


def _sysno() -> Column:
    return F.substring("system", 5, 1).cast("bigint")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three attempts per candidate, some failed, some without an answer."""
    k = F.col("seg_id") + _sysno() + F.col("attempt")
    text = (F.when(k % 3 == 0, "Error").when(k % 11 != 0, F.concat("text", F.lit(" #"), F.col("attempt").cast("string"))))
    tried = raw_candidates(spark, sf_dir).select(
        "seg_id", "system", "text", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("attempt"))
    return tried.select("seg_id", "system", "attempt", text.alias("text"))


def _with_json(df: DataFrame, **texts: Column) -> DataFrame:
    """Add what stands between the quotes where Spark writes each text as JSON."""
    written = df.withColumns({name: F.to_json(F.array(text)).cast("binary") for name, text in texts.items()})
    # by bytes, as a place in a text is found by counting from its start
    return written.withColumns({name: F.substring(F.col(name), 3, F.length(name) - 4).cast("string") for name in texts})


def _present(*parts: Column | str) -> Column:
    """The parts as one text, empty if one is null: a null field is left out of JSON."""
    return F.coalesce(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]), F.lit(""))


def _error(name_key: Column, severity: Column) -> Column:
    """One error as JSON, of the columns ``head``, ``level`` and ``tail``."""
    name = F.element_at(F.array(*[F.lit(json.dumps(n)) for n in NAMES]), (name_key % 7).cast("int") + 1)
    return F.concat("head", _present(',"error_type":', name), _present(F.col("level"), severity.cast("string")), "tail")


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies as JSON text: whole, incomplete, out of range, empty and garbage, and some as judges send them.

    Those have another value before the one that was there, whose name is
    changed, or text behind the list. The texts of a segment are written as
    JSON once, not for every error of every system.
    """
    texts = _with_json(wide(spark, sf_dir), source_json=F.col("source"), reference_json=F.col("reference"))
    long = _with_json(to_long(texts, SYSTEMS, ("seg_id", "source_json", "reference_json")).withColumn("n", _sysno()),
                      text_json=F.coalesce("text", F.lit("")))
    seg, n, a, odd = map(F.col, ("seg_id", "n", "a", "odd"))
    # what all errors of a reply share
    head = F.concat(F.lit("{"), _present('"source_chunk":"', F.col("source_json"), '",'), F.lit('"target_chunk":"'), "text_json",
                    F.lit('"'), _present(',"reference_chunk":"\\n ', F.col("reference_json"), '\\r\\n"'))
    level = (F.when(odd == 2, ',"severity":"high","was":').when(odd == 3, ',"severity":"7","was":')
             .when(odd == 4, ',"weight":').otherwise(',"severity":'))
    explained = F.when(odd == 1, ',"explanation":5,"said":').otherwise(',"explanation":')
    tail = F.concat(_present(explained, '"see\\n', F.col("source_json"), ' "'), F.lit("}"))
    shared = (long.select("*", (seg + n).alias("a"), ((seg * 5 + n) % 41).alias("odd"))
              .select("seg_id", "system", "n", "a", "odd", head.alias("head"), level.alias("level"), tail.alias("tail")))
    second = _error(a, seg % 11)
    errors = (F.when(a % 4 == 0, "").when(a % 4 == 1, _error(seg + n * 5, a % 13))
              .when(a % 19 == 2, F.concat(second, F.lit(',{"error_type":"Grammar"}')))
              .otherwise(F.concat(_error(seg * 3 + n, a % 11), F.lit(","), second)))
    score = F.when(seg % 17 == 0, F.lit(1.5)).otherwise((seg * 3 + n) % 10 / F.lit(10.0)).cast("string")
    scores = _present(F.when(odd == 5, ',"scores":null,"given":').otherwise(',"scores":'), score)
    sent = (F.when((seg * 7 + n) % 23 == 0, "garbage").when(a % 29 == 0, "[]")
            .otherwise(F.concat(F.lit('[{"name":"ErrorReport","args":{"errors":['), errors, F.lit("]"), scores, F.lit("}}"),
                                F.when(odd == 6, SECOND_CALL).otherwise("]"))))
    return shared.select("seg_id", "system", F.concat(sent, F.when(odd == 0, " done").otherwise("")).alias("tool_calls"))


def _closeness(a: Column, b: Column) -> Column:
    """Shorter length over longer, null where either is empty or missing."""
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return F.when(a.isNotNull() & b.isNotNull() & (shorter > 0), shorter.cast("double") / longer)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three metrics read off the texts, null where there is no text to score."""
    text = F.col("text")
    words = F.size(F.split(text, " ")).cast("double")
    values = (_closeness(text, F.col("reference")), F.when(text.isNotNull(), 1 / words),
              _closeness(text, F.col("source")))
    each = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("score")) for m, v in zip(METRICS, values)])
    return (candidates(spark, sf_dir).select("seg_id", "system", F.explode(each).alias("m"))
            .select("seg_id", "system", "m.metric", "m.score"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as a source, the one after it as the candidate; the last has none and keeps its row."""
    # read as it lies: the join deals the rows anyway
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    source = e.select("vec_id", F.col("embedding").alias("source_vector"))
    candidate = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("candidate_vector"))
    return source.join(candidate, "vec_id", "left")
