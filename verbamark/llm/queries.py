"""The registered queries of this subpackage: each applies one operator to a whole given table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbamark.llm.language import folds, identify
from verbamark.llm.mixing import mix
from verbamark.llm.near_vectors import near_vectors
from verbamark.llm.nearest import nearest
from verbamark.llm.packing import pack
from verbamark.llm.page_text import main_text
from verbamark.llm.passages import near_passages
from verbamark.llm.pieces import encode
from verbamark.llm.pii import pseudonymise
from verbamark.llm.quality import classify
from verbamark.llm.repair import repair
from verbamark.llm.runs import periodic_runs
from verbamark.llm.simhash import simhash_components


DEMO_KEY = "a key for the given tables, where nothing is secret"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_pii(spark, d):
    return pseudonymise(_table(spark, d, "documents"), DEMO_KEY)


def op2_language(spark, d):
    documents = _table(spark, d, "documents").select("doc_id", "text", "lang")
    fold = folds()
    found = identify(documents.select("doc_id", "text"), documents.where(fold > 1), documents.where(fold == 1))
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score",
                        "rejected", "entropy")


def op3_nearest(spark, d):
    vectors = _table(spark, d, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op4_mixing(spark, d):
    mixed = mix(_table(spark, d, "documents").select("doc_id", "text", "source", "lang"))
    return mixed.select("doc_id", "source", "lang", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"),
                        F.round("_p", 4).alias("probability"), F.col("_selected").alias("selected"))


def op5_packing(spark, d):
    return pack(_table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_near_vectors(spark, d):
    return near_vectors(_table(spark, d, "embeddings"))


def op7_simhash(spark, d):
    found = simhash_components(_table(spark, d, "documents"), width=4, threshold=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_passages(spark, d):
    return near_passages(_table(spark, d, "documents")).withColumn("similarity", F.round("similarity", 6))


def op9_quality(spark, d):
    documents = _table(spark, d, "documents").select("doc_id", "text")
    fold = folds(n=4)
    labels = _table(spark, d, "labels").where(fold != 2).select("doc_id", "quality")
    # sorted and merged at every size, as neither side is known to be small
    found = classify(documents, documents.join(labels.hint("merge"), "doc_id"))
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_page_text(spark, d):
    return main_text(_table(spark, d, "pages"))


def looped(documents: DataFrame) -> DataFrame:
    """Documents, one in ten of them with a loop in place of the words from some place on."""
    words = r"transform(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)), w -> struct(w, size(w) as n))"
    at = f"transform({words}, s -> struct(s.w, s.n, (h div 10) % s.n as a))"
    loop = f"transform({at}, s -> struct(s.w, s.n, s.a, 1 + (s.n - s.a) div (3 + (h div 10) % 8) as p))[0]"
    turned = (f"array_join(flatten(transform(array({loop}), s -> transform(sequence(0L, s.n - 1L), "
              "i -> s.w[cast(if(i < s.a, i, s.a + (i - s.a) % s.p) as int)]))), ' ')")
    some = r"h % 10 = 0 and text rlike '[^\\x20\\x09-\\x0D]'"
    hashed = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    return hashed.select("doc_id", F.expr(f"case when {some} then {turned} else text end").alias("text"))


def op11_runs(spark, d):
    found = periodic_runs(looped(_table(spark, d, "documents")))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    # runs are ordered by start and period, so the first of the greatest stays
    best = F.expr(f"aggregate(runs, cast(null as {run}), (b, r) -> "
                  "if(b is null or r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op12_pieces(spark, d):
    found = encode(_table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with a fault in five of twenty: ``kept`` is false for a dropped one, a repeated one comes twice."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault != 0).alias("kept"), F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))


def op13_conversations(spark, d):
    return repair(damaged(_table(spark, d, "conversations")), F.col("kept"))


def mixing_sql(power: float = 0.5, budget: float = 0.5, seed: str = "mix", rounds: int = 20, steps: int = 12) -> str:
    """Raking and calibration unrolled, with more rounds than the given tables need."""
    key = "source, lang, topic"
    parts = [
        "words AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z]{5,}')) AS w FROM documents)",
        "ranked AS (SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, w) AS k "
        "FROM words GROUP BY doc_id, w)",
        "keyed AS (SELECT d.doc_id, d.source, d.lang, coalesce('topic' || ((16 * "
        "(strpos('0123456789abcdef', substr(md5(w), 1, 1)) - 1) + strpos('0123456789abcdef', substr(md5(w), 2, 1)) - 1) % 8), "
        "'none') AS topic, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens "
        "FROM documents d LEFT JOIN ranked r ON r.doc_id = d.doc_id AND k = 1)",
        f"cells AS (SELECT coalesce(source, '') AS source, coalesce(lang, '') AS lang, topic, sum(tokens) AS tokens "
        f"FROM keyed GROUP BY 1, 2, 3)",
        f"w0 AS MATERIALIZED (SELECT *, tokens / (SELECT sum(tokens) FROM cells)::DOUBLE AS w FROM cells)",
    ]
    for m in ("source", "lang", "topic"):
        parts.append(f"goal_{m} AS MATERIALIZED (SELECT {m}, s / sum(s) OVER () AS share FROM (SELECT {m}, "
                     f"pow(sum(tokens)::DOUBLE, {power}) AS s FROM cells GROUP BY {m}))")
    n = 0
    for _ in range(rounds):
        for m in ("source", "lang", "topic"):
            parts.append(f"w{n + 1} AS MATERIALIZED (SELECT {key}, tokens, CASE WHEN sum(w) OVER (PARTITION BY {m}) > 0 "
                         f"THEN w * share / sum(w) OVER (PARTITION BY {m}) ELSE 0 END AS w FROM w{n} JOIN goal_{m} USING ({m}))")
            n += 1
    parts.append(f"rated AS MATERIALIZED (SELECT {key}, tokens, w, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS rate FROM w{n})")
    parts.append(f"s0 AS (SELECT {budget} * sum(tokens) / sum(w) AS scale FROM rated)")
    for k in range(steps):
        parts.append(f"s{k + 1} AS MATERIALIZED (SELECT coalesce(({budget} * sum(tokens) - coalesce(sum(tokens) FILTER (rate * scale >= 1), 0)) "
                     f"/ sum(w) FILTER (rate * scale < 1), any_value(scale)) AS scale FROM rated, s{k})")
    parts.append(f"drawn AS (SELECT {key}, least(1, rate * scale) AS p FROM rated, s{steps})")
    unit = " + ".join(f"(strpos('0123456789abcdef', substr(md5('{seed}|' || doc_id), {k}, 1)) - 1) * {16 ** (13 - k)}::DOUBLE"
                      for k in range(1, 14))
    return (f"WITH {', '.join(parts)} SELECT doc_id, k.source, k.lang, k.topic, k.tokens, round(p, 4) AS probability, "
            f"({unit}) / {16 ** 13}::DOUBLE < p AS selected FROM keyed k JOIN drawn d ON coalesce(k.source, '') = d.source "
            "AND coalesce(k.lang, '') = d.lang AND k.topic = d.topic")


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_nearest": op3_nearest,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_near_vectors": op6_near_vectors,
    "op7_simhash": op7_simhash,
    "op8_passages": op8_passages,
    "op9_quality": op9_quality,
    "op10_page_text": op10_page_text,
    "op11_runs": op11_runs,
    "op12_pieces": op12_pieces,
    "op13_conversations": op13_conversations,
}

ORACLES: dict[str, str] = {
    "op4_mixing": mixing_sql(),
}
