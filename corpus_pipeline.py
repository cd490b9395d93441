"""A corpus made ready for training: five stages, each written as Parquet and reread by the next.

Every stage works on all rows that the one before it kept. The first four
return the columns of ``documents``; the last returns one row per piece of a
document with its place in a training sequence. The result can't be expressed
in SQL, as language models, fingerprints and keyed permutations have no
counterpart there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbamark.llm.language import folds, identify
from verbamark.llm.mixing import mix
from verbamark.llm.packing import pack
from verbamark.llm.pii import pseudonymise
from verbamark.llm.simhash import keep_first
from verbamark.session import stage

PII_KEY = "a key for the given tables, where nothing is secret"
TOKENIZER = "word_bpe_49k.json"
WINDOW = 2048

ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language the models accept; learned from the labelled rows, four folds of them of five."""
    fold = folds()
    found = identify(docs, docs.where(fold > 1), docs.where(fold == 1))
    return found.where(~F.col("rejected")).select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: fingerprints of four-word shingles that differ in at most four bits."""
    return keep_first(docs, width=4, threshold=4)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format, and the number of characters counted anew."""
    return pseudonymise(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of all words, drawn so that sources, languages and topics come nearer to each other in size."""
    return mix(docs, tolerance=1e-6).where("_selected").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path(TOKENIZER), WINDOW)


STAGES = [("language", known_language), ("near-copies", without_copies), ("personal data", without_personal_data),
          ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
