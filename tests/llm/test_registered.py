"""The registered queries and the pipeline as they are called: columns, folds, SQL, odd tables."""

import os
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from verbamark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_pii": "doc_id text lang source n_chars",
    "op2_language": "doc_id held_out lang_pred score",
    "op3_nearest": "query_id rank vec_id score",
    "op5_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op6_near_vectors": "vec_id n_links component_id kept",
    "op7_simhash": "doc_id fingerprint component_id",
    "op9_quality": "doc_id held_out score predicted",
    "op10_page_text": "page_id url text n_chars",
    "op11_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_pieces": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_conversations": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are absent")


@pytest.fixture(scope="module")
def found(spark):
    held = {}

    def of(name):
        if name not in held:
            held[name] = QUERIES[name](spark, SF_DIR).collect()
        return held[name]
    return of


def ids(spark, table, column):
    return sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(column).collect())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, found, name):
    rows = found(name)
    assert rows and rows[0].__fields__[:len(COLUMNS[name].split())] == COLUMNS[name].split()
    key, table = next((k, t) for k, t in (("page_id", "pages"), ("conv_id", "conversations"), ("query_id", None), ("vec_id", "embeddings"),
                                          ("doc_id", "documents")) if k in COLUMNS[name].split())
    if name == "op13_conversations":
        assert sorted(r[key] for r in rows) == sorted(set(ids(spark, table, key)))
    elif name == "op5_packing":
        assert {r[key] for r in rows} == set(ids(spark, table, key))
    elif table:
        assert sorted(r[key] for r in rows) == ids(spark, table, key)


@pytest.mark.parametrize("name,n,out", [("op2_language", 5, 0), ("op9_quality", 4, 2)])
def test_held_out_rows_and_scores(found, name, n, out):
    for r in found(name):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == out) and 0 <= r.score <= 1
        assert name != "op9_quality" or r.predicted == int(r.score >= 0.7)


def test_packing_loses_nothing(found):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found("op5_packing"):
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_doc.values():
        at = 0
        for start, length, total in sorted(pieces):
            assert start == at
            at += length
        assert at == total
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_mixing_equals_its_sql(found):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    cursor = con.execute(ORACLES["op4_mixing"])
    names = [c[0] for c in cursor.description]
    expected = Counter(tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall())
    assert Counter(tuple(r[c] for c in sorted(names)) for r in found("op4_mixing")) == expected


def test_pipeline_over_odd_rows_and_an_empty_table(spark, tmp_path):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "web", 0), (10**6 + 1, "", None, None, 0), (None, "No id at all.", "en", "web", None),
                                 (10**6 + 2, "1234 5678", "en", "web", 9), (10**6 + 3, None, None, None, None)], documents.schema)
    some = documents.where("doc_id % 2 = 0")
    table = documents.unionAll(odd).unionAll(some)  # half of the rows stand twice
    table.coalesce(3).write.parquet(str(tmp_path / "all" / "documents.parquet"))
    table.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "all" / "documents.parquet"))
    kept = {}
    for name, function in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stage(function(spark, docs, str(tmp_path / "all")), name.replace(" ", "-"))
        assert docs.columns == documents.columns
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    # texts without a letter go, then copies; a repeated row is a copy
    assert not set(kept["language"]) & {10**6, 10**6 + 1, 10**6 + 2, 10**6 + 3}
    assert len(kept["near-copies"]) == len(set(kept["near-copies"])) < len(kept["language"])
    assert sorted(kept["personal data"]) == sorted(kept["near-copies"]) and set(kept["mixing"]) < set(kept["personal data"])
    packed = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path / "all"))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(kept["mixing"])
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_near_copies_are_linked_by_the_stage(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = documents.where("length(text) > 600").first().text
    rows = [(1, text), (2, text), (3, text + " one"), (4, "Something else entirely stands here, of another kind.")]
    df = spark.createDataFrame([(k, t, "en", "web", len(t)) for k, t in rows], documents.schema)
    kept = {r.doc_id for r in corpus_pipeline.without_copies(spark, df, SF_DIR).select("doc_id").collect()}
    assert {1, 4} <= kept and 2 not in kept
