"""Every registered query against its SQL on the smallest given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from workloads.oracle import ORACLES
from workloads.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def in_order(rows):
    plain = [tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = in_order(tuple(r[c] for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = in_order(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert found == expected
    assert found


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_in_the_jvm_and_free_of_products(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Python runs where a caller's hook does, and nowhere else
    assert ("ArrowEvalPython" in plan) == (name == "score_with_reference")
    assert "BatchEvalPython" not in plan and ("MapInPandas" in plan) == (name == "hooked_attempts")


def test_scans_read_only_what_is_used(spark):
    for name in ("clean_text", "parse_reports", "scoring_input_ref"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"system", "category", "category_ord", "error_type", "error_ord", "n_errors"}
