from pyspark.sql import functions as F

from verbamark.operators import candidates as ca

WIDE = "seg_id bigint, source string, reference string, A string, B string"


def wide(spark):
    return spark.createDataFrame([(1, "s1", "r1", "a1", None), (2, "s2", None, "Error", "b2"),
                                  (3, None, "r3", None, None)], WIDE)


def test_long_and_back_is_the_same_table(spark, sorted_rows):
    long = ca.to_long(wide(spark), ["A", "B"])
    assert long.count() == 6
    assert sorted_rows(ca.to_wide(long, ["A", "B"])) == sorted_rows(wide(spark))


def test_any_number_of_systems(spark):
    assert ca.fan_out(wide(spark), [f"m{k}" for k in range(40)]).count() == 120


def test_status_tells_missing_from_failed(spark, sorted_rows):
    found = sorted_rows(ca.with_status(ca.to_long(wide(spark), ["A"])), "seg_id", "text", "status")
    assert found == [(1, "a1", "ok"), (2, None, "error"), (3, None, "missing")]


def test_system_table(spark):
    assert ca.system_table(wide(spark), "B").columns == ["seg_id", "source", "reference", "B"]


def attempts(spark):
    return spark.createDataFrame([
        (1, "A", 1, "Error"), (1, "A", 2, "late"), (1, "A", 3, "later"),
        (2, "A", 1, None), (2, "A", 2, "too late"),  # null is an answer
        (3, "A", 1, "Error"), (3, "A", 2, "Error"), (3, "A", 3, "Error"),
        (1, "B", 2, "error"), (1, "B", 1, "first"),  # only the exact literal fails
    ], "seg_id bigint, system string, attempt int, text string")


def test_first_success_wins(spark, sorted_rows):
    found = sorted_rows(ca.resolve_attempts(attempts(spark)))
    assert found == [(1, "A", 2, "late", "ok"), (1, "B", 1, "first", "ok"),
                     (2, "A", 1, None, "missing"), (3, "A", 1, None, "error")]


def test_attempts_are_thinned_before_the_shuffle(spark):
    plan = ca.resolve_attempts(attempts(spark))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_failure_report(spark, sorted_rows):
    columns = ("system", "n_candidates", "n_ok", "n_missing", "n_error", "n_attempts", "n_failed_attempts")
    assert sorted_rows(ca.failure_report(attempts(spark)), *columns) == [
        ("A", 3, 1, 1, 1, 8, 4), ("B", 1, 1, 0, 0, 2, 0)]


def test_slots_go_round(spark):
    rows = ca.assign_slots(spark.range(-4, 8), F.col("id"), 4).groupBy("slot").count().collect()
    assert sorted(map(tuple, rows)) == [(0, 3), (1, 3), (2, 3), (3, 3)]
