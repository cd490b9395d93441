import os

import pytest
from pyspark.sql import functions as F

from verbamark.session import discard, shared_folder, spread, stage
from verbamark.sources import tables
from verbamark.sources.lines import read_lines

WIDE = "seg_id bigint, source string, reference string, A string, B string"


def test_csv_keeps_empty_texts_apart_from_nulls(spark, tmp_path, sorted_rows):
    path = tmp_path / "c.csv"
    path.write_text('seg_id,source,reference,A,B\n1,"a, ""b""","two\nlines",NA,\n2,"",nan,null,"x"\n')
    df = tables.read_candidates(spark, str(path), ["A", "B"], "csv")
    assert sorted_rows(df) == [(1, 'a, "b"', "two\nlines", "NA", None), (2, "", "nan", "null", "x")]


def test_named_tables_replace_and_append(spark, tmp_path):
    store, one, two = str(tmp_path / "store"), spark.range(1), spark.range(2)
    with pytest.raises(FileNotFoundError):
        tables.append_tables({"x": one}, store)
    tables.write_tables({"x": one, "a/b c": two}, store)
    tables.write_tables({"x": two}, store)
    assert tables.read_table(spark, store, "x").count() == 2
    assert tables.read_table(spark, store, "a/b c").count() == 2
    tables.append_tables({"y": one}, store)
    with pytest.raises(tables.TableExists):
        tables.append_tables({"x": one}, store)
    assert tables.read_table(spark, store, "x").count() == 2


def test_staged_tables_lie_in_the_shared_folder(spark):
    staged = stage(spark.range(5), "five")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert staged.inputFiles()[0].removeprefix("file://").startswith(
        f"{shared_folder(spark).removeprefix('file://')}/staged/five-")
    assert staged.count() == 5


def test_spread_leaves_wide_scans_alone(spark):
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 9)
    assert spread(many) is many


def test_system_names_come_back_as_they_were(spark, tmp_path):
    names = ["01", "1", "2020-01-01", "a/b", "c"]
    long = spark.createDataFrame([(k, n, f"text {n}") for k, n in enumerate(names)], "seg_id long, system string, text string")
    tables.write_candidates(long, long, str(tmp_path / "store"))
    back = tables.read_by_system(spark, str(tmp_path / "store"))
    assert sorted((r.system, r.text) for r in back.collect()) == sorted((n, f"text {n}") for n in names)
    for n in names:
        assert [r.text for r in tables.read_system(spark, str(tmp_path / "store"), n).collect()] == [f"text {n}"]


def test_a_path_named_twice_is_refused(spark):
    with pytest.raises(ValueError):
        read_lines(spark, {"source": ["a.txt", "a.txt"]})


def test_discarded_tables_are_gone(spark, tmp_path):
    staged = stage(spark.range(3), "three")
    discard(staged, spark.range(1))
    assert not os.path.exists(staged.staged_path.removeprefix("file:"))


def broken(spark):
    return spark.range(3).select(F.raise_error(F.lit("lost half way")).cast("long").alias("id"))


def test_a_failed_write_leaves_the_old_set(spark, tmp_path):
    directory = str(tmp_path / "store")
    store = tables.TableStore(spark, directory)
    assert store.names() == [] and store.version() == 0
    tables.write_tables({"x": spark.range(1), "y": spark.range(1)}, directory)
    for append, names in ((False, ("x", "y")), (True, ("u", "v"))):
        with pytest.raises(Exception, match="lost half way"):
            store.write({names[0]: spark.range(9), names[1]: broken(spark)}, append=append)
        assert store.names() == ["x", "y"] and [store.read(n).count() for n in ("x", "y")] == [1, 1]
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, directory, "u")
    held = store.read("x")
    tables.write_tables({"x": spark.range(5)}, directory)
    assert store.read("x").count() == 5 and store.read("y").count() == 1
    assert held.count() == 1  # what a reader holds stays as it was
    store.vacuum(older_than=3600)
    assert held.count() == 1
    store.vacuum(older_than=-60)
    assert store.read("x").count() == 5 and store.read("y").count() == 1 and store.version() == 2
    # the version of x and y, and that of the new x; what failed writes left is gone
    assert len([f for f in os.listdir(directory) if f.startswith("version-")]) == 2
    assert len([f for f in os.listdir(directory) if f.startswith("manifest-")]) == 1


def test_two_writers_cannot_publish_one_version(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "store"))
    store.write({"x": spark.range(1)})
    with pytest.raises(tables.WriteConflict):
        store._publish(1, {"x": "elsewhere"})
    assert store.read("x").count() == 1 and store.version() == 1
    assert not [f for f in os.listdir(tmp_path / "store") if f.startswith(".") and not f.endswith(".crc")]


def test_judgements_of_all_systems_are_one_write(spark, tmp_path, sorted_rows):
    wide = spark.createDataFrame([(1, "s", "r", "a1", None), (2, "t", "q", "a2", "b2")], WIDE)
    exported = spark.createDataFrame([(1, "A", "Grammar", "3", "e", 0.5), (2, "B", "", "", "", 1.0)],
                                     "seg_id long, system string, error_type string, severity string, explanation string, score double")
    tables.write_tables({tables.JUDGED: tables.judged_tables(wide, exported, ["A", "B"])}, str(tmp_path / "store"))
    flat = tables.read_judged(spark, str(tmp_path / "store"), "B")
    assert flat.columns == ["seg_id", "source", "reference", "B", "error_type", "severity", "explanation", "score"]
    assert sorted_rows(flat) == [(1, "s", "r", None, None, None, None, None), (2, "t", "q", "b2", "", "", "", 1.0)]
    assert "PartitionFilters: [isnotnull(system" in flat._jdf.queryExecution().toString()
