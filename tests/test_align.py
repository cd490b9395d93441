import random

import pytest

from pyspark.sql import functions as F

from verbamark.operators.align import (AlignmentError, align, align_corpora, aligned_only, alignment_check,
                                       number_across, number_texts)
from verbamark.operators.positions import prefix_sums
from verbamark.sources.lines import MOVED, _numbered, _scan, _starts, read_lines


def side(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts, 1)], "line_no bigint, text string")


def test_pairs_by_position_and_keeps_the_rest(spark, sorted_rows):
    pairs = align(side(spark, ["a", "b", "c"]), side(spark, ["x", None]))
    assert sorted_rows(pairs) == [(1, "a", "x", "both"), (2, "b", None, "both"), (3, "c", None, "source_only")]
    assert sorted_rows(aligned_only(pairs)) == [(1, "a", "x"), (2, "b", None)]


def test_strict_raises_on_unequal_sides(spark):
    with pytest.raises(AlignmentError, match="3 lines.*2"):
        align(side(spark, "abc"), side(spark, "xy"), strict=True)
    assert align(side(spark, "ab"), side(spark, "xy"), strict=True).count() == 2


def test_check_counts_both_sides(spark):
    assert tuple(alignment_check(side(spark, "abc"), side(spark, "x")).first()) == (3, 1, 1, 2, 0, False)
    assert tuple(alignment_check(side(spark, ""), side(spark, "x")).first()) == (0, 1, 0, 0, 1, False)
    assert alignment_check(side(spark, "a"), side(spark, "x")).first().equal_length


@pytest.mark.parametrize("bits", [8, 21])
@pytest.mark.parametrize("partitions", [1, 5])
def test_positions_do_not_depend_on_ranges_or_partitions(spark, bits, partitions):
    rng = random.Random(7)
    units = {c: sorted(rng.sample(range(-600, 900), 40)) for c in ("s", "r")}
    rows, expected = [], {}
    for corpus, ids in units.items():
        at = 0
        for u in ids:
            for line in range(1, rng.randint(1, 5) + 1):
                at += 1
                rows.append((corpus, u, line))
                expected[corpus, u, line] = at
    rng.shuffle(rows)
    lines = spark.createDataFrame(rows, "corpus string, doc_id bigint, line_no bigint").repartition(partitions)
    found = {(r.corpus, r.doc_id, r.line_no): r.position for r in number_across(lines, bits=bits).collect()}
    assert found == expected


def test_prefix_sums_of_sparse_keys(spark):
    keys = [-(1 << 63), -(1 << 40), -5, -1, 0, 1, 7, 1 << 21, (1 << 21) + 1, 1 << 42, (1 << 63) - 1]
    rows = [(g, k, n + 1) for g in ("a", None) for n, k in enumerate(keys) if g or n % 2]
    found = prefix_sums(spark.createDataFrame(rows, "g string, k long, n long").where("g is not null"), ["g"], "k", "n")
    got = {r.k: r.before for r in found.collect()}
    assert got == {k: sum(range(1, n + 1)) for n, k in enumerate(keys)}
    # no window holds a whole group
    plan = found._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("_range" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows)


def test_texts_are_numbered_while_whole(spark, sorted_rows):
    texts = [("s", 5, "a\nb\n"), ("s", -3, "c"), ("s", 9, None), ("s", 10, ""), ("s", 11, "\n\nd"), ("r", 1, "x\r\ny")]
    df = spark.createDataFrame(texts, "corpus string, doc_id long, text string").repartition(3)
    lines = number_texts(df)
    assert sorted_rows(lines, "corpus", "position", "doc_id", "line_no", "text") == sorted_rows(spark.createDataFrame(
        [("s", 1, -3, 1, "c"), ("s", 2, 5, 1, "a"), ("s", 3, 5, 2, "b"), ("s", 4, 11, 1, ""), ("s", 5, 11, 2, ""),
         ("s", 6, 11, 3, "d"), ("r", 1, 1, 1, "x"), ("r", 2, 1, 2, "y")], "c string, p long, d long, l long, t string"))
    pairs = align_corpora(lines, "s", "r")
    assert sorted_rows(pairs)[:3] == [(1, "c", "x", "both"), (2, "a", "y", "both"), (3, "b", None, "source_only")]
    again = align(*[lines.where(F.col("corpus") == c) for c in ("s", "r")])
    assert sorted_rows(pairs) == sorted_rows(again) and pairs.count() == 6


def test_files_of_a_corpus_are_one_corpus(spark, tmp_path, sorted_rows):
    for name, text in (("b 1.txt", "s1\ns2\n"), ("a.txt", "s3\ns4"), ("r1.txt", "r1\nr2"), ("r2.txt", "r3\nr4"), ("empty.txt", "")):
        (tmp_path / name).write_text(text)
    at = lambda *names: [str(tmp_path / n) for n in names]
    both = read_lines(spark, {"source": at("b 1.txt", "empty.txt", "a.txt"), "reference": at("r1.txt", "r2.txt")})
    source, reference = (both.where(F.col("corpus") == c) for c in ("source", "reference"))
    assert sorted_rows(aligned_only(align(source, reference, strict=True))) == [(k, f"s{k}", f"r{k}") for k in (1, 2, 3, 4)]
    assert {(r.position, r.line_no) for r in source.collect()} == {(1, 1), (2, 2), (3, 1), (4, 2)}
    with pytest.raises(ValueError, match="more than one path"):
        read_lines(spark, {"x": at("a.txt") + [str(tmp_path)]})


def test_positions_in_many_splits_and_a_change_of_splits(spark, tmp_path):
    rng = random.Random(3)
    lines = []
    for k in range(7):
        own = [f"{k}:{j}" + "x" * rng.randrange(60) for j in range(rng.randrange(1, 200))]
        (tmp_path / f"f{k}.txt").write_text("\n".join(own) + "\n" * (k % 2))
        lines += own
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = read_lines(spark, {"x": str(tmp_path)}).collect()
        plan = read_lines(spark, {"x": str(tmp_path)})._jdf.queryExecution().executedPlan().toString()
        assert [r.text for r in sorted(found, key=lambda r: r.position)] == lines
        # lines are neither moved nor written
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        rows = _scan(spark, [str(tmp_path)])
        starts = _starts(rows, spark.createDataFrame([(f"file:{tmp_path}/f{k}.txt", k) for k in range(7)], "file string, file_no long"))
        shifted = _numbered(rows.withColumn("row_id", F.col("row_id") + 1), starts)
        with pytest.raises(Exception, match=MOVED):
            shifted.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
