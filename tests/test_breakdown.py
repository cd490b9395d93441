import pytest

from verbamark.operators import breakdown as bd
from verbamark.schemas import TYPOLOGY, typology_table


def names(spark, rows):
    return spark.createDataFrame(rows, "system string, error_type string")


ROWS = ([("A", "Grammar")] * 3 + [("A", "Mistranslation"), ("A", "Unintelligible"), ("A", "Unintelligible "),
        ("B", "Register"), ("B", "grammar"), ("B", "Wrong Term")])


def judgements(spark):
    return spark.createDataFrame(
        [(1, "A", [("Grammar",), ("Omission",)]), (2, "A", []), (3, "A", None), (4, "B", [("Grammar",)])],
        "seg_id bigint, system string, errors array<struct<error_type: string>>")


def test_typology_has_28_types_in_7_categories(spark):
    rows = typology_table(spark).collect()
    assert len(rows) == 28 and len({r.category for r in rows}) == 7
    assert [r.error_type for r in rows if r.error_type.endswith(" ")] == ["Unintelligible ", "Character Encoding "]


def test_empty_and_null_lists_add_nothing(spark, sorted_rows):
    assert sorted_rows(bd.error_names(judgements(spark))) == [("A", "Grammar"), ("A", "Omission"), ("B", "Grammar")]


def test_only_exact_names_count(spark):
    found = [tuple(r) for r in bd.error_breakdown(names(spark, ROWS)).collect()]
    assert found == [
        ("A", "Accuracy", 1, "Mistranslation", 1, 1), ("A", "Fluency", 4, "Grammar", 1, 3),
        ("A", "Fluency", 4, "Unintelligible ", 4, 1), ("B", "Style", 6, "Register", 5, 1),
        ("B", "Terminology", 7, "Wrong Term", 3, 1)]


def test_trimmed_match_takes_names_without_their_space(spark):
    rows = bd.error_breakdown(names(spark, ROWS), match="trimmed").collect()
    assert [(r.error_type, r.n_errors) for r in rows if r.error_type.startswith("Unint")] == [("Unintelligible ", 2)]
    with pytest.raises(ValueError):
        bd.error_breakdown(names(spark, ROWS), match="loose")


def test_left_out_names_are_reported(spark, sorted_rows):
    assert sorted_rows(bd.unknown_error_types(names(spark, ROWS))) == [("A", "Unintelligible", 1), ("B", "grammar", 1)]
    assert sorted_rows(bd.unknown_error_types(names(spark, ROWS), match="trimmed")) == [("B", "grammar", 1)]


def test_dense_has_every_type_of_every_system(spark):
    rows = bd.error_breakdown_dense(names(spark, ROWS), ["A", "B", "C"]).collect()
    assert len(rows) == 84 and sum(r.n_errors for r in rows) == 7
    assert [r.error_type for r in rows[:28]] == [n for _, types in TYPOLOGY for n in types]
    assert all(r.n_errors == 0 for r in rows if r.system == "C")


def test_text_form_splits_names_at_commas(spark, sorted_rows):
    flat = spark.createDataFrame([("A", "Grammar, Register"), ("A", ""), ("A", None), ("B", "Date, Format")],
                                 "system string, error_type string")
    assert sorted_rows(bd.error_names_from_text(flat)) == [
        ("A", ""), ("A", "Grammar"), ("A", "Register"), ("B", "Date"), ("B", "Format")]
    assert bd.count_errors(bd.error_names_from_text(flat)).count() == 2


def test_category_totals_are_sums_of_types(spark, sorted_rows):
    counts = bd.count_errors(names(spark, ROWS))
    assert sorted_rows(bd.category_totals(counts)) == [
        ("A", "Accuracy", 1, 1), ("A", "Fluency", 4, 4), ("B", "Style", 6, 1), ("B", "Terminology", 7, 1)]
    assert [r.error_type for r in bd.category_members(counts, "Fluency").collect()] == ["Grammar", "Unintelligible "]
    assert [r.category_ord for r in bd.category_members(counts).collect()] == [1, 4, 4, 6, 7]


def test_shares_add_up_to_one(spark):
    rows = bd.error_shares(bd.count_errors(names(spark, ROWS))).collect()
    for system in "AB":
        mine = [r for r in rows if r.system == system]
        assert sum(r.error_share for r in mine) == pytest.approx(1)
        assert sum({r.category: r.category_share for r in mine}.values()) == pytest.approx(1)
    grammar, = [r for r in rows if r.error_type == "Grammar"]
    assert (grammar.n_errors, grammar.n_category, grammar.error_share, grammar.category_share) == (3, 4, 0.6, 0.8)


def test_another_typology(spark, sorted_rows):
    mine = (("Mine", ("grammar", "Register")),)
    assert sorted_rows(bd.count_errors(names(spark, ROWS), mine)) == [
        ("B", "Mine", 1, "Register", 2, 1), ("B", "Mine", 1, "grammar", 1, 1)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_counts_do_not_depend_on_partitions(spark, sorted_rows, partitions):
    hot = names(spark, ROWS * 50).repartition(partitions)
    assert sorted_rows(bd.count_errors(hot), "system", "error_type", "n_errors") == [
        ("A", "Grammar", 150), ("A", "Mistranslation", 50), ("A", "Unintelligible ", 50), ("B", "Register", 50),
        ("B", "Wrong Term", 50)]
