import json

import pytest
from pyspark.sql import functions as F

from verbamark.operators import judge as ju
from verbamark.operators.annotate import annotate


def error(**changes):
    whole = {"source_chunk": "s", "target_chunk": "t", "reference_chunk": "r", "error_type": "Grammar",
             "severity": 3, "explanation": "e"}
    whole.update(changes)
    return {k: v for k, v in whole.items() if v != "absent"}


def call(errors, scores=0.5):
    args = {"errors": errors, "scores": scores}
    return {"name": "Report", "args": {k: v for k, v in args.items() if v != "absent"}}


def replies(spark, *values):
    rows = [(k, "A", v if v is None or isinstance(v, str) else json.dumps(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "seg_id bigint, system string, tool_calls string")


def parsed(spark, *values, strict=True):
    return [r for r in ju.parse_reports(replies(spark, *values), strict).orderBy("seg_id").collect()]


def test_whole_report(spark):
    r, = parsed(spark, [call([error(), error(severity=7)], 1)])
    assert (r.status, r.score, [e.severity for e in r.errors]) == ("ok", 1.0, [3.0, 7.0])


def test_no_errors_is_a_report(spark):
    r, = parsed(spark, [call([], 0.9)])
    assert (r.status, r.errors, r.score) == ("ok", [], 0.9)


def test_first_call_wins(spark):
    r, = parsed(spark, [call([], 0.1), call([error()], 0.9)])
    assert (r.errors, r.score) == ([], 0.1)


def test_unusable_replies(spark):
    found = parsed(spark, "garbage", [], None, call([]), "  []", '[{"args": null}]', "[1, 2")
    assert [r.status for r in found] == ["garbage", "empty", "missing", "garbage", "empty", "void", "garbage"]
    assert all(r.errors is None and r.score is None for r in found)


@pytest.mark.parametrize("field", ["source_chunk", "target_chunk", "reference_chunk", "error_type", "explanation"])
def test_one_incomplete_error_voids_the_report(spark, field):
    value = [call([error(), error(**{field: "absent"})])]
    r, = parsed(spark, value)
    assert (r.status, r.errors, r.score) == ("void", None, None)
    r, = parsed(spark, value, strict=False)
    assert (r.status, len(r.errors), r.score) == ("ok", 1, 0.5)


def test_null_chunk_and_absent_score_void_the_report(spark):
    found = parsed(spark, [call([error(source_chunk=None)])], [call([error()], "absent")], [call("absent")])
    assert [r.status for r in found] == ["void"] * 3


def test_a_score_given_as_null_is_zero(spark):
    found = parsed(spark, [call([error()], None)], [call([error()], "high")], [call([error()], 0)])
    assert [(r.status, r.score, r.errors and len(r.errors)) for r in found] == [
        ("ok", 0.0, 1), ("void", None, None), ("ok", 0.0, 1)]


def test_severity_alone_is_optional_and_may_be_a_fraction(spark):
    r, = parsed(spark, [call([error(severity="absent"), error(severity=3.5)])])
    assert (r.status, [e.severity for e in r.errors]) == ("ok", [None, 3.5])


def test_texts_are_cleaned_but_names_are_not(spark):
    r, = parsed(spark, [call([error(source_chunk=" a\nb\r ", explanation="　x", error_type="Unintelligible ")])])
    assert (r.errors[0].source_chunk, r.errors[0].explanation) == ("a b", "x")
    assert r.errors[0].error_type == "Unintelligible "


def test_ranges_are_flagged_not_clamped(spark):
    judged = ju.parse_reports(replies(
        spark, [call([error(severity=12), error(severity=-1), error(severity=10)], 1.5)], [call([error()], 1)], "x",
        [call([error(severity="absent")], 0)]))
    found = [tuple(r)[2:] for r in ju.report_validity(judged).orderBy("seg_id").collect()]
    assert found == [("ok", 3, 2, False, False), ("ok", 1, 0, True, True), ("garbage", None, None, None, False),
                     ("ok", 1, 0, True, True)]
    assert judged.orderBy("seg_id").first().score == 1.5


def test_failure_counts_as_zero_unless_told_otherwise(spark):
    judged = ju.parse_reports(replies(spark, "x", [call([error()], 1)]))
    assert [r.score for r in ju.with_defaults(judged).orderBy("seg_id").collect()] == [0.0, 1.0]
    assert [r.score for r in ju.with_defaults(judged, "null").orderBy("seg_id").collect()] == [None, 1.0]
    with pytest.raises(ValueError):
        ju.with_defaults(judged, "drop")


def test_one_failure_touches_no_other_row(spark):
    candidates = spark.createDataFrame(
        [(k, s, "ok") for k in (0, 1, 2) for s in "AB"], "seg_id bigint, system string, status string")
    judged = ju.parse_reports(replies(spark, [call([error()], 0.7)], "x"))
    joined = ju.attach_judgements(candidates, judged).orderBy("seg_id", "system").collect()
    assert [(r.seg_id, r.system, r.status, len(r.errors), r.score) for r in joined] == [
        (0, "A", "ok", 1, 0.7), (0, "B", "missing", 0, 0.0), (1, "A", "garbage", 0, 0.0),
        (1, "B", "missing", 0, 0.0), (2, "A", "missing", 0, 0.0), (2, "B", "missing", 0, 0.0)]


def test_export(spark):
    judged = ju.parse_reports(replies(
        spark, [call([error(), error(severity=3.5, error_type="Register"), error(severity="absent")], 0.5)], "x"))
    first, second = ju.export_judgements(judged).orderBy("seg_id").collect()
    assert tuple(first)[2:] == ("Grammar, Register, Grammar", "3, 3.5, None", "e\ne\ne", 0.5)
    assert tuple(second)[2:] == ("", "", "", 0.0)


def test_severity_score(spark):
    judged = ju.parse_reports(replies(
        spark, [call([error(severity=10), error(severity="absent")])], [call([])], "x",
        [call([error(severity=10)] * 6)]))
    scored = judged.select("seg_id", ju.severity_score(F.col("errors")).alias("v")).orderBy("seg_id")
    assert [r.v for r in scored.collect()] == [0.8, 1.0, None, 0.0]


def test_replies_are_parsed_once(spark):
    from verbamark.operators.breakdown import count_errors, error_names
    counted = count_errors(error_names(ju.parse_reports(replies(spark, "x"))))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils.parseJson") == 1


def test_rules(spark):
    rows = [("s 1.", "s 1.", "r 12."), ("source", None, "ref"), ("source", " ", "ref"), ("a", "abcdefghij" * 2, "abcdefghij"),
            ("a", "abc", "abcdefghij"), ("a", "bad �", "bad x"), ("a", "fine", "fine"), ("a", "a, b", "a b,.")]
    df = spark.createDataFrame([(k, "A", *r) for k, r in enumerate(rows)],
                               "seg_id bigint, system string, source string, text string, reference string")
    found = [[e.error_type for e in r.errors] for r in annotate(df).orderBy("seg_id").collect()]
    assert found == [["Untranslated", "Number Format"], ["Missing Text"], ["Missing Text"], ["Addition"],
                     ["Omission"], ["Character Encoding "], [], ["Punctuation"]]


def test_a_severity_sent_as_text_is_read_and_an_unreadable_one_is_flagged(spark):
    sent = [call([error(severity="7"), error(severity="high"), error(severity=None), error(severity={"a": 1})])]
    r, = parsed(spark, sent)
    assert r.status == "ok"
    assert [str(e.severity) for e in r.errors] == ["7.0", "None", "None", "None"]
    assert [e.severity_sent for e in r.errors] == ["7", "high", None, '{"a":1}']
    flagged, = ju.report_validity(ju.parse_reports(replies(spark, sent))).collect()
    assert (flagged.n_bad_severity, flagged.valid) == (2, False)
    scored = ju.parse_reports(replies(spark, sent)).select(ju.severity_score(F.col("errors")).alias("v"))
    assert scored.first().v == pytest.approx(1 - 7 / 50)
    exported, = ju.export_judgements(ju.parse_reports(replies(spark, sent))).collect()
    assert exported.severity == '7, high, None, {"a":1}'


def test_text_behind_the_list_and_fields_that_are_no_texts(spark):
    whole = json.dumps([call([error()], 1)])
    found = parsed(spark, whole + " done", whole + ", 5", whole[:-1] + "]]", "[1]] , [[2]", f' {whole}\n', "[] []", whole + whole,
                   [call([error(explanation=5)], 1)], [call([error(), error(source_chunk=["s"])], 1)], [call([7], 1)],
                   [call({"a": 1}, 1)], [7], '{"a": 1}', "[]")
    assert [r.status for r in found] == ["garbage", "garbage", "garbage", "garbage", "ok", "garbage", "garbage", "void", "void",
                                         "void", "void", "void", "garbage", "empty"]
    lenient = parsed(spark, [call([error(), error(target_chunk=True)], 1)], strict=False)
    assert [len(r.errors) for r in lenient] == [1]


def test_each_part_of_a_reply_is_read_once(spark):
    plan = ju.parse_reports(replies(spark, [call([error()])])).drop("score")._jdf.queryExecution().optimizedPlan().toString()
    # where the reply ends is asked once, and kinds are known from what was read, not from a second look at every field
    assert plan.count("$[1]") == 1 and plan.count("$[0],") == 1 and "schemaOfVariant" not in plan


def test_only_texts_count_as_texts(spark):
    odd = [5, 1.5, 1e300, True, None, {"x": 1}, ["s"]]
    found = parsed(spark, *[[call([error(**{field: value})], 1)] for field in ju.REQUIRED for value in odd])
    assert {r.status for r in found} == {"void"}
    whole, = parsed(spark, [call([error(source_chunk="", explanation=" é中\U0001f600\r\n　", error_type=" 5 ")], 1)])
    assert [tuple(e[f] for f in ("source_chunk", "explanation", "error_type")) for e in whole.errors] == [("", "é中\U0001f600", " 5 ")]


def test_rules_are_compiled_and_not_read_again_inside_the_transform(spark):
    rows = [(1, "A", "s 1", "t 2", "r 1"), (2, "A", "same", "same", "same"), (3, "A", "s", None, "r"), (4, "A", "s", "r", "r")]
    judged = annotate(spark.createDataFrame(rows, "seg_id long, system string, source string, text string, reference string"))
    found = {r.seg_id: ([e.error_type for e in r.errors], round(r.score, 6)) for r in judged.collect()}
    assert found == {1: (["Number Format"], 0.9), 2: (["Untranslated"], 0.82), 3: (["Missing Text"], 0.8), 4: ([], 1.0)}
    plan = judged._jdf.queryExecution().optimizedPlan().toString().lower()
    assert not any("transform(" in line and "ltrim" in line for line in plan.splitlines())


def test_counted_reports_read_no_text(spark):
    error = dict.fromkeys(("source_chunk", "target_chunk", "reference_chunk", "explanation"), "x") | {"error_type": "Grammar", "severity": 3}
    sent = [error, error | {"explanation": 5}, error | {"target_chunk": None}, {k: v for k, v in error.items() if k != "source_chunk"},
            error | {"error_type": ["Grammar"]}, error | {"explanation": ""}, 5, None]
    rows = [(k, "A", json.dumps([{"name": "ErrorReport", "args": {"errors": [e], "scores": 1}}])) for k, e in enumerate(sent)]
    rows += [(10, "A", '[{"args": 5}]'), (11, "A", "[null]"), (12, "A", "[5]"), (13, "A", "[]"), (14, "A", "5"), (15, "A", None)]
    df = spark.createDataFrame(rows, "seg_id long, system string, tool_calls string")
    for strict in (True, False):
        read, counted = ({r.seg_id: (r.status, r.score, [(e.error_type, e.severity, e.severity_sent) for e in r.errors or []])
                          for r in ju.parse_reports(df, strict, texts).collect()} for texts in (True, False))
        assert read == counted
        if strict:
            assert [read[k][0] for k in range(8)] == ["ok", "void", "void", "void", "void", "ok", "void", "void"]
    plan = ju.parse_reports(df, texts=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("BinaryType") == plan.count("StructField(error_type,BinaryType") > 0


def test_no_path_to_what_a_whole_reply_lacks(spark):
    one = json.dumps([call([error()], 1)])
    found = parsed(spark, one, one + ', "end of reply"', one + ', "end of reply", []', "[]", '[], "\\u0065nd of reply"', "")
    assert [r.status for r in found] == ["ok", "garbage", "garbage", "empty", "garbage", "garbage"]
    plan = ju.parse_reports(replies(spark, one))._jdf.queryExecution().optimizedPlan().toString()
    assert "$[2]" not in plan


def test_named_texts_alone_are_read(spark):
    sent = [[call([error(explanation=" a\nb ", severity="7")], 1)], [call([error(source_chunk=5)], 1)], [call([error(explanation=None)], 1)],
            [call([error(), error(target_chunk="absent")], 1)], "x"]
    df = replies(spark, *sent)
    for strict in (True, False):
        all_texts, named = (ju.export_judgements(ju.parse_reports(df, strict, texts)).orderBy("seg_id").collect() for texts in (True, ju.EXPORTED))
        assert all_texts == named
    judged = ju.parse_reports(df, texts=ju.EXPORTED)
    assert judged.schema["errors"].dataType.elementType.names == ["error_type", "severity", "explanation", "severity_sent"]
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(explanation,BinaryType" in plan and "StructField(source_chunk,VariantType" in plan
    with pytest.raises(ValueError):
        ju.parse_reports(df, texts=("severity",))


def test_replies_write_the_texts_of_a_segment_once(spark, tmp_path):
    from workloads import inputs
    text = 'a "1"\tb\\\nnïce 中 [x]\n\nlast.'
    spark.createDataFrame([(k, text) for k in range(60)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sent = inputs.replies(spark, str(tmp_path))
    rows = {(r.seg_id, r.system): r.tool_calls for r in sent.collect()}
    texts = {(r.seg_id, r.system): r for r in inputs.raw_candidates(spark, str(tmp_path)).collect()}
    read = 0
    for key, reply in rows.items():
        seg, n = key[0], int(key[1][4:])
        if (seg * 7 + n) % 23 == 0 or (seg + n) % 29 == 0 or (seg * 5 + n) % 41 == 0:
            continue
        errors = json.loads(reply)[0]["args"]["errors"]
        assert len(errors) == (0 if (seg + n) % 4 == 0 else 1 if (seg + n) % 4 == 1 else 2)
        for e in errors[:1]:
            r, read = texts[key], read + 1
            assert (e["source_chunk"], e["target_chunk"], e["reference_chunk"]) == (r.source, r.text or "", f"\n {r.reference}\r\n")
            assert e.get("said", e["explanation"]) == f"see\n{r.source} "
    assert read > 100
    # texts alone are written as JSON, not the errors that hold them
    assert "StructType" not in sent._jdf.queryExecution().optimizedPlan().toString()
