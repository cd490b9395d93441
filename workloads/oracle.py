"""SQL for DuckDB, one statement per registered query.

Inputs and operators are written here a second time, independently of the
Spark code, over the same tables.
"""

from __future__ import annotations

# What Python's str.strip() takes for whitespace, as code points.
WHITESPACE = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203),
              8232, 8233, 8239, 8287, 12288)
WS = " || ".join(f"chr({c})" for c in WHITESPACE)

SYSTEMS = [f"sys_{k}" for k in range(1, 7)]
METRICS = ("MQM_reference", "reference_based", "reference_free")

# Category and error names, as they must be matched.
TYPOLOGY = """(VALUES
 ('Accuracy', 1, 'Mistranslation', 1), ('Accuracy', 1, 'Omission', 2), ('Accuracy', 1, 'Addition', 3),
 ('Accuracy', 1, 'Untranslated', 4), ('Accuracy', 1, 'Over-translation', 5),
 ('Accuracy', 1, 'Under-translation', 6), ('Accuracy', 1, 'Do Not Translate', 7),
 ('Audience Appropriateness', 2, 'Specific Culture Reference', 1),
 ('Design and Markup', 3, 'Missing Text', 1), ('Design and Markup', 3, 'Character Formatting', 2),
 ('Fluency', 4, 'Grammar', 1), ('Fluency', 4, 'Spelling', 2), ('Fluency', 4, 'Punctuation', 3),
 ('Fluency', 4, 'Unintelligible ', 4), ('Fluency', 4, 'Character Encoding ', 5),
 ('Locale Convention', 5, 'Date Format', 1), ('Locale Convention', 5, 'Currency Format', 2),
 ('Locale Convention', 5, 'Number Format', 3), ('Locale Convention', 5, 'Measurement Format', 4),
 ('Style', 6, 'Inconsistent Style', 1), ('Style', 6, 'Inappropriate Style', 2),
 ('Style', 6, 'Awkward Style', 3), ('Style', 6, 'Organizational Style', 4), ('Style', 6, 'Register', 5),
 ('Style', 6, 'Unidiomatic Style', 6),
 ('Terminology', 7, 'Inconsistent Terminology', 1), ('Terminology', 7, 'Incorrect Terminology', 2),
 ('Terminology', 7, 'Wrong Term', 3))"""

# ---------------------------------------------------------------- inputs

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTE[name] = (tuple(needs.split()), body)


def statement(needs: str, select: str) -> str:
    """``select`` after the named inputs and all they rest on."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for n in CTE[name][0]:
                visit(n)
            order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return select.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1].strip()})" for n in order) + "\n" + select.strip()


cte("docs", "", r"""
SELECT doc_id, lang, CASE WHEN l[len(l)] = '' THEN l[1:len(l) - 1] ELSE l END AS l FROM (
  SELECT doc_id, lang, string_split(regexp_replace(text, '\r\n|\r', chr(10), 'g'), chr(10)) AS l FROM documents)""")

cte("lines", "docs", f"""
SELECT doc_id, CASE WHEN lang = 'en' THEN 'source' ELSE 'reference' END AS corpus, line_no,
  trim(raw, {WS}) AS text
FROM (SELECT doc_id, lang, unnest(l) AS raw, unnest(range(1, len(l) + 1)) AS line_no FROM docs)""")

cte("segments", "docs", f"""
SELECT doc_id * 1000000000 + k AS seg_id, trim(l[k], {WS}) AS source, trim(l[k % len(l) + 1], {WS}) AS reference
FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM docs)""")

cte("wide", "segments", """
SELECT seg_id, source, reference, reference AS sys_1, translate(reference, 'aeiou.,', 'AEIOU') AS sys_2,
  translate(reference, 'aeio0123', '') AS sys_3,
  CASE WHEN seg_id % 7 <> 0 THEN reference || ' ' || source END AS sys_4,
  CASE WHEN seg_id % 5 = 0 THEN 'Error' ELSE replace(reference, ' ', '  ') END AS sys_5,
  source AS sys_6 FROM segments""")

cte("raw", "wide", " UNION ALL ".join(
    f"SELECT seg_id, source, reference, '{s}' AS system, {k} AS n, {s} AS text FROM wide"
    for k, s in enumerate(SYSTEMS, 1)))

cte("cand", "raw", """
SELECT seg_id, source, reference, system, n, CASE WHEN text <> 'Error' THEN text END AS text,
  CASE WHEN text IS NULL THEN 'missing' WHEN text = 'Error' THEN 'error' ELSE 'ok' END AS status FROM raw""")

cte("attempts", "raw", """
SELECT seg_id, system, attempt, CASE WHEN (seg_id + n + attempt) % 3 = 0 THEN 'Error'
  WHEN (seg_id + n + attempt) % 11 <> 0 THEN text || ' #' || attempt END AS text
FROM raw, (VALUES (1), (2), (3)) t(attempt)""")

cte("settled", "attempts", """
SELECT seg_id, system, attempt, CASE WHEN text <> 'Error' THEN text END AS text,
  CASE WHEN text IS NULL THEN 'missing' WHEN text = 'Error' THEN 'error' ELSE 'ok' END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY seg_id, system
        ORDER BY CASE WHEN text = 'Error' THEN 1 ELSE 0 END, attempt) AS rn FROM attempts) WHERE rn = 1""")


def err(key: str, severity: str) -> str:
    return f"""json_object('source_chunk', source, 'target_chunk', coalesce(text, ''),
  'reference_chunk', chr(10) || ' ' || reference || chr(13) || chr(10),
  'error_type', (['Mistranslation', 'Grammar', 'Unintelligible ', 'Unintelligible', 'Wrong Term',
    'Register', 'Date Format'])[({key}) % 7 + 1],
  'severity', {severity}, 'explanation', 'see' || chr(10) || source || ' ')"""


def reply(errors: str) -> str:
    return f"""CAST(json_array(json_object('name', 'ErrorReport',
  'args', json_object('errors', {errors}, 'scores', s))) AS VARCHAR)"""


def instead(field: str, value: str, old: str) -> str:
    return f"""replace(whole, '"{field}":', '"{field}":{value},"{old}":')"""


cte("whole_replies", "raw", f"""
SELECT seg_id, system, n, CASE WHEN (seg_id * 7 + n) % 23 = 0 THEN 'garbage' WHEN a % 29 = 0 THEN '[]'
  WHEN a % 4 = 0 THEN {reply("json_array()")}
  WHEN a % 4 = 1 THEN {reply(f"json_array({err('seg_id + n * 5', 'a % 13')})")}
  WHEN a % 19 = 2 THEN {reply(f"json_array({err('a', 'seg_id % 11')}, json_object('error_type', 'Grammar'))")}
  ELSE {reply(f"json_array({err('seg_id * 3 + n', 'a % 11')}, {err('a', 'seg_id % 11')})")} END AS whole
FROM (SELECT *, seg_id + n AS a,
  CASE WHEN seg_id % 17 = 0 THEN 1.5::DOUBLE ELSE ((seg_id * 3 + n) % 10)::DOUBLE / 10 END AS s FROM raw)""")

cte("replies", "whole_replies", f"""
SELECT seg_id, system, CASE odd WHEN 0 THEN whole || ' done' WHEN 1 THEN {instead('explanation', '5', 'said')}
  WHEN 2 THEN {instead('severity', '"high"', 'was')} WHEN 3 THEN {instead('severity', '"7"', 'was')}
  WHEN 4 THEN replace(whole, '"severity":', '"weight":') WHEN 5 THEN {instead('scores', 'null', 'given')}
  WHEN 6 THEN CASE WHEN contains(whole, '"name"') THEN left(whole, length(whole) - 1)
    || ',{{"name":"ErrorReport","args":{{"errors":[{{"error_type":"Omission"}}],"scores":0.9}}}}]' ELSE whole END
  ELSE whole END AS tool_calls
FROM (SELECT *, (seg_id * 5 + n) % 41 AS odd FROM whole_replies)""")

cte("first", "replies", """
SELECT seg_id, system, reply, CASE WHEN reply = 'report' THEN json_extract(j, '$[0].args') END AS args
FROM (SELECT seg_id, system, j, CASE WHEN tool_calls IS NULL THEN 'missing' WHEN j IS NULL THEN 'garbage'
        WHEN json_array_length(j) = 0 THEN 'empty' ELSE 'report' END AS reply
      FROM (SELECT *, CASE WHEN json_valid(tool_calls) THEN tool_calls::JSON END AS j FROM replies))""")


def clean(field: str) -> str:
    return f"trim(replace(replace({field}, chr(10), ' '), chr(13), ''), {WS})"


def text_of(field: str) -> str:
    """A field's value if it is a text."""
    return f"CASE WHEN json_type(e, '$.{field}') = 'VARCHAR' THEN json_extract_string(e, '$.{field}') END"


# one list of structs per reply; an error lacks a required field that is no text. A score given as null is 0
cte("reports", "first", f"""
SELECT seg_id, system, reply, CASE WHEN json_type(args, '$.scores') = 'NULL' THEN 0
    ELSE TRY_CAST(json_extract_string(args, '$.scores') AS DOUBLE) END AS score,
  list_transform(json_extract(args, '$.errors[*]'), lambda e: {{
    'source_chunk': {clean(text_of('source_chunk'))},
    'target_chunk': {clean(text_of('target_chunk'))},
    'reference_chunk': {clean(text_of('reference_chunk'))},
    'error_type': {text_of('error_type')},
    'severity': TRY_CAST(json_extract_string(e, '$.severity') AS DOUBLE),
    'explanation': {clean(text_of('explanation'))},
    'severity_sent': json_extract_string(e, '$.severity')}}) AS errors FROM first""")

FULL = ("e.source_chunk IS NOT NULL AND e.target_chunk IS NOT NULL AND e.reference_chunk IS NOT NULL "
        "AND e.error_type IS NOT NULL AND e.explanation IS NOT NULL")

cte("judged", "reports", """
SELECT seg_id, system, status, CASE WHEN status = 'ok' THEN errors END AS errors,
  CASE WHEN status = 'ok' THEN score END AS score
FROM (SELECT *, CASE WHEN reply <> 'report' THEN reply
        WHEN score IS NOT NULL AND len(list_filter(errors, lambda e: """ + FULL + """)) = len(errors) THEN 'ok'
        ELSE 'void' END AS status FROM reports)""")

cte("names", "judged", "SELECT system, unnest(list_transform(errors, lambda e: e.error_type)) AS error_type FROM judged")

cte("typology", "", f"SELECT * FROM {TYPOLOGY} t(category, category_ord, error_type, error_ord)")

COUNT = """SELECT system, category, category_ord, error_type, error_ord, count(*) AS n_errors
FROM {names} JOIN typology USING (error_type) GROUP BY ALL"""

cte("counts", "names typology", COUNT.format(names="names"))

cte("exported", "judged", """
SELECT seg_id, system, coalesce(array_to_string(list_transform(errors, lambda e: e.error_type), ', '), '') AS error_type,
  coalesce(array_to_string(list_transform(errors, lambda e: coalesce(e.severity_sent, 'None')), ', '), '') AS severity,
  coalesce(array_to_string(list_transform(errors, lambda e: e.explanation), chr(10)), '') AS explanation,
  coalesce(score, 0) AS score FROM judged""")

CLOSE = ("CASE WHEN least(length({a}), length({b})) > 0 THEN least(length({a}), length({b}))::DOUBLE "
         "/ greatest(length({a}), length({b})) END")

cte("scores", "cand", f"""
SELECT seg_id, system, 'MQM_reference' AS metric,
  CASE WHEN text IS NOT NULL THEN {CLOSE.format(a='text', b='reference')} END AS score FROM cand
UNION ALL SELECT seg_id, system, 'reference_based',
  CASE WHEN text IS NOT NULL THEN 1.0::DOUBLE / len(string_split(text, ' ')) END FROM cand
UNION ALL SELECT seg_id, system, 'reference_free',
  CASE WHEN text IS NOT NULL THEN {CLOSE.format(a='text', b='source')} END FROM cand""")

for metric in METRICS:
    cte(f"table_{metric}", "wide scores", "SELECT w.seg_id, source, reference, "
        + ", ".join(f"{s}, {s}_score" for s in SYSTEMS) + " FROM wide w LEFT JOIN (SELECT seg_id, "
        + ", ".join(f"max(score) FILTER (system = '{s}') AS {s}_score" for s in SYSTEMS)
        + f" FROM scores WHERE metric = '{metric}' GROUP BY seg_id) p ON w.seg_id = p.seg_id")

MARKS = "len(regexp_extract_all({t}, '[.,;:!?]'))"
DIGITS = "regexp_extract_all({t}, '[0-9]+')"
RULES = (
    ("Missing Text", 10, "missing"),
    ("Untranslated", 9, "NOT missing AND text = source"),
    ("Omission", 6, "NOT missing AND length(reference) > 0 AND length(text) / length(reference)::DOUBLE < 0.7"),
    ("Addition", 4, "NOT missing AND length(reference) > 0 AND length(text) / length(reference)::DOUBLE > 1.3"),
    ("Number Format", 5, f"NOT missing AND {DIGITS.format(t='text')} <> {DIGITS.format(t='reference')}"),
    ("Punctuation", 2, f"NOT missing AND {MARKS.format(t='text')} <> {MARKS.format(t='reference')}"),
    ("Character Encoding ", 7, "NOT missing AND contains(text, chr(65533))"),
)

cte("ruled", "cand", "SELECT seg_id, system, list_filter(["
    + ", ".join(f"CASE WHEN {cond} THEN {{'t': '{name}', 's': {sev}}} END" for name, sev, cond in RULES)
    + f"], lambda e: e IS NOT NULL) AS errors FROM (SELECT *, coalesce(trim(text, {WS}), '') = '' AS missing FROM cand)")

# ---------------------------------------------------------------- queries

LEVELS = "system, category, category_ord, error_type, error_ord"
CATEGORIES = ("Accuracy", "Audience Appropriateness", "Design and Markup", "Fluency",
              "Locale Convention", "Style", "Terminology")

ORACLES = {
    "line_scan": statement("lines", "SELECT doc_id, line_no, text FROM lines"),
    "clean_text": f"SELECT doc_id, {clean('text')} AS text FROM documents",
    "align_segments": statement("lines", """
SELECT coalesce(s.p, r.p) AS seg_id, s.text AS source, r.text AS reference,
  CASE WHEN r.p IS NULL THEN 'source_only' WHEN s.p IS NULL THEN 'reference_only' ELSE 'both' END AS side
FROM (SELECT text, row_number() OVER (ORDER BY doc_id, line_no) AS p FROM lines WHERE corpus = 'source') s
FULL JOIN (SELECT text, row_number() OVER (ORDER BY doc_id, line_no) AS p FROM lines
  WHERE corpus = 'reference') r ON s.p = r.p"""),
    "alignment_check": statement("lines", """
SELECT n_source, n_reference, least(n_source, n_reference) AS n_aligned,
  greatest(n_source - n_reference, 0) AS n_source_only, greatest(n_reference - n_source, 0) AS n_reference_only,
  n_source = n_reference AS equal_length
FROM (SELECT count(*) FILTER (corpus = 'source') AS n_source,
  count(*) FILTER (corpus = 'reference') AS n_reference FROM lines)"""),
    "candidates_long": statement("cand", "SELECT seg_id, source, reference, system, text, status FROM cand"),
    "system_projection": statement("wide", "SELECT seg_id, source, reference, sys_3 FROM wide"),
    "resolve_attempts": statement("settled", "SELECT * FROM settled"),
    "quota_slots": statement("raw", "SELECT seg_id, system, CAST((seg_id * 6 + n) % 4 AS INT) AS slot FROM raw"),
    "failure_report": statement("settled", """
SELECT s.*, n_attempts, n_failed_attempts FROM (
  SELECT system, count(*) AS n_candidates, count(*) FILTER (status = 'ok') AS n_ok,
    count(*) FILTER (status = 'missing') AS n_missing, count(*) FILTER (status = 'error') AS n_error
  FROM settled GROUP BY system) s
JOIN (SELECT system, count(*) AS n_attempts, count(*) FILTER (text = 'Error') AS n_failed_attempts
  FROM attempts GROUP BY system) a ON s.system = a.system""").replace(
        "SELECT s.*,", "SELECT s.system, n_candidates, n_ok, n_missing, n_error,"),
    "typology_dim": statement("names typology", """
SELECT t.error_type, category, category_ord, error_ord, count(n.error_type) AS n_errors
FROM typology t LEFT JOIN names n ON t.error_type = n.error_type GROUP BY ALL"""),
    "category_members": statement("counts", """
SELECT DISTINCT category, category_ord, error_type, error_ord FROM counts ORDER BY category_ord, error_ord"""),
    # The labels of a prompt.
    "judge_prompts": statement("cand", """
SELECT seg_id, system, '原文: ' || coalesce(source, 'nan') || ';中文: ' || coalesce(text, 'nan')
  || ';参考译文: ' || coalesce(reference, 'nan') AS prompt FROM cand"""),
    "parse_reports": statement("judged", """
SELECT seg_id, system, status, score, CAST(k - 1 AS INT) AS at, errors[k].source_chunk AS source_chunk,
  errors[k].target_chunk AS target_chunk, errors[k].reference_chunk AS reference_chunk,
  errors[k].error_type AS error_type, errors[k].severity AS severity, errors[k].explanation AS explanation,
  errors[k].severity_sent AS severity_sent
FROM (SELECT *, unnest(CASE WHEN len(errors) > 0 THEN range(1, len(errors) + 1) ELSE [NULL] END) AS k FROM judged)"""),
    "first_report": statement("first", """
SELECT seg_id, system, reply, CAST(json_array_length(args, '$.errors') AS INT) AS n_errors,
  CASE WHEN json_type(args, '$.scores') = 'NULL' THEN 0
  ELSE TRY_CAST(json_extract_string(args, '$.scores') AS DOUBLE) END AS score FROM first"""),
    "report_validity": statement("judged", """
SELECT seg_id, system, status, CAST(len(errors) AS INT) AS n_errors, CAST(bad AS INT) AS n_bad_severity,
  score BETWEEN 0 AND 1 AS score_in_range,
  status = 'ok' AND coalesce(score BETWEEN 0 AND 1, false) AND coalesce(bad, 0) = 0 AS valid
FROM (SELECT *, len(list_filter(errors, lambda e: e.severity < 0 OR e.severity > 10
  OR (e.severity IS NULL AND e.severity_sent IS NOT NULL))) AS bad FROM judged)"""),
    "judged_defaults": statement("cand judged", """
SELECT c.seg_id, c.system, c.status AS text_status, coalesce(j.status, 'missing') AS status,
  CAST(coalesce(len(j.errors), 0) AS INT) AS n_errors, coalesce(j.score, 0) AS score
FROM cand c LEFT JOIN (SELECT * FROM judged WHERE status = 'ok') j ON c.seg_id = j.seg_id AND c.system = j.system"""),
    "judged_export": statement("exported", "SELECT * FROM exported"),
    "error_breakdown": statement("counts", "SELECT * FROM counts ORDER BY system, category_ord, error_ord"),
    "error_breakdown_dense": statement("counts", f"""
SELECT s.system, t.category, t.category_ord, t.error_type, t.error_ord, coalesce(c.n_errors, 0) AS n_errors
FROM typology t CROSS JOIN (VALUES {', '.join(f"('{s}')" for s in SYSTEMS)}) s(system)
LEFT JOIN counts c ON c.system = s.system AND c.error_type = t.error_type"""),
    "error_breakdown_from_text": statement("exported typology", COUNT.format(
        names="(SELECT system, unnest(string_split(error_type, ', ')) AS error_type FROM exported) n")),
    "error_breakdown_trimmed": statement("names typology", """
SELECT system, category, category_ord, t.error_type, error_ord, count(*) AS n_errors
FROM names n JOIN typology t ON rtrim(n.error_type, ' ') = rtrim(t.error_type, ' ') GROUP BY ALL"""),
    "error_breakdown_lenient": statement("reports typology", COUNT.format(
        names=f"(SELECT system, unnest(list_transform(list_filter(errors, lambda e: {FULL}), lambda e: e.error_type)) "
              "AS error_type FROM reports WHERE reply = 'report') n")),
    "unknown_error_types": statement("names typology", """
SELECT system, error_type, count(*) AS n_errors FROM names
WHERE error_type NOT IN (SELECT error_type FROM typology) GROUP BY ALL"""),
    "category_totals": statement("counts", """
SELECT system, category, category_ord, CAST(sum(n_errors) AS BIGINT) AS n_errors FROM counts GROUP BY ALL"""),
    "error_shares": statement("counts", f"""
SELECT {LEVELS}, n_errors, CAST(sum(n_errors) OVER (PARTITION BY system, category) AS BIGINT) AS n_category,
  round(sum(n_errors) OVER (PARTITION BY system, category)::DOUBLE / sum(n_errors) OVER (PARTITION BY system), 6)
    AS category_share,
  round(n_errors::DOUBLE / sum(n_errors) OVER (PARTITION BY system), 6) AS error_share FROM counts"""),
    "system_averages": statement("judged", """
SELECT 'MQM_reference' AS metric, system, count(*) AS n_rows, count(*) AS n_scored,
  round(avg(coalesce(score, 0)), 6) AS mean_score FROM judged GROUP BY system"""),
    "numeric_means": statement("table_reference_based", "SELECT "
        + ", ".join(f"round(avg({s}_score), 6) AS {s}_score" for s in SYSTEMS) + " FROM table_reference_based"),
    "score_table_wide": statement("table_reference_free", "SELECT * FROM table_reference_free"),
    "score_table_with_average": statement("table_MQM_reference", f"""
SELECT * FROM table_MQM_reference
UNION ALL SELECT NULL, 'Average', '', """ + ", ".join(f"'', round(avg({s}_score), 6)" for s in SYSTEMS)
        + " FROM table_MQM_reference"),
    "score_series": statement("scores", """
SELECT metric, system, seg_id, score, false AS is_average FROM scores
UNION ALL SELECT metric, system, NULL, round(avg(score), 6), true FROM scores GROUP BY metric, system"""),
    "model_comparison": statement("scores", "SELECT system, "
        + ", ".join(f'round(avg(score) FILTER (metric = \'{m}\'), 6) AS "{m}"' for m in METRICS)
        + " FROM scores GROUP BY system"),
    "scoring_input_ref": statement("cand", """
SELECT seg_id, system, source AS src, text AS mt, reference AS ref FROM cand WHERE text IS NOT NULL"""),
    "scoring_input_noref": statement("cand", """
SELECT seg_id, system, source AS src, text AS mt FROM cand WHERE text IS NOT NULL"""),
    "rule_annotations": statement("ruled", """
SELECT seg_id, system, array_to_string(list_transform(errors, lambda e: e.t), '|') AS error_types,
  CAST(len(errors) AS INT) AS n_errors,
  round(greatest(0, 1 - coalesce(list_sum(list_transform(errors, lambda e: e.s)), 0)::DOUBLE / 50), 6) AS score FROM ruled"""),
    "rule_breakdown": statement("ruled typology", COUNT.format(
        names="(SELECT system, unnest(list_transform(errors, lambda e: e.t)) AS error_type FROM ruled) n")),
    "severity_score": statement("judged", """
SELECT seg_id, system, CASE WHEN errors IS NOT NULL THEN round(greatest(0, 1 -
  coalesce(list_sum(list_transform(errors, lambda e: coalesce(e.severity, 0))), 0) / 50), 6) END AS severity_score FROM judged"""),
    "score_with_reference": statement("cand", f"""
SELECT seg_id, system, round(CASE WHEN p + r > 0 THEN 5 * p * r / (4 * p + r) ELSE 0 END, 6) AS score
FROM (SELECT id // 10 AS seg_id, 'sys_' || id % 10 AS system,
    coalesce(avg(shared / n_text) FILTER (n_text > 0 AND n_reference > 0), 0) AS p,
    coalesce(avg(shared / n_reference) FILTER (n_text > 0 AND n_reference > 0), 0) AS r
  FROM (SELECT id, o, sum(a)::DOUBLE AS n_text, sum(b)::DOUBLE AS n_reference, sum(least(a, b))::DOUBLE AS shared
    FROM (SELECT id, o, gram, count(*) FILTER (in_text) AS a, count(*) FILTER (NOT in_text) AS b
      FROM (SELECT id, in_text, o,
          unnest(list_transform(range(1, length(t) - o + 2), lambda k: substr(t, k, o))) AS gram
        FROM (SELECT seg_id * 10 + n AS id, true AS in_text, translate(text, {WS}, '') AS t
            FROM cand WHERE text IS NOT NULL
          UNION ALL SELECT seg_id * 10 + n, false, translate(reference, {WS}, '')
            FROM cand WHERE text IS NOT NULL) texts, range(1, 7) orders(o))
      GROUP BY ALL) GROUP BY ALL) GROUP BY ALL)
UNION ALL SELECT seg_id, system, 0 FROM cand WHERE text IS NOT NULL
  AND translate(text || reference, {WS}, '') = ''"""),
    "score_reference_free": """
SELECT vec_id, round(CASE WHEN na * nb > 0 THEN d / (na * nb) END, 6) AS score FROM (
  SELECT a.vec_id, list_sum(list_transform(range(1, len(a.embedding) + 1),
      lambda k: a.embedding[k]::DOUBLE * b.embedding[k]::DOUBLE)) AS d,
    sqrt(list_sum(list_transform(a.embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS na,
    sqrt(list_sum(list_transform(b.embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS nb
  FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1)""".strip(),
    "hooked_attempts": statement("segments", """
SELECT seg_id, 'steady' AS system, CAST(1 AS INT) AS attempt, source || '!' AS text, CAST(NULL AS VARCHAR) AS error FROM segments
UNION ALL SELECT seg_id, 'flaky', CAST(attempt AS INT), CASE WHEN turn <> 2 THEN 'Error' WHEN length(source) % 7 <> 0
    THEN source || ' (' || (seg_id + attempt - 1) % 3 || ')' END, CASE WHEN turn = 0 THEN 'ConnectionError: busy' END
FROM (SELECT *, min(CASE WHEN turn = 2 THEN attempt END) OVER (PARTITION BY seg_id) AS answered
  FROM (SELECT *, (length(source) + (seg_id + attempt - 1) % 3) % 3 AS turn
    FROM segments, (VALUES (1), (2), (3)) t(attempt))) WHERE attempt <= coalesce(answered, 3)"""),
    "hooked_judgements": statement("cand", """
SELECT seg_id, system, text_status, outcome AS status, CASE WHEN outcome = 'ok' THEN (n % 10)::DOUBLE / 10 ELSE 0 END AS score,
  CAST(CASE WHEN outcome = 'ok' AND n % 3 <> 0 THEN 1 ELSE 0 END AS INT) AS n_errors,
  CASE WHEN outcome = 'ok' AND n % 3 <> 0 THEN (['Mistranslation', 'Grammar', 'Unintelligible ', 'Unintelligible', 'Wrong Term',
    'Register', 'Date Format'])[n % 7 + 1] END AS error_type,
  CAST(CASE WHEN n IS NULL THEN NULL WHEN n % 11 = 0 OR n % 13 = 0 THEN 3 ELSE 1 END AS INT) AS judge_calls,
  CASE WHEN n % 11 = 0 THEN 'RuntimeError: quota' WHEN n % 13 = 0 THEN NULL WHEN n % 17 = 0 THEN 'ValueError: odd' END AS judge_error
FROM (SELECT *, CASE WHEN n IS NULL OR n % 11 = 0 THEN 'missing' WHEN n % 13 = 0 THEN 'empty' WHEN n % 17 = 0 THEN 'missing'
    ELSE 'ok' END AS outcome
  FROM (SELECT seg_id, system, status AS text_status, CASE WHEN text IS NOT NULL THEN length('原文: ' || coalesce(source, 'nan')
    || ';中文: ' || text || ';参考译文: ' || coalesce(reference, 'nan')) END AS n FROM cand))"""),
    "score_pixels": statement("scores", """
SELECT DISTINCT metric, system, unnest([a.seg_id, b.seg_id, c.seg_id, d.seg_id]) AS seg_id,
  unnest([a.score, b.score, c.score, d.score]) AS score
FROM (SELECT metric, system, min({'seg_id': seg_id, 'score': score}) AS a, max({'seg_id': seg_id, 'score': score}) AS b,
    min({'score': score, 'seg_id': seg_id}) AS c, max({'score': score, 'seg_id': seg_id}) AS d
  FROM (SELECT *, (seg_id - min(seg_id) OVER ()) * 500 // (max(seg_id) OVER () - min(seg_id) OVER () + 1) AS pixel
    FROM scores WHERE score IS NOT NULL) GROUP BY metric, system, pixel)"""),
    "mqm_scorecard": statement("judged counts", """
SELECT j.system, n_judged, n_failed, mean_score, n_errors, """
        + ", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in CATEGORIES) + """
FROM (SELECT system, count(*) AS n_judged, count(*) FILTER (status <> 'ok') AS n_failed,
    round(avg(coalesce(score, 0)), 6) AS mean_score, CAST(sum(coalesce(len(errors), 0)) AS BIGINT) AS n_errors
  FROM judged GROUP BY system) j
LEFT JOIN (SELECT system, """
        + ", ".join(f"CAST(sum(n_errors) FILTER (category = '{c}') AS BIGINT) AS \"{c}\"" for c in CATEGORIES)
        + " FROM counts GROUP BY system) c ON c.system = j.system"),
    "metric_scorecard": statement("scores", "SELECT system, "
        + ", ".join(f"count(score) FILTER (metric = '{m}') AS \"{m}_n\", "
                    f"round(avg(score) FILTER (metric = '{m}'), 6) AS \"{m}_mean\"" for m in METRICS)
        + " FROM scores GROUP BY system"),
}
