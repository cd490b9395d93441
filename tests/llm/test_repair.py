"""Repair of conversations: against a search over all edits, over any number of parts, and the registered query."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from verbamark.llm import repair as module
from verbamark.llm.queries import damaged, op13_conversations
from verbamark.llm.repair import repair, repaired_parts

NAMES = {"s": "system", "u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"


def by_search(rows):
    """The cheapest edits of rows ``(role, text, must go, truncated)`` by search over all of them, least text first."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def best(k, last, memo):
        if (k, last) in memo:
            return memo[k, last]
        memo[k, last] = (10**9, "", ())
        found = [(0, "", ())] if k == len(rows) and last in ("", "a") else []
        steps = []
        if k < len(rows):
            role, text, gone, cut = rows[k]
            steps.append((3, "D", k + 1, last, ()))
            if not gone:
                for i in after[last]:
                    if role[:1] == i:
                        steps.append((cut, "K", k + 1, i, (f"{role}:{text}",)))
                    if i in "ua":
                        steps.append((2 + cut, "R", k + 1, i, (f"{NAMES[i]}:{text}",)))
        for cost, letter, k2, i, line in steps:
            c, a, lines = best(k2, i, memo)
            found.append((c + cost, letter + a, line + lines))
        # an insertion leads on within the row; at most three in a row can pay
        memo[k, last] = min(found) if found else (10**9, "", ())
        return memo[k, last]

    memo = {}
    for k in range(len(rows), -1, -1):
        for last in ("", "s", "u", "a"):
            best(k, last, memo)
        for _ in range(4):
            for last in ("", "s", "u", "a"):
                for i in after[last]:
                    if i in "ua":
                        c, a, lines = memo[k, i]
                        memo[k, last] = min(memo[k, last], (c + 2, "I" + a, (f"{NAMES[i]}:",) + lines))
    return memo[0, ""]


def by_plain_python(rows):
    """The result for one conversation, its rows ``(turn, role, text)`` as they are after damage."""
    rows = sorted([(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows],
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        core = text.strip(WHITE)
        fault = ("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    initials = [r[1][:1] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit, lines = by_search(marked)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"],
            counts["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(n, seed):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for _ in range(r.choice([1, 1, 2, 3, 5, 9, 14])):
            rows.append((conv if conv else None, r.choice([None, *range(12)]), r.choice(["user", "assistant", "system", "tool", "", None]),
                         r.choice(["Yes.", "No", " ", "", "What? ", "Go on!\n", None, f"It is {r.randrange(99)}.", "a:b\n."])))
        if r.random() < 0.5:
            rows += [row for row in rows[-3:] if row[0] == rows[-1][0]]
    return rows


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                                                  "audit", "repaired_sha256").collect()}


def expected(rows):
    by = {}
    for conv, *row in rows:
        by.setdefault(conv, []).append(row)
    return {conv: by_plain_python(r) for conv, r in by.items()}


@pytest.mark.parametrize("part_rows", [1, 3, 1 << 15])
def test_repair_is_the_cheapest_and_least_in_any_number_of_parts(spark, monkeypatch, part_rows):
    # parts of one row hand everything from part to part
    monkeypatch.setattr(module, "PART_ROWS", part_rows)
    rows = conversations(300, part_rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, place long")
    found = result(repair(df.repartition(5)))
    assert found == expected(rows)
    assert all(re.fullmatch("[DIKR]*", r[6]) for r in found.values())


def test_one_conversation_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(module, "PART_ROWS", 16)
    r = random.Random(3)
    rows = [(7, t, r.choice(["user", "assistant", "user"]), r.choice([f"{t}.", f"{t}", "Yes."])) for t in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(repair(df)) == expected(rows)
    parts = repaired_parts(df).orderBy("place").collect()
    assert len(parts) > 20
    whole = "\n".join(p.repaired for p in parts if p.repaired)
    assert hashlib.sha256(whole.encode()).hexdigest() == expected(rows)[7][-1]


def test_empty_tables_and_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (2, 0, "user", "Hi.")], schema)
    found = result(repair(df, F.col("conv_id") == 2))
    assert found[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[2][5:7] == (2, "KI")


def test_registered_query(spark):
    d = "/root/testdata/sf0.001"
    rows = []
    for c, t, role, text in (tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()):
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        if fault != 0:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    found = result(op13_conversations(spark, d))
    want = expected(rows)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found == {c: want.get(c, empty) for c in found} and set(want) <= set(found)


def test_damage_of_nulls(spark):
    df = spark.createDataFrame([(None, None, None, None), (5, None, "user", None)], "conv_id long, turn long, role string, text string")
    faults = [zlib.crc32(k) % 20 for k in (b" : ", b"5: ")]
    assert damaged(df).count() == sum(2 if f == 3 else 1 for f in faults)
    assert {r.text for r in damaged(df).collect()} <= {" ", ""}
