"""Periodic runs: against all lags of small texts, on long ones, and the registered query."""

import hashlib
import random
import re
import zlib

import pytest

from verbamark.llm import runs as module
from verbamark.llm.queries import op11_runs
from verbamark.llm.runs import find_runs, least_match, periodic_runs


def smallest_period(words):
    borders, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = borders[k - 1]
        k += words[i] == words[k]
        borders[i] = k
    return len(words) - borders[-1]


def by_all_lags(words, least=24, times=3):
    found = set()
    for q in range(1, len(words) // times + 1):
        i = q
        while i < len(words):
            first = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if i > first and length >= max(least, times * q) and smallest_period(words[start:start + length]) == q:
                found.add((start, length, q))
            i += i == first
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(r):
    words = []
    for _ in range(r.randrange(1, 6)):
        block = [r.randrange(r.choice([1, 2, 3, 5, 50])) for _ in range(r.choice([1, 2, 3, 5, 8, 13, 20, 40]))]
        if r.random() < 0.4:
            block += block[:r.randrange(len(block) + 1)] + [r.randrange(3)]
        words += block * r.choice([1, 2, 3, 4, 9]) + block[:r.randrange(len(block) + 1)]
        if r.random() < 0.3:
            words += words[-r.randrange(1, len(words) + 1):]
    return words


@pytest.mark.parametrize("least,times,rows", [(24, 3, 8), (24, 3, 0), (6, 2, 8), (24, 2, 1), (5, 4, 8), (2, 2, 8)])
def test_runs_equal_those_of_all_lags(monkeypatch, least, times, rows):
    monkeypatch.setattr(module, "ROWS_PAIRED", rows)
    r = random.Random(least * times)
    texts = [some_words(r) for _ in range(300)] + [[], [1], [1] * 23, [1] * 24, [1] * 200, [1, 2] * 12 + [1]]
    assert find_runs(texts, least, times) == [by_all_lags(t, least, times) for t in texts]


def test_least_match():
    assert least_match(24, 3) == 16
    assert least_match(24, 3) == min(max(24 - q, 2 * q) for q in range(1, 1000))


def test_long_texts():
    r = random.Random(1)
    block = [r.randrange(9) for _ in range(31)]
    assert find_runs([[7] * 300_000]) == [[(0, 300_000, 1)]]
    assert find_runs([(block * 10_000)[:300_001]]) == [[(0, 300_001, 31)]]
    phrase = list(range(100, 120))
    texts = [sum((phrase + [r.randrange(1000, 9000) for _ in range(5)] for _ in range(2000)), [])]
    assert find_runs(texts) == [by_all_lags(texts[0][:0])]


def test_runs_and_collapsed_texts(spark):
    loop = "a b c d " * 8
    texts = [(1, loop + "end."), (1, loop + "end."), (None, "x " * 30), (2, None), (3, ""), (4, " \t\n"),
             (5, "one two\x1cthree  four\x0bfive"), (6, "go " * 10 + loop + loop.upper())]
    df = spark.createDataFrame([(k, t, 0, "c") for k, t in texts], "doc_id long, text string, runs int, collapsed string")
    rows = periodic_runs(df.repartition(3)).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in by[1].runs] == [(0, 32, 4)] and by[1].collapsed == "a b c d end."
    assert [tuple(x) for x in by[None].runs] == [(0, 30, 1)] and by[None].collapsed == "x"
    assert all((by[k].n_words, by[k].runs, by[k].collapsed) == (0, [], "") for k in (2, 3, 4))
    assert by[5].collapsed == "one two\x1cthree four five" and by[5].n_words == 3
    assert [tuple(x) for x in by[6].runs] == [(10, 32, 4), (42, 32, 4)]
    assert by[6].collapsed == " ".join(["go"] * 10 + ["a b c d A B C D"])
    assert periodic_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(df, times=1)


def test_registered_query(spark):
    d = "/root/testdata/sf0.001"
    found = {r.doc_id: tuple(r)[1:] for r in op11_runs(spark, d).collect()}
    n_looped = 0
    for doc_id, text in (tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n_looped += 1
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = by_all_lags(words)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        assert found[doc_id] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())
    assert n_looped > 5
