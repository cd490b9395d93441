"""SimHash components, components of edges, near vectors and near passages against brute force."""

import random

import numpy as np
import pytest
import xxhash

from verbamark.llm import near_vectors as nv
from verbamark.llm import simhash as sh
from verbamark.llm.components import connected_components
from verbamark.llm.near_vectors import near_vectors
from verbamark.llm import passages
from verbamark.llm.passages import SPAN, marked, near_passages
from verbamark.llm.simhash import keep_first, links, simhash_components


def components(pairs, nodes):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(n))


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame([*pairs, (None, 5)], "a long, b long")
    found = {r.node: r.component for r in connected_components(df).collect()}
    nodes = {n for p in pairs for n in p}
    assert found == components(pairs, nodes)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_find_every_pair_within_the_threshold(spark, monkeypatch):
    rng = random.Random(1)
    prints = [rng.getrandbits(64) for _ in range(200)]
    for fp in prints[:100]:
        for n in range(1, 7):
            other = fp
            for bit in rng.sample(range(64), n):
                other ^= 1 << bit
            prints.append(other)
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame(list(enumerate(signed)), "node long, fp long")
    want = components([(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4],
                      range(len(prints)))
    for hot in (sh.HOT_ANCHOR, 3):  # also with anchors cut into blocks
        monkeypatch.setattr(sh, "HOT_ANCHOR", hot)
        found = [(r.a, r.b) for r in links(nodes).collect()]
        assert all((prints[a] ^ prints[b]).bit_count() <= 64 for a, b in found)
        assert components(found, range(len(prints))) == want


def test_fingerprints_and_odd_rows(spark):
    rng = random.Random(2)
    long = words(rng, 3000)
    rows = [(5, long), (3, long.upper()), (9, None), (8, ""), (7, " \t\n"), (6, "two words"), (5, long), (None, long),
            (None, "alone here with nobody")]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, fp double")
    found = [(r.doc_id, r.fp, r.component_id) for r in simhash_components(df).collect()]
    assert len(found) == len(rows)
    shingles = [" ".join(long.split()[i:i + 5]) for i in range(2996)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert {f % (1 << 64) for i, f, _ in found if i in (3, 5)} == {fp}
    assert {c for i, f, c in found if f % (1 << 64) == fp} == {3}
    assert {(i, f, c) for i, f, c in found if i in (7, 8, 9)} == {(7, 0, 7), (8, 0, 7), (9, 0, 7)}
    assert sum(c is None for _, _, c in found) == 1
    kept = keep_first(df)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7] and kept.columns == df.columns
    assert simhash_components(df.limit(0)).count() == 0


def test_near_vectors_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 16))
    near = base[:30] + rng.normal(size=(30, 16)) * np.linspace(0.01, 0.3, 30)[:, None]
    x = np.concatenate([base, near, base[:5], -base[:3]]).astype(np.float32)
    label = [int(k) for k in rng.integers(0, 3, 60)]
    label = label + label[:30] + label[:5] + label[:3]
    rows = [(i, [float(v) for v in x[i]], label[i]) for i in range(len(x))]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 1), (904, rows[0][1], None)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    pairs = [(i, j) for i in range(len(x)) for j in range(i) if label[i] == label[j] and u[i] @ u[j] >= 0.98]
    want = components(pairs, range(len(x)))
    for part, per_cell in ((nv.PART, nv.PER_CELL), (4, 4)):
        monkeypatch.setattr(nv, "PART", part)
        monkeypatch.setattr(nv, "PER_CELL", per_cell)
        found = {r.vec_id: r for r in near_vectors(df).collect()}
        assert {i: found[i].component_id for i in want} == want
        assert all(found[i].n_links == sum(i in p for p in pairs) for i in want)
        assert all((found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True) for i, _, _ in odd)
    assert near_vectors(df.limit(0)).count() == 0


def test_near_passages(spark):
    rng = random.Random(3)
    shared, short = words(rng, 70), words(rng, 40)
    edited = shared.split()
    edited[35] = "otherword"
    rows = [(1, f"{words(rng, 200)} {shared} {words(rng, 100)}"), (2, f"{words(rng, 90)} {shared.upper()} {words(rng, 90)}"),
            (3, f"{words(rng, 60)} {' '.join(edited)}"), (4, f"{words(rng, 80)} {short} {words(rng, 80)}"),
            (5, f"{short} {words(rng, 200)}"), (6, None), (7, ""), (8, "few words"), (None, shared), (9, words(rng, 5000)),
            (10, "ha " * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_passages(df).collect()
    assert {d for r in found for d in (r.doc_id, r.other_id)} == {1, 2, 3}
    for r in found:
        a, b = (dict(rows)[i].lower().split()[s:e] for i, s, e in ((r.doc_id, r.start, r.end), (r.other_id, r.other_start, r.other_end)))
        a, b = ({tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (a, b))
        assert abs(len(a & b) / len(a | b) - r.similarity) < 1e-9 and r.similarity >= 0.8 and r.end - r.start >= 50
    assert near_passages(df.limit(0)).count() == 0


@pytest.mark.parametrize("at_once", [1, 10_000])
def test_near_passages_behind_a_part_and_over_batches(spark, at_once):
    """A document that holds the middle of a passage does not hide it, and neither copies nor batches change the rest."""
    rng = random.Random(11)
    rows, want = [], {}
    for trial in range(12):
        passage, n = words(rng, 60).split(), 3 * trial
        rows += [(n, f"{words(rng, 70)} {' '.join(passage[8:52])} {words(rng, 70)}"),
                 *((n + i, f"{words(rng, 60 + 9 * i)} {' '.join(passage)} {words(rng, 80)}") for i in (1, 2))]
        want[n + 2] = n + 1
    rows += [(100 + i, rows[2][1]) for i in range(3)]  # copies of one text
    rows += [(200, "to " * 3000), (201, "to " * 2000), (1, "few words"), rows[4]]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", at_once)
    try:
        found = near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {(r.doc_id, r.other_id) for r in found if r.doc_id < 100} == set(want.items())
    size = len(rows[2][1].split())
    assert sorted((r.doc_id, r.start, r.end, r.other_id) for r in found if 100 <= r.doc_id < 200) == [
        (100 + i, 0, size, 2) for i in range(3)]
    assert {(r.doc_id, r.other_id) for r in found if r.doc_id >= 200} == {(201, 200)}
    for r in found:
        assert r.end - r.start >= 50 and r.similarity >= 0.8


@pytest.mark.parametrize("hot", [None, 3])
def test_every_pair_of_texts_with_a_passage_is_found(spark, monkeypatch, hot):
    """Also behind many documents that hold a part of it, and where a frequent token is cut into blocks."""
    if hot:
        monkeypatch.setattr(passages, "HOT", hot)
    rng = random.Random(12)
    passage, rows = words(rng, 60).split(), []
    for k in range(24):
        part = passage if k % 3 == 2 else passage[8 - k % 7:52 - k % 7]
        rows.append((k, f"{words(rng, 60 + k)} {' '.join(part)} {words(rng, 70)}"))
    whole = [k for k in range(24) if k % 3 == 2]
    found = near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.other_id) for r in found) == [(a, b) for a in whole for b in whole if b < a]


def test_a_passage_inside_a_stretch_that_is_unlike_is_found():
    """Every third token stands elsewhere in the other text, but for sixty in the middle."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 40, 400).astype(np.uint64)
    b = a.copy()
    other = np.arange(0, 400, 3)
    other = other[(other < 170) | (other >= 230)]
    b[other] += np.uint64(1 << 41)
    b = np.concatenate([b, a[other]])
    assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.8
    found = list(passages._verified(a, b, 46, 0.8))
    assert any(start <= 175 and end >= 225 for start, end, *_ in found)
    for start, end, other_start, other_end, alike in found:
        x, y = a[start:end], b[other_start:other_end]
        assert abs(len(np.intersect1d(x, y)) / len(np.union1d(x, y)) - alike) < 1e-9 and alike >= 0.8 and end - start >= 46


def test_stretches_are_found_by_places_alone():
    rng = np.random.default_rng(8)
    for n in (1, 5, 60, 400):
        for share in (8 / 9, 0.95, 1 - 1e-6):
            b, part = rng.integers(0, 30, n).astype(np.uint64), rng.integers(0, 60, 25).astype(np.uint64)
            order = np.argsort(b, kind="stable")
            assert passages._found(order, b[order], part, share) == passages._stretch(np.isin(b, part), share)


def test_marks_meet_in_every_common_stretch():
    """Two texts that have SPAN tokens in a row in common have a mark in common, wherever the stretch stands."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        shared = rng.integers(0, 2**63, SPAN).astype(np.uint64)
        sides = []
        for _ in range(2):
            around = rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)
            cut = rng.integers(0, len(around) + 1)
            token = np.concatenate([around[:cut], shared, around[cut:]])
            sides.append(set(token[marked(np.zeros(len(token), np.int64), token)].tolist()))
        assert sides[0] & sides[1] & set(shared.tolist())
    row, token = np.repeat([0, 1], [SPAN - 1, SPAN]), np.arange(2 * SPAN - 1).astype(np.uint64)
    assert marked(row, token)[:SPAN - 1].sum() == 0 and marked(row, token).sum() == 1
    assert not marked(row[:3], token[:3]).any()


def test_words_of_texts_without_copies_are_not_counted(spark):
    """The count of words is no filter that moves below the join with copied texts."""
    rng = random.Random(7)
    rows = [(k, words(rng, 60)) for k in range(40)]
    rows += [(100, f"\t{rows[3][1]}\n"), (101, rows[5][1]), (102, rows[5][1]), (103, "few words"), (104, "few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_passages(df)
    # copies are those with the whole text of a smaller id; white space around a passage makes another text
    assert sorted((r.doc_id, r.start, r.end, r.other_id) for r in found.collect()) == [
        (100, 0, 60, 3), (101, 0, 60, 5), (102, 0, 60, 5)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.splitlines() if "Filter" in line and "split(text" in line]
    assert not counted, counted
