import random
from collections import Counter

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verbamark.functions import chrf as module
from verbamark.functions.chrf import chrf
from verbamark.operators.score import score_with_reference


def by_hand(text, reference):
    t, r = "".join(text.split()), "".join(reference.split())
    p = q = k = 0
    for n in range(1, 7):
        a = Counter(t[i:i + n] for i in range(len(t) - n + 1))
        b = Counter(r[i:i + n] for i in range(len(r) - n + 1))
        if a and b:
            shared = sum((a & b).values())
            p, q, k = p + shared / sum(a.values()), q + shared / sum(b.values()), k + 1
    if not k or not p:
        return 0.0
    p, q = p / k, q / k
    return 5 * p * q / (4 * p + q)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab 我🙂é", max_size=30), st.text("ab 我🙂é", max_size=30)), max_size=12))
def test_equals_counting_by_hand(pairs):
    scores = chrf(pd.Series([p[0] for p in pairs], dtype=object), pd.Series([p[1] for p in pairs], dtype=object))
    assert list(scores) == pytest.approx([by_hand(*p) for p in pairs])


def test_chunks_do_not_change_scores(monkeypatch):
    texts = pd.Series([("the cat sat " * k)[: 7 * k] for k in range(1, 60)])
    references = texts.str.replace("cat", "dog").str.cat(texts.str[::-1])
    whole = list(chrf(texts, references))
    monkeypatch.setattr(module, "CHARS_AT_ONCE", 50)
    assert list(chrf(texts, references)) == whole


def test_large_alphabets_do_not_overflow():
    text = "".join(map(chr, range(0x4E00, 0x4E00 + 15000)))
    reference = text[:8000] + text[7000:]
    assert chrf(pd.Series([text] * 3), pd.Series([reference] * 3))[2] == pytest.approx(by_hand(text, reference))


def test_null_in_null_out():
    assert chrf(pd.Series(["a", None, ""]), pd.Series([None, "a", ""])).isna().tolist() == [True, True, False]


def test_scored_by_spark(spark):
    rows = [(1, "the cat", "the cat"), (2, "a cat", "the cat"), (3, "", "x"), (4, None, "x")]
    df = spark.createDataFrame(rows, "seg_id bigint, mt string, ref string")
    found = {r.seg_id: r.score for r in score_with_reference(df).collect()}
    assert found == {1: 1.0, 2: pytest.approx(by_hand("a cat", "the cat")), 3: 0.0, 4: None}


@pytest.mark.parametrize("letters", ["ab \n\x1c", "abc\0é’", "".join(map(chr, range(0x4E00, 0x4F00)))])
def test_grams_of_all_orders_come_of_one_sort(monkeypatch, letters):
    """An alphabet that fits one key needs no sort per order; a larger one does, with the same scores."""
    rng = random.Random(2)
    texts = ["".join(rng.choices(letters, k=rng.choice([0, 1, 3, 5, 6, 7, 40]))) for _ in range(300)]
    references = [t[:len(t) // 2] + rng.choice(texts) for t in texts]
    sides = pd.Series(texts), pd.Series(references)
    with monkeypatch.context() as m:
        m.setattr(module, "KEY_BITS", 0)
        by_order = chrf(*sides)
    monkeypatch.delattr(module, "_by_order")
    assert chrf(*sides).tolist() == by_order.tolist()
    assert by_order.tolist() == pytest.approx([by_hand(*pair) for pair in zip(texts, references)])
