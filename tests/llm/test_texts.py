"""Pseudonyms, languages, quality, packing, mixing and page texts on small tables."""

import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verbamark.llm import language, mixing
from verbamark.llm.language import identify
from verbamark.llm.mixing import mix, rake
from verbamark.llm.packing import best_fill, pack
from verbamark.llm.page_text import main_text
from verbamark.llm.pii import PATTERNS, feistel, kind_of, pseudonymise
from verbamark.llm.quality import classify

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format_and_link_values(spark):
    texts = ["card 4349000490986231 and 4349-0004-9098-6231 not 4349000490986232", "mail a.b@mail3.example.com or A.B@mail3.example.com",
             "call +1 (736) 555-2678", "ip 16.195.23.156.", "iban DE89 3704 0044 0532 0130 00", "ssn 123-45-6789 and 000-12-1234",
             "on 1990-02-28, 31/12/1999, 5.3.2001 not 31/02/1999", 'token = "0641917ea4e9feb9cda83477"', "", None, "v2.0 of 3.14 in 2024"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    rows = {r.doc_id: r.text for r in pseudonymise(df, "key").collect()}
    again = {r.doc_id: r.text for r in pseudonymise(df, "key").collect()}
    other = {r.doc_id: r.text for r in pseudonymise(df, "another").collect()}
    assert rows == again and len(rows) == len(texts)
    for i, t in enumerate(texts[:8]):
        assert rows[i] != t and rows[i] != other[i] and [c for c in rows[i] if c in "@-()+ "] == [c for c in t if c in "@-()+ "]
    card = rows[0].split()
    assert luhn(card[1]) and card[1] == card[3].replace("-", "") and card[5] == "4349000490986232"
    mails = rows[1].split()
    assert mails[1] == mails[3].lower() and mails[1].endswith(".com")
    assert rows[5].endswith("000-12-1234") and "31/02/1999" in rows[6]
    assert [rows[i] for i in (8, 9, 10)] == [texts[8], None, texts[10]]
    assert pseudonymise(df.limit(0), "key").columns == df.columns


def test_secrets_are_never_left(spark):
    digits = ["4349000490986232", "4111111111111112", "1234567890123456", "9" * 13, "8" * 19, "AKIA", "2024-02-31"]
    texts = [f"password={d}" for d in digits[:5]] + [f'api_key: "{d}" and so on' for d in digits[:5]]
    texts += ["token = " + "a1B2" * 3, "password: " + "Zz9_" * 1000, "secret=" + "7" * 5000, "token=" + "x" * 512 + "4111111111111112"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in pseudonymise(df, "key").collect()}
    for k, t in enumerate(texts):
        value = re.split("[=:]", t)[1].strip(' "').split('"')[0]
        assert value not in rows[k] and len(rows[k]) == len(t) and rows[k][:5] == t[:5]
        # not a tail of it either
        assert value[-16:] not in rows[k][-40:]
    assert len({rows[k].split("=")[-1] for k in range(5)}) == 5


def test_hard_texts_neither_end_the_job_nor_keep_an_address(spark):
    hard = ["x@" + "a." * 100_000, "x@" + "a." * 100_000 + "com", "a" * 1_000_000, "1" * 1_000_000, "a." * 300_000 + "@b.com",
            "=" + "ab1_" * 250_000, "@" * 100_000, "1-" * 200_000, "+1 " * 100_000]
    plain = ["jörg@example.com", "ask müller.ß@mail.example.org.", "a@b.com.1", "x@10.0.0.1", "a@b", "a@b.c", "u@v-w.co.uk,"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(hard + plain)], "doc_id long, text string")
    rows = [r.text for r in pseudonymise(df, "key").orderBy("doc_id").collect()]
    address = len(hard) + 3  # an address of a machine may change its length
    assert [len(r) for k, r in enumerate(rows) if k != address] == [len(t) for k, t in enumerate(hard + plain) if k != address]
    found = rows[len(hard):]
    assert "rg@" not in found[0] and found[0].endswith(".com") and found[0][1] == "ö" and found[0][0] != "j"
    assert found[1].startswith("ask ") and "ller" not in found[1] and found[1].endswith(".org.")
    assert "a@b.com" not in found[2] and found[4:6] == plain[4:6] and found[3] != plain[3] and found[6].endswith(".uk,") and found[6] != plain[6]


def test_the_key_can_stay_out_of_the_plan(spark, tmp_path):
    (tmp_path / "key").write_text("a very private key\n")
    df = spark.createDataFrame([(1, "ssn 123-45-6789", "k")], "doc_id long, text string, key string")
    shown, hidden = pseudonymise(df, "a very private key"), pseudonymise(df, key_file=str(tmp_path / "key"))
    assert shown.collect() == hidden.collect() and hidden.columns == df.columns
    assert "private" not in hidden._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        pseudonymise(df)


def test_the_network_permutes_a_small_format(spark):
    """Brute force: all numbers of two places, of bases 10 and 7, come out once each."""
    values = [(a, b) for a in range(10) for b in range(7)]
    df = spark.createDataFrame([([a, b],) for a, b in values], "v array<long>")
    for key in ("k1", "k2"):
        new = df.select(feistel(F.col("v"), F.array(F.lit(10), F.lit(7)).cast("array<long>"), F.lit(key), F.lit("x")).alias("n"))
        assert sorted(tuple(r.n) for r in new.collect()) == values


def test_pseudonyms_are_one_to_one_and_valid(spark):
    cards = [f"4{k:014d}" for k in range(300)]
    cards = [c + next(d for d in "0123456789" if luhn(c + d)) for c in cards]
    ssn = [f"{a:03d}-{g:02d}-0001" for a in range(1, 101) for g in (1, 99)]
    days = [f"{y}-{m:02d}-28" for y in range(1950, 1970) for m in range(1, 13)]
    values = cards + ssn + days
    df = spark.createDataFrame([(v, v) for v in values], "old string, text string")
    new = {r.old: r.text for r in pseudonymise(df, "key").collect()}
    assert len(set(new.values())) == len(values)
    kinds = spark.createDataFrame([(v,) for v in new.values()], "text string").select(kind_of(F.col("text")).alias("k"))
    assert {r["count"] for r in kinds.groupBy("k").count().collect()} == {300, 200, 240}
    assert set(PATTERNS) >= {"card", "ssn", "date"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    alphabets = {"aa": list("abcde") + [" "], "bb": list("vwxyz") + [" "]}
    rows = [(i, "".join(rng.choice(alphabets[k], 200)), k) for i in range(40) for k in ("aa", "bb")]
    return spark.createDataFrame([(i, t, k, int(k == "aa")) for i, (_, t, k) in enumerate(rows)],
                                 "doc_id long, text string, lang string, quality int")


def test_language(spark, labelled):
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "123 !?"), (903, "abcde abc " * 40_000), (904, "a"), (904, "a"),
                                 (905, "ﬀøœǿ" * 60)], "doc_id long, text string").withColumn("score", F.lit("kept out"))
    even = F.col("doc_id") % 4 < 2
    found = identify(odd, labelled.where(even), labelled.where(~even))
    rows = [(r.doc_id, r.lang_pred, r.rejected) for r in found.collect()]
    assert sorted(rows[:5]) == [(900, "und", True), (901, "und", True), (902, "und", True), (903, "aa", False), (904, "aa", False)]
    assert len(rows) == 7 and rows[6][2]
    right = identify(labelled, labelled.where(even), labelled.where(~even))
    assert right.where("lang = lang_pred and score between 0 and 1").count() == labelled.count()
    assert identify(odd.limit(0), labelled, labelled).count() == 0
    nothing = identify(odd, labelled.limit(0), labelled.limit(0)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_quality(spark, labelled):
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "abc" * 50_000), (902, "abc")], "doc_id long, text string")
    rows = classify(odd, labelled).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    found = classify(labelled, labelled)
    assert found.where((F.col("score") > 0.5) == (F.col("quality") == 1)).count() >= 0.95 * labelled.count()
    assert {r.score for r in classify(odd, labelled.limit(0)).collect()} == {0.5}
    assert classify(odd.limit(0), labelled).count() == 0


def test_packing_returns_every_id_once(spark):
    texts = ["Some words, ÉTÉ and more. " * n for n in (1, 3, 50, 400, 700)] + [None, "", "  ", "x<|endoftext|>y z", "don't 3.5 a.b, c).",
             "x" * 9000, "same", "same"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).withColumn("start", F.lit("clash"))
    rows = pack(df, TOKENIZER, 256).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == i)
        assert [o[0] for o in own] == [sum(o[1] for o in own[:k]) for k in range(len(own))]
        assert sum(o[1] for o in own) == len(ids) and {o[3] for o in own} == {len(ids)}
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c, _ in own)
    sizes = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sizes.get(r.sequence_id, 0)
        sizes[r.sequence_id] = r.offset + r.length
    assert all(n <= 256 and n & (n - 1) == 0 for n in sizes.values())
    assert pack(df.limit(0), TOKENIZER).count() == 0


def test_best_fill_is_the_closest():
    from collections import Counter
    from itertools import product

    for counts, room in ((Counter({7: 2, 5: 3, 3: 1}), 20), (Counter({9: 1, 8: 2}), 7), (Counter({4: 9}), 30), (Counter(), 5)):
        chosen, slack = best_fill(counts, room)
        every = [sum(n * k for n, k in zip(counts, take)) for take in product(*(range(c + 1) for c in counts.values()))]
        assert slack == room - max(x for x in every if x <= room)
        assert sum(n * k for n, k in chosen.items()) == room - slack and all(counts[n] >= k for n, k in chosen.items())


def test_raking_meets_the_margins_either_way(spark, monkeypatch):
    rng = np.random.default_rng(1)
    cells = spark.createDataFrame([(a, b, int(rng.integers(1, 100))) for a in "xyz" for b in "pq"], "a string, b string, tokens long")
    targets = {"a": spark.createDataFrame([("x", 0.5), ("y", 0.25), ("z", 0.25), ("absent", 0.3)], "a string, share double"),
               "b": spark.createDataFrame([("p", 0.9), ("q", 0.1)], "b string, share double")}
    for limit in (mixing.MAX_CELLS, 0):
        monkeypatch.setattr(mixing, "MAX_CELLS", limit)
        found = rake(cells, targets)
        total = found.agg(F.sum("w")).first()[0]
        for column, want in (("a", {"x": 0.5, "y": 0.25, "z": 0.25}), ("b", {"p": 0.9, "q": 0.1})):
            got = {r[column]: r.w / total for r in found.groupBy(column).agg(F.sum("w").alias("w")).collect()}
            assert got == pytest.approx(want, abs=1e-8)


def test_mixing_draws_the_budget_and_keeps_odd_rows(spark):
    rows = [(i, "several words about nothing much " * (1 + i % 5), "big" if i % 3 else None, "en") for i in range(600)]
    rows += [(900, None, "big", None), (901, "", "none", "en"), (901, "", "none", "en"), (None, "words", "big", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("topic", F.lit("clash"))
    found = mix(df)
    assert found.count() == len(rows)
    share = found.where("_selected").agg(F.sum("_tokens")).first()[0] / found.agg(F.sum("_tokens")).first()[0]
    assert 0.4 < share < 0.6
    assert {r._tokens for r in found.where("doc_id >= 900").collect()} == {0}
    assert mix(df.limit(0)).count() == 0


def test_page_text(spark):
    def page(body, title):
        return (f"<html><head><title>t</title></head><body><div class='box'>Our site <b>slogan</b></div><nav><a>menu</a></nav>{body}"
                f"<footer>&copy; {title}</footer></body></html>")
    rows = [(k, "http://a.org/x", page(f"<article><h1>T{k}</h1><p>One&nbsp;&amp;\n two{k}<p>same in all<form>no</form></article>", k)) for k in range(4)]
    rows += [(10 + k, "http://b.org/", page(f"<div><p>text {k} of a page</p></div><section>same <i>notice</i></section>", k)) for k in range(4)]
    rows += [(20, None, None), (21, "", ""), (22, "http://c.org", "<p>cut<p>off &am"), (22, "http://c.org", "<p>cut<p>off &am"),
             (23, "http://d.org", "<div>" * 3000 + "deep"), (24, "x", "<script>a<b</script>1 < 2 <!-- no --><a hre")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = [(r.page_id, r.text, r.n_chars) for r in main_text(df).collect()]
    assert len(found) == len(rows) and all(n == len(t) for _, t, n in found)
    text = {i: t for i, t, _ in found}
    assert all(text[k] == f"T{k} One & two{k} same in all" for k in range(4))
    assert all(text[10 + k] == f"text {k} of a page" for k in range(4))
    assert [text[k] for k in (20, 21, 22, 23, 24)] == ["", "", "cut off &am", "deep", "1 < 2"]
    assert main_text(df.limit(0)).count() == 0


def filler(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n))


def test_templates_inside_and_around_articles_go(spark):
    rng, pages, want = random.Random(8), [], {}

    def page(host, body, text):
        pages.append((len(pages), f"https://{host}/{len(pages)}", f"<html><body>{body}</body></html>"))
        want[len(pages) - 1] = text

    box = "<div class='promo-box'>Subscribe now and join our readers</div>"
    for _ in range(30):  # the same box in every article
        one, two = filler(rng, 20), filler(rng, 20)
        page("boxes.example", f"<article><p>{one}</p>{box}<p>{two}</p></article>", f"{one} {two}")
    for k in range(120):  # six equal sections with a rail each, around an element called content
        one = filler(rng, 30)
        page("sections.example", f"<div class='content'><p>{one}</p></div><div class='rail'>Section {k % 6} of our news</div>", one)
    quote = filler(rng, 25)
    for k in range(40):  # articles that quote each other
        one = filler(rng, 20)
        cited = f"<blockquote>{quote}</blockquote>" if k % 4 == 0 else ""
        page("quotes.example", f"<article><p>{one}</p>{cited}</article>", f"{one} {quote}" if cited else one)
    for name in ("post has-comments", "post no-sidebar related-posts"):  # a name that only holds a dropped one's
        one = filler(rng, 20)
        page("names.example", f"<article class='{name}'><p>{one}</p></article>", one)
        page("names.example", f"<div class='content {name}'><p>{one}</p></div>", one)
    one = filler(rng, 9)  # an element of a dropped name that holds the article
    page("holds.example", f"<div class='widget'><article><p>{one}</p></article></div><div class='widget'>gone</div>", one)
    page("holds.example", f"<div class='comments'>gone</div><main><p>{one}</p><div class='comments'>gone</div></main>", one)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in main_text(df.repartition(5)).collect()}
    assert found == want
    twice = main_text(df.unionAll(df)).collect()  # copies turn nothing into template
    assert len(twice) == 2 * len(pages) and all(r.text == want[r.page_id] for r in twice)


def test_mixing_takes_any_column_names_and_says_what_it_cannot_meet(spark):
    rows = [(i, "words of some length " * (1 + i % 3), "ab"[i % 2], "en", 5, "mine", 0.5, True, "k") for i in range(60)]
    names = "doc_id long, text string, source string, lang string, _tokens int, _source string, _p double, _selected boolean, _keyword string"
    df = spark.createDataFrame(rows, names)
    found = mix(df)
    assert found.columns == ["doc_id", "text", "source", "lang", "_source", "_tokens", "_topic", "_p", "_selected"]
    assert {r._source for r in found.collect()} == {"mine"} and {r._tokens for r in found.collect()} == {4, 8, 12}
    # a source that has one language only cannot have another share than it
    rows = [(i, "plain words", s, lang) for i, (s, lang) in enumerate([("a", "x")] * 9 + [("b", "y")] * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    share = lambda m, **v: spark.createDataFrame(list(v.items()), f"{m} string, share double")
    shares = {"source": share("source", a=0.9, b=0.1), "lang": share("lang", x=0.5, y=0.5)}
    with pytest.raises(mixing.UnmetMargins):
        mix(df, shares=shares, strict=True)
    with pytest.warns(mixing.UnmetMargins):
        assert mix(df, shares=shares).count() == 18


def test_no_order_or_language_is_cut_away():
    sizes = [(o, lang, c, n // c ** 2) for o in range(1, 6) for lang, n in (("big", 10 ** o), ("small", 3 ** o))
             for c in range(1, 64) if n >= c ** 2]
    found = language.cutoffs(sizes, 4_000)
    kept = lambda o, lang: sum(n for a, b, c, n in sizes if (a, b) == (o, lang) and c > 0 and c >= found[o, lang])
    assert sum(kept(o, lang) for o in range(1, 6) for lang in ("big", "small")) <= 4_000
    assert all(kept(o, lang) > 0 for o in range(1, 5) for lang in ("big", "small"))
    assert max(found.values()) > 1 and found[1, "big"] == 1 and set(language.cutoffs(sizes, 10 ** 9).values()) == {1} and language.cutoffs([], 5) == {}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="given tables are absent")
def test_texts_of_a_language_that_was_not_learned_are_rejected(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    fold = language.folds()
    for out in ("de", "fr"):
        learned = documents.where(F.col("lang") != out)
        found = identify(documents, learned.where(fold > 1), learned.where(fold == 1)).where(F.length("text") > 200)
        own, other = (F.col("lang") != out), (F.col("lang") == out)
        row = found.agg(F.avg(F.when(other, F.col("rejected").cast("int"))).alias("other"),
                        F.avg(F.when(own, F.col("rejected").cast("int"))).alias("own")).first()
        assert row.other >= 0.9 and row.own <= 0.005


def test_the_model_comes_to_the_driver_one_order_at_a_time(spark, monkeypatch):
    rows = spark.createDataFrame([("the cat sat on the mat", "en"), ("el gato duerme", "es"), (None, "en"), ("x", None)], "text string, lang string")
    kind, fetched = type(rows), []
    whole = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda df: fetched.append(df.columns) or whole(df))
    model = language.fit(rows)
    assert len(fetched) == 2 * language.ORDER and not any("order" in columns for columns in fetched)
    assert model.langs == ["en", "es"] and model.entropies(["the mat", "gato"])[0].argmin(axis=1).tolist() == [0, 1]


def test_a_model_holds_every_run_it_has_seen(spark):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 1_100_000))
    model = language.fit(spark.createDataFrame([(text, "aa"), ("rare", "bb")], "text string, lang string"))
    keys = np.unique(np.concatenate([k for t in (text, "rare") for k, _ in language.windows([t], language.letter_codes())]))
    assert len(keys) > 1_000_000
    for order in range(1, language.ORDER + 1):
        assert np.array_equal(model.keys[order - 1], np.unique(keys & np.uint64((1 << language.BITS * order) - 1)))


def test_a_model_too_large_for_memory_is_mapped_and_whole(spark, labelled, monkeypatch):
    even = F.col("doc_id") % 4 < 2
    columns = ["doc_id", "lang_pred", "score", "entropy", "rejected"]

    def found():
        return sorted(map(tuple, identify(labelled, labelled.where(even), labelled.where(~even)).select(columns).collect()))

    held, held_model = found(), language.fit(labelled)
    monkeypatch.setattr(language, "HELD", 0)
    monkeypatch.setattr(language, "FETCHED", 3000)
    model = language.fit(labelled)
    assert all(isinstance(t, np.memmap) for name in language.TABLES for t in getattr(model, name))
    for name in language.TABLES:
        assert all(np.array_equal(a, b) for a, b in zip(getattr(held_model, name), getattr(model, name)))
    assert found() == held
    assert {r.lang_pred for r in identify(labelled, labelled.limit(0), labelled.limit(0)).collect()} == {"und"}
