"""Subword ids and texts: equal to the library's on odd texts, any ids, and in the registered query."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from verbamark.llm import merging
from verbamark.llm import pieces as module
from verbamark.llm.pieces import Encoder, decode, encode, read_model
from verbamark.llm.queries import op12_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return read_model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts(n, seed):
    r = random.Random(seed)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", " \t\n", "éèêçüß", "日本語中文", "𝔘😀\x00▁﻿", "<s></s><0x0A>", "ﬁ　\xa0 ", " "]
    out = []
    for _ in range(n):
        pool = "".join(r.sample(alphabets, r.choice([1, 2, 3, 8])))
        out.append("".join(r.choice(pool) for _ in range(r.choice([0, 1, 2, 5, 20, 60, 200]))))
    return out + ["a" * k for k in range(40)] + [" " * k for k in range(80)] + ["the " * 30 + "  " * k for k in range(20)]


def test_ids_and_texts_equal_the_librarys(model, library):
    texts, encoder = odd_texts(3000, 1), Encoder(model)
    for k in range(0, len(texts), 500):
        part = texts[k:k + 500]
        ids, counts = encoder(part)
        want = library.encode(part, num_threads=1)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        assert decode(model, ids, counts) == [library.decode(w) for w in want]


def test_words_finished_from_a_queue_come_out_the_same(model, library, monkeypatch):
    monkeypatch.setattr(merging, "ROUNDS", 3)
    texts, encoder = odd_texts(300, 4), Encoder(model)
    ids, counts = encoder(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library.encode(texts, num_threads=1)


def test_any_ids_decode_as_by_the_library(model, library):
    r = random.Random(2)
    texts = [[r.choice([r.randrange(32000), r.randrange(260), r.randrange(3)]) for _ in range(r.randrange(12))] for _ in range(4000)]
    found = decode(model, np.array([i for t in texts for i in t], np.int64), np.array([len(t) for t in texts]))
    assert found == [library.decode(t) for t in texts]


def test_long_words_and_forgotten_words(model, library, monkeypatch):
    monkeypatch.setattr(module, "WORDS_KEPT", 10)
    r, encoder = random.Random(3), Encoder(model)
    for text in ("".join(r.choice("abcdefghij") for _ in range(50_000)), "ab" * 40_000, " " * 200_000, "\n" * 999):
        ids, counts = encoder([text, "", text[:100]])
        assert ids.tolist() == library.encode(text) + library.encode(text[:100]) and counts[1] == 0


def test_other_models_are_refused(tmp_path):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        read_model(str(path))


def test_rows(spark, library, monkeypatch):
    monkeypatch.setattr(module, "CHARS_AT_ONCE", 50)
    texts = [None, "", "Hello  world", "Hello  world", "x" * 400, "  é\n"]
    df = spark.createDataFrame([(k % 4 or None, t, "i") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    rows = encode(df.coalesce(1), PATH).collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in rows] == [
        (k % 4 or None, library.encode(t or ""), library.decode(library.encode(t or ""))) for k, t in enumerate(texts)]
    assert encode(df.limit(0), PATH).collect() == []


def test_registered_query(spark, library):
    d = "/root/testdata/sf0.001"
    found = {r.doc_id: tuple(r)[1:] for r in op12_pieces(spark, d).collect()}
    for doc_id, text in (tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()):
        ids = library.encode(text or "")
        assert found[doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(library.decode(ids).encode()).hexdigest())
