"""Subword encoding and decoding with a byte-pair model of the sentencepiece library, by vectorised merge rounds.

All new words of a batch are merged at once (``merging``). Words are cut where
no piece of the vocabulary spans the two characters, so no merge is lost, and
each is encoded once.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.llm.merging import Merger, sooner_of
from verbamark.llm.sharing import share

SPACE = "▁"
WORDS_KEPT = 300_000
CHARS_AT_ONCE = 1 << 20
# Piece types of the model format, and what an unknown id is shown as.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_TEXT = " ⁇ "

codecs.register_error("each byte", lambda e: ("�" * (e.end - e.start), e.end))


def read_model(path: str) -> dict[str, np.ndarray]:
    """The merge table and the pieces of a model file, as arrays.

    Takes byte-pair models with byte fallback and the identity normaliser;
    anything else is refused, as it would be encoded otherwise than by the
    library.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    training, normal = model.trainer_spec, model.normalizer_spec
    kinds = np.array([p.type for p in model.pieces])
    if (training.model_type != training.BPE or not training.byte_fallback or training.treat_whitespace_as_suffix
            or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces
            or not normal.add_dummy_prefix or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}):
        raise ValueError("only byte-pair models with byte fallback and the identity normaliser are read")
    texts = [p.piece for p in model.pieces]
    scores = np.array([p.score for p in model.pieces])
    symbols = {t: i for i, t in enumerate(texts) if kinds[i] == NORMAL}
    pieces = dict(symbols)
    for c in sorted({c for t in pieces for c in t} - set(symbols)):
        symbols[c] = len(texts) + len(symbols) - len(pieces)  # a letter of pieces that is none itself
    rank = np.zeros(len(texts), np.int32)
    rank[list(pieces.values())] = np.unique(-scores[list(pieces.values())], return_inverse=True)[1]
    size = max(symbols.values()) + 1
    pairs = sorted((symbols[t[:k]] * size + symbols[t[k:]], i) for t, i in pieces.items()
                   for k in range(1, len(t)) if t[:k] in symbols and t[k:] in symbols)
    keys, merged = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    letters = sorted({c for t in pieces for c in t})
    at = {c: k + 1 for k, c in enumerate(letters)}
    spans = np.unique(np.array([at[a] * (len(letters) + 1) + at[b] for t in pieces for a, b in zip(t, t[1:])], np.int64))
    shown = [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else UNKNOWN_TEXT.encode() if k == UNKNOWN
             else t.replace(SPACE, " ").encode() for t, k in zip(texts, kinds)]
    byte_ids = np.zeros(256, np.int32)
    byte_ids[[int(texts[i][3:5], 16) for i in np.flatnonzero(kinds == BYTE)]] = np.flatnonzero(kinds == BYTE)
    return {
        "size": np.int64(size), "n": np.int64(len(texts)), "keys": keys, "made": merged.astype(np.int32),
        "rank": rank[merged], "sooner": sooner_of(size, keys, rank[merged], merged), "letters": np.array([ord(c) for c in letters], np.uint32),
        "letter_symbol": np.array([symbols[c] for c in letters], np.int32), "spans": spans, "byte_ids": byte_ids,
        "shown": np.frombuffer(b"".join(shown), np.uint8), "shown_size": np.array([len(s) for s in shown], np.int64),
        "kinds": kinds, "spaced": np.array([k == NORMAL and t.startswith(SPACE) for t, k in zip(texts, kinds)]),
    }


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places ``start[k] .. start[k] + size[k] - 1`` of all k, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Encoder:
    """Ids of texts; words seen before are looked up."""

    def __init__(self, model: dict[str, np.ndarray]) -> None:
        self.m = model
        n = len(model["letters"]) + 1
        self.span = np.zeros(n * n, bool)
        self.span[model["spans"]] = True
        self.letter_at = np.zeros(0x110000, np.int32)
        self.letter_at[model["letters"]] = np.arange(1, n)
        self.merger = Merger(int(model["size"]), *(model[k] for k in ("keys", "rank", "made", "sooner")))
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        letter = self.letter_at[flat]
        # a letter in no piece is numbered beyond all symbols, by its code point
        symbols = np.where(letter > 0, self.m["letter_symbol"][letter - 1], -1 - flat.astype(np.int64)).astype(np.int32)
        whole = np.bincount(word, letter == 0, len(words))[word] > 0
        out, of = self.merger.merge(symbols[~whole], word[~whole].astype(np.int32))
        out, of = np.append(out, symbols[whole]), np.append(of, word[whole])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
        codes = np.where(out < 0, -1 - out, 0).astype(np.uint32)
        beyond = out >= self.m["n"]
        codes[beyond] = self._letter_codes(out[beyond])
        spelt = np.flatnonzero((out < 0) | beyond)
        if len(spelt):  # letters without a piece become the pieces of their bytes
            spelling = [chr(c).encode() for c in codes[spelt].tolist()]
            times = np.ones(len(out), np.int64)
            times[spelt] = [len(s) for s in spelling]
            ids = np.repeat(out, times)
            ids[np.repeat((out < 0) | beyond, times)] = self.m["byte_ids"][np.frombuffer(b"".join(spelling), np.uint8)]
            out, of = ids, np.repeat(of, times)
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.ids = np.append(self.ids, out.astype(np.int32))
        self.size = np.append(self.size, np.bincount(of, minlength=len(words)).astype(np.int64))

    def _letter_codes(self, symbols: np.ndarray) -> np.ndarray:
        order = np.argsort(self.m["letter_symbol"])
        return self.m["letters"][order[np.searchsorted(self.m["letter_symbol"], symbols, sorter=order)]]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        whole = "".join(marked)
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ends = np.cumsum([len(t) for t in marked])
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        letter = self.letter_at[code].astype(np.int64)
        cut = np.append(~self.span[letter[:-1] * (len(self.m["letters"]) + 1) + letter[1:]], True)
        cut[ends[ends > 0] - 1] = True
        bounds = np.append(0, np.flatnonzero(cut) + 1)
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        offsets = np.append(0, np.cumsum(width))[bounds]
        words = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets), pa.py_buffer(whole.encode())).dictionary_encode()
        different = words.dictionary.to_pylist()
        if len(self.place) > WORDS_KEPT:
            self._forget()
        if new := [w for w in different if w not in self.place]:
            self._learn(new)
        known = np.array([self.place[w] for w in different], np.int64)[np.asarray(words.indices)]
        sizes = self.size[known]
        starts = (np.cumsum(self.size) - self.size)[known]
        per_text = np.add.reduceat(np.append(sizes, 0), np.minimum(np.searchsorted(bounds, np.append(0, ends[:-1])), len(sizes)))
        per_text[[not t for t in marked]] = 0
        return self.ids[_runs(starts, sizes)], per_text


def decode(model: dict[str, np.ndarray], ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of id sequences that lie one after another; a space before the first piece is the encoder's and goes.

    Ids of control pieces show nothing, runs of byte pieces that are no valid
    UTF-8 a replacement character for each byte.
    """
    size, kinds = model["shown_size"], model["kinds"]
    begin = np.cumsum(size) - size
    start, length = begin[ids], size[ids]
    # the first id of each text that is no control piece
    ends = np.cumsum(counts)
    texts = np.repeat(np.arange(len(counts)), counts)
    seen = np.flatnonzero(kinds[ids] != CONTROL)
    first = seen[np.append(True, texts[seen][1:] != texts[seen][:-1])] if len(seen) else seen
    led = first[model["spaced"][ids[first]]]
    start[led] += 1
    length[led] -= 1
    shown = model["shown"][_runs(start, length)].tobytes()
    reached = np.append(0, np.cumsum(length))
    # a control piece ends a run of byte pieces, so what lies on its two sides is read apart
    part_ends = np.union1d(ends, np.flatnonzero(kinds[ids] == CONTROL))
    at = reached[np.append(0, part_ends)].tolist()
    parts = [shown[i:j].decode("utf-8", "each byte") for i, j in zip(at, at[1:])]
    last = np.searchsorted(part_ends, ends, side="right")
    first = np.append(0, last[:-1])
    return ["".join(parts[i:j]) if j - i != 1 else parts[i] for i, j in zip(first.tolist(), last.tolist())]


def encode(documents: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids, decoded)``: the ids of each whole text and the text these stand for.

    ``model`` is the path of a model file, read on the driver; its tables,
    bounded by the vocabulary, are broadcast. A null or empty text has no ids
    and decodes to an empty text. One row per row of ``documents``, repeated
    rows and null keys included; an empty table gives none. Other columns are
    not read, whatever they are called. Texts are taken in parts of
    ``CHARS_AT_ONCE`` letters, a longer one alone; nothing is shuffled.
    """
    shared = share(documents, read_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared()
        encoder = Encoder(tables)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            bounds = np.cumsum([len(t) for t in texts]) // CHARS_AT_ONCE
            cuts = (np.flatnonzero(np.diff(bounds, append=-1)) + 1).tolist()
            for i, j in zip([0, *cuts], cuts):
                ids, counts = encoder(texts[i:j])
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                     pa.array(decode(tables, ids, counts), pa.string())], names=["key", "ids", "decoded"])

    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)
