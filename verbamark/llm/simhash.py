"""Near-copies of texts: 64-bit SimHash, matched by anchor points of a covering code.

Each half of a fingerprint is a word of 32 bits. The anchors are the words of
a Hamming code on 31 bits with the last bit free; every word is within
``RADIUS`` = 1 of one. Two fingerprints that differ in at most ``t`` bits
differ in at most ``t // 2`` bits of one half, so some word lies within
``ceil(t // 2 / 2)`` of both halves, and the anchor that covers it lies within
the covering radius plus that share of the threshold of both. Each fingerprint
is therefore sent to all anchors within that distance of its halves, about 34
of 2**28 for ``t = 4``, and compared only with what meets it there. Nothing
within the threshold is missed, and nothing beyond it is linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.llm.components import connected_components
from verbamark.session import stage

SEED = 42
RADIUS = 1
AT_ONCE = 1 << 15
HOT_ANCHOR = 20_000
SMALL_RUN = 8


def fingerprint(text: bytes, width: int, seed: int = SEED) -> int:
    """SimHash of the ``width``-word shingles of a UTF-8 text, as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], seed) for i, j in zip(starts, ends[width - 1:].tolist())),
                         np.uint64, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), AT_ONCE):
        part = hashes[k:k + AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, width: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per row; a null text counts as empty, whose fingerprint is 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _patterns(reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome, the bit flips of at most ``reach`` bits that lead to an anchor, and how many there are."""
    found: list[list[int]] = [[] for _ in range(32)]
    for weight in range(reach + 1):
        for bits in combinations(range(32), weight):
            syndrome = mask = 0
            for bit in bits:
                syndrome ^= (bit + 1) % 32  # positions 1..31; the last bit is free
                mask |= 1 << bit
            found[syndrome].append(mask)
    table = np.zeros((32, max(map(len, found))), np.uint64)
    for s, masks in enumerate(found):
        table[s, :len(masks)] = masks
    return table, np.array([len(m) for m in found])


def _anchors(words: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors within ``reach`` of each 32-bit word, as (row, anchor)."""
    table, sizes = _patterns(reach)
    syndrome = np.zeros(len(words), np.int64)
    for j in range(5):
        mask = np.uint64(sum(1 << bit for bit in range(31) if (bit + 1) >> j & 1))
        syndrome |= (np.bitwise_count(words & mask) & 1).astype(np.int64) << j
    row, k = np.nonzero(np.arange(table.shape[1]) < sizes[syndrome][:, None])
    return row, words[row] ^ table[syndrome[row], k]


def anchored(nodes: DataFrame, threshold: int) -> DataFrame:
    """``(anchor, node, fp)``: each fingerprint once per anchor in reach of one of its halves."""
    reach = RADIUS + -(-(threshold // 2) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, AT_ONCE) for k in range(0, batch.num_rows, AT_ONCE)):
                node, fp = (np.asarray(part.column(i)) for i in (0, 1))
                bits = fp.view(np.uint64)
                for half in (0, 1):
                    words = bits >> np.uint64(32) if half else bits & np.uint64(0xFFFFFFFF)
                    row, anchor = _anchors(words, reach)
                    key = anchor | np.uint64(half << 32)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node[row]),
                                                      pa.array(fp[row])], ["anchor", "node", "fp"])

    return nodes.select("node", "fp").mapInArrow(run, "anchor long, node long, fp long")


def _forest(node: np.ndarray, bits: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, int]]:
    """Per group of linked fingerprints that meet at one anchor, its other members and its smallest node."""
    order = np.argsort(node, kind="stable")
    node, bits = node[order], bits[order]
    left = np.arange(len(node))
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier, members = [root], []
        while frontier and len(left):
            near = np.bitwise_count(bits[left] ^ bits[frontier.pop()]) <= threshold
            if near.any():
                members.append(left[near])
                frontier.extend(left[near].tolist())
                left = left[~near]
        if members:
            yield node[np.concatenate(members)], node[root]


def _links(key: np.ndarray, node: np.ndarray, bits: np.ndarray, threshold: int) -> Iterator[tuple]:
    """Spanning links of whole runs of equal keys: short runs all at once, long ones one by one."""
    edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1), [True]]))
    size = np.diff(edge)
    run_of = np.repeat(np.arange(len(size)), size)
    short = np.flatnonzero(((size > 1) & (size <= SMALL_RUN))[run_of])
    run, short_node, short_bits = run_of[short], node[short], bits[short]
    for gap in range(1, SMALL_RUN):
        i = np.flatnonzero((run[gap:] == run[:-gap])
                           & (np.bitwise_count(short_bits[gap:] ^ short_bits[:-gap]) <= threshold))
        if len(i):
            yield short_node[i], short_node[i + gap]
    for r in np.flatnonzero(size > SMALL_RUN):
        part = slice(edge[r], edge[r + 1])
        for members, root in _forest(node[part], bits[part], threshold):
            yield members, np.full(len(members), root)


def links(nodes: DataFrame, threshold: int = 4) -> DataFrame:
    """Spanning links ``(a, b)`` between nodes whose fingerprints differ in at most ``threshold`` bits.

    ``nodes`` holds one row per distinct fingerprint. An anchor that more than
    ``HOT_ANCHOR`` fingerprints reach is cut into blocks, and each pair of
    blocks is compared in a task of its own; all pairs are still compared, and
    each task returns no more links than it has members.
    """
    rows = anchored(nodes, threshold)
    hot = stage(rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ANCHOR), "hot-anchors")
    blocks = F.ceil(F.col("n") / HOT_ANCHOR).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    cells = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                    lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j)))
    rows = (rows.join(hot.select("anchor", blocks.alias("blocks")), "anchor", "left")
            .select("anchor", F.explode(cells).alias("cell"), "node", "fp")
            .repartition("anchor", "cell").sortWithinPartitions("anchor", "cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty((0, 2), np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]

        def out(upto: int) -> Iterator[pa.RecordBatch]:
            for a, b in _links(kept[0][:upto], kept[1][:upto], kept[2][:upto], threshold):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            anchor, cell, node, fp = (np.asarray(batch.column(i)) for i in range(4))
            kept = [np.concatenate(x) for x in zip(kept, [np.stack([anchor, cell], 1), node, fp.view(np.uint64)])]
            last = np.flatnonzero((kept[0] != kept[0][-1]).any(axis=1))[-1:] + 1  # the last run may go on
            if len(last):
                yield from out(last[0])
                kept = [x[last[0]:] for x in kept]
        if len(kept[1]):
            yield from out(len(kept[1]))

    return rows.mapInArrow(run, "a long, b long")


def simhash_components(documents: DataFrame, width: int = 5, threshold: int = 4, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``documents``.

    Letters A-Z are lower-cased, words are runs without ASCII white space, a
    text of fewer words than ``width`` is one shingle. A component is what
    links of at most ``threshold`` differing bits connect; its id is its
    smallest ``doc_id``. Null and empty texts have fingerprint 0 and link like
    any other. Repeated rows and equal texts share a component, each row
    staying a row. Rows without a ``doc_id`` get the component of the rows that
    share their fingerprint, or null if none of those has an id. Other columns
    are not read. Equal fingerprints are one node, so copies cost one row each.
    """
    prints = stage(fingerprints(documents, width, doc_id, text), "fingerprints")
    nodes = stage(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    found = connected_components(links(nodes, threshold))
    classes = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def keep_first(documents: DataFrame, **options) -> DataFrame:
    """One document of each component, that of the smallest ``doc_id``, with all its columns.

    Repeated rows of that id count as one document, of which one row stays;
    rows without an id go, as nothing can name them.
    """
    doc_id = options.get("doc_id", "doc_id")
    kept = (simhash_components(documents, **options).where("doc_id = component_id")
            .select(F.col("doc_id").alias(doc_id)).distinct())
    return documents.join(kept, doc_id, "left_semi").dropDuplicates([doc_id])
