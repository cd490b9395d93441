"""Repair of conversations whose turns are damaged: the cheapest edits that leave a well-formed exchange.

A cost DP runs backwards over a conversation's rows with four states: nothing
yet, after ``s``, after ``u``, after ``a``. The arcs that lie on cheapest paths
are then ranked by the edits they begin with, for 1, 2, 4, 8 and more edits,
two ranks of one length making the rank of the double length; the ranks select
the least path, which is read through pointers doubled in the same way.

Rows are sorted by range, so a conversation of any length is spread over
partitions. One that lies inside a partition is repaired there. Of the others,
each part gives the costs from state to state, a few numbers, and takes the
costs behind it and the state it starts in from the parts beside it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbamark.session import stage

# The edits in the order of their letters, what each costs, and white space.
EDITS = "\0DIKR"
END, DELETE, INSERT, KEEP, REROLE = range(5)
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
# The state after each role initial, by the state before; roles that an edit can give.
GOES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

STATES, FAR = 4, 1 << 40
KINDS = "sua"
MUST_GO, LAST = 0, 9
AFTER_LAST = (0, 4, 2, 0)  # what is still to be paid behind the last row
PART_ROWS, PART_CHARS, ROWS_AT_ONCE = 1 << 15, 1 << 23, 1 << 16

_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "cost")


def code_of(initial: str, blank: bool, duplicate: bool, truncated: bool) -> int:
    """All the DP needs of a row: that it must go, or its kind and whether it is truncated."""
    if blank or duplicate:
        return MUST_GO
    return 1 + 2 * (KINDS.index(initial) if initial and initial in KINDS else 3) + truncated


class Steps:
    """The DP's steps by the costs behind a row and the row's code.

    Costs of the four states differ by a few units at most, so the same steps
    come again and again, and each is worked out once.
    """

    def __init__(self) -> None:
        self.known: dict[tuple, tuple[tuple[int, ...], int, int]] = {}
        self.arcs: list[list[tuple[int, int, int, int]]] = []

    def step(self, behind: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, int]:
        """Costs before the row, less their least; that least; the number of the step's optimal arcs."""
        if (found := self.known.get((behind, code))) is None:
            found = self.known[behind, code] = self._work_out(behind, code)
        return found

    def _work_out(self, behind: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, int]:
        arcs = []  # state, edit, state after, whether in the same row, cost
        for state in range(STATES):
            if code == LAST:
                arcs += [(state, END, state, 0, 0)] if state in (0, 3) else []
            else:
                arcs.append((state, DELETE, state, 0, COST[DELETE]))
            arcs += [(state, INSERT, to, 1, COST[INSERT]) for role, to in GOES[state].items() if role in ROLES]
            if code not in (LAST, MUST_GO):
                kind, extra = (*KINDS, None)[(code - 1) // 2], (code - 1) % 2 * TRUNCATED_COST
                for role, to in GOES[state].items():
                    if role == kind:
                        arcs.append((state, KEEP, to, 0, COST[KEEP] + extra))
                    elif role in ROLES:
                        arcs.append((state, REROLE, to, 0, COST[REROLE] + extra))
        now = [min([c + behind[to] for s, _, to, same, c in arcs if s == state and not same], default=FAR)
               for state in range(STATES)]
        for _ in range(2):  # an insertion never pays more than twice in a row
            now = [min([now[state]] + [c + now[to] for s, _, to, same, c in arcs if s == state and same])
                   for state in range(STATES)]
        best = [(s, edit, to, same) for s, edit, to, same, c in arcs
                if now[s] < FAR and now[s] == c + (now[to] if same else behind[to])]
        self.arcs.append(sorted(best))
        least = min(now)
        return tuple(min(x - least, FAR) for x in now), least, len(self.arcs) - 1

    def back(self, codes: Sequence[int], behind: Sequence[int]) -> tuple[list[int], list[int]]:
        """Costs before the first of the rows, and the steps in the rows' order."""
        total = min(behind)
        now, steps = tuple(min(x - total, FAR) for x in behind), []
        for code in reversed(codes):
            now, least, number = self.step(now, code)
            total += least
            steps.append(number)
        return [min(x + total, FAR) for x in now], steps[::-1]


def _rank(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1] + 1


def least_paths(n_nodes: int, source: np.ndarray, edit: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every node the edit and the next node of its least path; a node without arcs ends a path.

    Arcs are ordered by source, and no two of a node have the same edit. Ranks
    compare the least paths that begin with an arc by their first 2**k edits.
    """
    first = np.flatnonzero(np.append(True, source[1:] != source[:-1])) if len(source) else np.zeros(0, int)
    nodes, many = source[first], np.diff(np.append(first, len(source)))
    node_rank, hop = np.zeros(n_nodes, np.int64), np.arange(n_nodes)
    rank, reach = edit.astype(np.int64) + 1, target

    def select() -> np.ndarray:
        least = np.minimum.reduceat(rank, first)
        chosen = np.flatnonzero(rank == np.repeat(least, many))
        node_rank[nodes] = least
        return chosen

    while len(source):
        chosen = select()
        hop[nodes] = reach[chosen]
        if (node_rank[reach] == 0).all():
            break
        rank = _rank(rank * (int(node_rank.max()) + 1) + node_rank[reach])
        reach = hop[reach]
    step, edits = np.arange(n_nodes), np.zeros(n_nodes, np.int64)
    if len(source):
        step[nodes], edits[nodes] = target[chosen], edit[chosen]
    return edits, step


def walk(edits: np.ndarray, step: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of the paths from ``starts``, one path after another, how many each has, and the node it ends in."""
    hops, counts = [step], [(step != np.arange(len(step))).astype(np.int64)]
    while (hops[-1][hops[-1]] != hops[-1]).any():
        counts.append(counts[-1] + counts[-1][hops[-1]])
        hops.append(hops[-1][hops[-1]])
    size = counts[-1][starts]
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    nodes = np.repeat(starts, size)
    for k, hop in enumerate(hops):
        moved = place >> k & 1 == 1
        nodes[moved] = hop[nodes[moved]]
    return nodes, size, hops[-1][starts]


class Solver:
    """Least paths of many parts of conversations at once."""

    def __init__(self) -> None:
        self.steps = Steps()

    def solve(self, parts: list[tuple[Sequence[int], Sequence[int]]], starts: list[Sequence[int]]) -> list[list[tuple]]:
        """For each part, given by its codes and the costs behind it, and each of its start states:
        the edits with the row and the state after each, and the state the part ends in."""
        layers = [self.steps.back(codes, behind)[1] for codes, behind in parts]
        sizes = np.array([len(x) for x in layers], np.int64)
        base = np.append(0, np.cumsum(STATES * (sizes + 1)))
        known = self.steps.arcs
        counts = np.array([len(a) for a in known] or [0])
        table = np.array([arc for a in known for arc in a] or [(0, 0, 0, 0)], np.int64)
        begin = np.cumsum(counts) - counts
        number = np.array([s for x in layers for s in x], np.int64)
        layer = np.concatenate([b + STATES * np.arange(n) for b, n in zip(base.tolist(), sizes.tolist())]) if len(number) else number
        each = counts[number] if len(number) else number
        at = np.repeat(begin[number] - (np.cumsum(each) - each), each) + np.arange(int(each.sum())) if len(number) else number
        state, edit, to, same = table[at].T if len(number) else (number,) * 4
        of = np.repeat(layer, each)
        edits, step = least_paths(int(base[-1]), of + state, edit, of + to + STATES * (1 - same))
        asked = np.array([b + s for b, states in zip(base.tolist(), starts) for s in states], np.int64)
        nodes, size, ends = walk(edits, step, asked)
        cuts = np.append(0, np.cumsum(size)).tolist()
        out, k = [], 0
        for b, states in zip(base.tolist(), starts):
            found = []
            for _ in states:
                path = nodes[cuts[k]:cuts[k + 1]]
                local, after = path - b, step[path] - b
                found.append((edits[path].tolist(), (local // STATES).tolist(), (after % STATES).tolist(),
                              int((ends[k] - b) % STATES)))
                k += 1
            out.append(found)
        return out


def _written(rows: list[tuple[str, str]], truncated: list[bool], path: tuple) -> tuple[str, str, int]:
    """Audit, repaired text and cost of a part by its path."""
    audit, lines, cost = [], [], 0
    for edit, row, state in zip(*path[:3]):
        if edit == END:
            continue
        audit.append(EDITS[edit])
        cost += COST[edit] + (TRUNCATED_COST if edit in (KEEP, REROLE) and truncated[row] else 0)
        if edit == INSERT:
            lines.append(ROLES["?sua"[state]] + ":")
        elif edit != DELETE:
            role, text = rows[row]
            lines.append(f"{role if edit == KEEP else ROLES['?sua'[state]]}:{text}")
    return "".join(audit), "\n".join(lines), cost


class _Part:
    """Rows of a conversation that lie together, as they are read."""

    def __init__(self, conv, place: int, opened: bool) -> None:
        self.conv, self.place, self.open = conv, place, opened
        self.rows: list[tuple[str, str]] = []
        self.codes: list[int] = []
        self.truncated: list[bool] = []
        self.chars = 0
        self.count = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None
        self.low = self.high = None

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        core, initial = text.strip(BLANKS), role[:1]
        blank = not core
        duplicate = not blank and repeated
        truncated = not blank and not duplicate and core[-1] not in STOPS
        count = self.count
        count["rows"] += 1
        count["blank"] += blank
        count["duplicate"] += duplicate
        count["truncated"] += truncated
        count["illegal"] += self.last is not None and self.last + initial not in LEGAL
        count["turns"] += turn is not None and turn != self.high
        if turn is not None:
            self.low, self.high = turn if self.low is None else self.low, turn
        self.first, self.last = initial if self.first is None else self.first, initial
        self.rows.append((role, text))
        self.codes.append(code_of(initial, blank, duplicate, truncated))
        self.truncated.append(truncated)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.rows) >= PART_ROWS or self.chars >= PART_CHARS


def _part_schema(conv: str) -> str:
    counts = ", ".join(f"`{c}` long" for c in _COUNTS)
    return (f"conv {conv}, place long, whole boolean, {counts}, first string, last string, low long, high long, "
            "audit string, repaired string, codes binary, costs array<long>, roles array<string>, texts array<string>")


_FIELDS = ("conv", "place", "whole", *_COUNTS, "first", "last", "low", "high", "audit", "repaired", "codes", "costs",
           "roles", "texts")


def _ordered(turns: DataFrame, keep: Column, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows by conversation and turn over all partitions, each with what says that its like came before."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
                        F.coalesce(keep, F.lit(False)).alias("kept"))
    rows = rows.withColumn("same", F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))))
    when = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    # only what is said more than once is joined, in digests, combined before they are shuffled
    said = (rows.where("kept").groupBy(F.col("conv").alias("in_conv"), F.col("same").alias("in_same"))
            .agg(F.min(when).alias("first_said"), F.count("*").alias("n")).where("n > 1").drop("n"))
    flagged = rows.join(said, F.col("conv").eqNullSafe(F.col("in_conv")) & (F.col("same") == F.col("in_same")), "left")
    flagged = flagged.select("conv", "turn", "role", "text", "kept", "same",
                             F.coalesce(when > F.col("first_said"), F.lit(False)).alias("later"))
    # texts are compared in full within a partition; the start of one is enough to deal rows, and keeps the bounds small
    begin = F.substring("text", 1, 32)
    return (flagged.repartitionByRange("conv", "turn", "role", begin)
            .sortWithinPartitions("conv", "turn", "role", "text"))


def _parts(rows: DataFrame) -> DataFrame:
    """One row per part of a conversation; ``whole`` ones are repaired."""
    conv_type = rows.schema["conv"].dataType.simpleString()
    schema = _part_schema(conv_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver, place = Solver(), TaskContext.get().partitionId() << 32
        types = None
        done: list[_Part] = []
        now: _Part | None = None
        before = None

        def written() -> Iterator[pa.RecordBatch]:
            whole = [p for p in done if not p.open]
            paths = solver.solve([([*p.codes, LAST], (0,) * STATES) for p in whole], [[0]] * len(whole))
            solved = {id(p): _written(p.rows, p.truncated, path[0]) for p, path in zip(whole, paths)}
            columns: dict[str, list] = {f: [] for f in _FIELDS}
            for p in done:
                audit, repaired, p.count["cost"] = solved.get(id(p), (None, None, 0))
                costs = None if not p.open else [
                    x for end in range(STATES)
                    for x in solver.steps.back(p.codes, [0 if s == end else FAR for s in range(STATES)])[0]]
                values = (p.conv, p.place, not p.open, *p.count.values(), p.first, p.last, p.low, p.high, audit, repaired,
                          bytes(p.codes) if p.open else None, costs,
                          [r for r, _ in p.rows] if p.open else None, [t for _, t in p.rows] if p.open else None)
                for f, v in zip(_FIELDS, values):
                    columns[f].append(v)
            held = {"conv": types, "place": pa.int64(), "whole": pa.bool_(), **dict.fromkeys(_COUNTS, pa.int64()),
                    "first": pa.string(), "last": pa.string(), "low": pa.int64(), "high": pa.int64(),
                    "audit": pa.string(), "repaired": pa.string(), "codes": pa.binary(), "costs": pa.list_(pa.int64()),
                    "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string())}
            yield pa.RecordBatch.from_arrays([pa.array(columns[f], held[f]) for f in _FIELDS], names=list(_FIELDS))
            done.clear()

        rows_held = chars_held = 0
        for batch in batches:
            types = batch.schema.field(0).type
            for conv, turn, role, text, kept, same, later in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv != conv:
                    # the first conversation of a partition may have begun in an earlier one
                    fresh = _Part(conv, place, now is None)
                elif now.full():
                    now.open = True
                    fresh = _Part(conv, place, True)
                else:
                    fresh = None
                if fresh is not None:
                    place += 1
                    if now is not None:
                        done.append(now)
                        rows_held, chars_held = rows_held + len(now.rows) + 1, chars_held + now.chars
                    now = fresh
                    if rows_held >= ROWS_AT_ONCE or chars_held >= PART_CHARS:
                        yield from written()
                        rows_held = chars_held = 0
                if kept:
                    now.add(turn, role, text, later or before == (conv, turn, same))
                    before = (conv, turn, same)
        if now is not None:
            now.open = True  # its conversation may go on in the next partition
            done.append(now)
            yield from written()

    return rows.mapInArrow(run, schema)


def _costs_behind(group: pd.DataFrame) -> pd.DataFrame:
    """What is to be paid behind each part of one conversation, per state; one short row per part."""
    group = group.sort_values("place")
    behind, out = list(AFTER_LAST), []
    for place, costs in zip(group["place"][::-1], group["costs"][::-1]):
        out.append((place, behind, not out))
        table = [list(map(int, costs[STATES * e:STATES * (e + 1)])) for e in range(STATES)]
        behind = [min(min(table[e][s] + behind[e] for e in range(STATES)), FAR) for s in range(STATES)]
    return pd.DataFrame(out, columns=["place", "behind", "final"])


def _states_before(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which each part of one conversation starts."""
    group = group.sort_values("place")
    state, out = 0, []
    for place, ends in zip(group["place"], group["ends"]):
        out.append((place, state))
        state = int(ends[state])
    return pd.DataFrame(out, columns=["place", "state"])


def _solved(parts: DataFrame, schema: str, one_start: bool) -> DataFrame:
    """Parts with the costs behind them: the end states from all states, or all they write from the one they start in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        for batch in batches:
            for row in batch.to_pylist():  # parts are bounded in rows and letters
                codes = list(row["codes"])
                if row["final"]:
                    given = ([*codes, LAST], (0,) * STATES)
                else:
                    given = (codes, row["behind"])
                found = solver.solve([given], [[row["state"]] if one_start else range(STATES)])[0]
                if one_start:
                    cut = [c not in (MUST_GO, LAST) and (c - 1) % 2 == 1 for c in codes]
                    audit, repaired, cost = _written(list(zip(row["roles"], row["texts"])), cut, found[0])
                    out = {"place": row["place"], "audit": audit, "repaired": repaired, "cost": cost}
                else:
                    out = {"place": row["place"], "ends": [path[3] for path in found]}
                yield pa.RecordBatch.from_pylist([out], schema=pa.schema(
                    [("place", pa.int64()), ("audit", pa.string()), ("repaired", pa.string()), ("cost", pa.int64())] if one_start
                    else [("place", pa.int64()), ("ends", pa.list_(pa.int64()))]))

    return parts.mapInArrow(run, schema)


def _joined(parts: DataFrame) -> DataFrame:
    """Parts of conversations, in order, as one row each; texts go through a checksum and are not kept."""
    conv_type = parts.schema["conv"].dataType.simpleString()
    columns = ("conv", "place", *_COUNTS, "first", "last", "low", "high", "audit", "repaired")
    out_names = ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        started, done, kind = False, [], None

        def finish() -> None:
            gaps = now["high"] - now["low"] + 1 - now["turns"] if now["low"] is not None else 0
            done.append((now["conv"], gaps, *(now[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
                         "".join(now["audit"]), now["sha"].hexdigest()))

        def rows() -> pa.RecordBatch:
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)],
                                              names=list(out_names))

        for batch in batches:
            kind = batch.schema.field(0).type
            for row in batch.to_pylist():
                if not started or now["conv"] != row["conv"]:
                    if started:
                        finish()
                    started = True
                    now = dict.fromkeys(_COUNTS, 0) | {"conv": row["conv"], "last": None, "low": None, "high": None,
                                                      "audit": [], "sha": hashlib.sha256(), "text": False}
                for c in _COUNTS:
                    now[c] += row[c]
                if row["first"] is not None:
                    now["illegal"] += now["last"] is not None and now["last"] + row["first"] not in LEGAL
                    now["last"] = row["last"]
                if row["low"] is not None:
                    now["turns"] -= row["low"] == now["high"]
                    now["low"], now["high"] = row["low"] if now["low"] is None else now["low"], row["high"]
                now["audit"].append(row["audit"])
                if row["repaired"]:
                    now["sha"].update((("\n" if now["text"] else "") + row["repaired"]).encode())
                    now["text"] = True
            if done:
                yield rows()
                done.clear()
        if started:
            finish()
            yield rows()

    schema = (f"conv {conv_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    return parts.select(*columns).repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(run, schema)


def _repaired(turns: DataFrame, keep: Column | None, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations that lie in one part, and the repaired parts of the others."""
    parts = stage(_parts(_ordered(turns, F.lit(True) if keep is None else keep, conv, turn, role, text)), "turn-parts")
    opened = parts.where("not whole")
    behind = stage(opened.select("conv", "place", "costs").groupBy("conv")
                   .applyInPandas(_costs_behind, "place long, behind array<long>, final boolean"), "turn-costs")
    asked = opened.join(behind, "place")
    ends = _solved(asked.select("place", "codes", "behind", "final"), "place long, ends array<long>", False)
    state = stage(opened.select("conv", "place").join(ends, "place").groupBy("conv")
                  .applyInPandas(_states_before, "place long, state int"), "turn-states")
    written = _solved(asked.join(state, "place").select("place", "codes", "behind", "final", "state", "roles", "texts"),
                      "place long, audit string, repaired string, cost long", True)
    columns = ["conv", "place", *_COUNTS, "first", "last", "low", "high", "audit", "repaired"]
    return (parts.where("whole").select(*columns),
            opened.drop("audit", "repaired", "cost").join(written, "place").select(*columns))


def repaired_parts(turns: DataFrame, keep: Column | None = None, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, place, audit, repaired)``: the rows that ``repair`` leaves, as lines ``role:text``, and the edits.

    A long conversation comes in several parts, ordered by ``place``.
    """
    whole, parts = _repaired(turns, keep, conv, turn, role, text)
    return whole.unionByName(parts).select(F.col("conv").alias(conv), "place", "audit", "repaired")


def repair(turns: DataFrame, keep: Column | None = None, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its faults, what the cheapest repair costs, the edits, and a checksum of the repaired rows.

    ``gaps`` counts turns missing between the least and the greatest, null
    turns aside. A row's first fault counts: ``blank``, ``duplicate`` (role and
    text came before), ``truncated`` (no full stop, question or exclamation
    mark at the end). ``illegal`` counts neighbours whose initials are not su,
    ua or au. ``audit`` holds K (keep, free), R (give another role, 2), D
    (delete, 3; a must for blank and duplicate rows) and I (insert an empty
    turn, 2), a truncated row that stays costs 1 more; of all cheapest edits
    that leave ``(s?(ua)+)?`` it is the least text. A conversation without rows
    has zeros, no edits and the checksum of the empty text, a null ``conv`` is
    a conversation, an empty table gives none. Rows for which ``keep`` is not
    true are left out, their conversations are not. Rows come by turn, nulls
    first, those of one turn by role and text; null roles and texts count as
    one space. Other columns are not read. Parts are staged.

    The audit and the checksum, which must be read from the first row to the
    last, are all that one task sees of a long conversation, part by part.
    """
    whole, parts = _repaired(turns, keep, conv, turn, role, text)
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    alone = whole.select(
        "conv", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
    return alone.unionByName(_joined(parts)).withColumnRenamed("conv", conv)
