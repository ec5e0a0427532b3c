"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is legal if its roles' initials read ``(s?(ua)+)?``. That is an
automaton of four states, so a span of rows is a 4 x 4 table of least costs, and
the cheapest edits are a path through the rows' borders. Forward and backward
vectors of four costs meet in the middle of a span; the crossing state of least
total splits the span in two, each repaired alike: memory stays linear.

Ties: a forward vector also ranks the audits of its four states. Two states at
one border have different audits, neither a prefix of the other (an audit
decides its state, and each ends in the edit of the same row), so the audit-least of
the crossings of equal cost is that of the least rank.

Conversations of at most ``MOST_ROWS`` rows and ``MOST_BYTES`` bytes are repaired
in batches of whole conversations. Longer ones are sorted over many tasks and
cut into pieces; the pieces' 4 x 4 tables run through the same recursion, which
tells each piece its first and last state, and the pieces are repaired apart.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocube.llm.common import map_arrow, parts, ship, stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: What an undeleted truncated row costs besides.
TRUNCATED_COST = 1
USER, ASSISTANT = "user", "assistant"

#: A conversation beyond either is cut into pieces of at most that many rows and about that many bytes.
MOST_ROWS = 4096
MOST_BYTES = 4 << 20
#: Rows of a batch of whole conversations.
BATCH_ROWS = 20_000
#: Characters by which rows of one turn are ordered before their digest is.
HEAD = 64

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_STATES = range(4)
_START, _SYSTEM, _USER, _ASSISTANT = _STATES
_FAR = 1 << 60
#: Where a conversation may end, and the insertions that lead there.
_TAIL = {_START: "", _ASSISTANT: "", _USER: INSERT, _SYSTEM: INSERT * 2}
_NEXT = {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER, _USER: _ASSISTANT}
_ROLE = {_USER: USER, _ASSISTANT: ASSISTANT}
_INITIALS = "sua"
_LEGAL = {"su", "ua", "au"}
_BLACK = re.compile(r"[^\x20\x09-\x0D]")

#: (costs, ranks) of the four states; costs are relative to the least.
Vector = tuple[tuple[int, ...], tuple[int, ...]]


# --- faults and edits of one row ----------------------------------------------

def is_blank(text: str) -> bool:
    return _BLACK.search(text) is None


def is_truncated(text: str) -> bool:
    """Does the last character that is not white space end no sentence?"""
    end = len(text.rstrip("\x20\x09\x0a\x0b\x0c\x0d"))
    return end > 0 and text[end - 1] not in ".!?"


def kind_of(role: str, must_go: bool, truncated: bool) -> int:
    """The class of a row: all that its edits depend on."""
    return (_INITIALS.find(role[:1]) % 4 if role else 3) * 4 + must_go * 2 + truncated


@cache
def arcs_of(kind: int) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, edits): the best way over one row, insertions before it included."""
    initial, must_go, truncated = kind >> 2, kind & 2, kind & 1
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in _STATES:
        at, inserted = before, ""
        for _ in range(3):
            ways = [(at, DELETE, COSTS[DELETE])]
            if not must_go:
                extra = TRUNCATED_COST * truncated
                goes = {0: _SYSTEM if at == _START else None, 1: _USER if at != _USER else None,
                        2: _ASSISTANT if at == _USER else None}.get(initial)
                if goes is not None:
                    ways.append((goes, KEEP, COSTS[KEEP] + extra))
                ways.append((_NEXT[at], REROLE, COSTS[REROLE] + extra))
            for after, edit, cost in ways:
                found = (cost + len(inserted) * COSTS[INSERT], inserted + edit)
                best[before, after] = min(found, best.get((before, after), (_FAR, "")))
            at, inserted = _NEXT[at], inserted + INSERT
    return tuple((s, t, cost, edits) for (s, t), (cost, edits) in sorted(best.items()))


# --- cost vectors ---------------------------------------------------------------

def _only(state: int) -> Vector:
    return tuple(0 if s == state else _FAR for s in _STATES), tuple(_STATES)


def ahead(vector: Vector, arcs: tuple) -> tuple[int, Vector]:
    """The forward vector one item on, and how much its least cost grew."""
    costs, ranks = vector
    best = [(_FAR, (4, ""))] * 4
    for s, t, cost, tie in arcs:
        if costs[s] < _FAR:
            found = (costs[s] + cost, (ranks[s], tie))
            if best[t][0] == _FAR or found < best[t]:
                best[t] = found
    least = min(c for c, _ in best)
    order = sorted((s for s in _STATES if best[s][0] < _FAR), key=lambda s: best[s][1])
    rank = [order.index(s) if s in order else 4 for s in _STATES]
    return least, (tuple(c - least if c < _FAR else _FAR for c, _ in best), tuple(rank))


def behind(costs: tuple[int, ...], arcs: tuple) -> tuple[int, ...]:
    """The backward vector one item earlier, relative to its least cost."""
    best = [_FAR] * 4
    for s, t, cost, _ in arcs:
        if costs[t] < _FAR:
            best[s] = min(best[s], cost + costs[t])
    least = min(best)
    return tuple(c - least if c < _FAR else _FAR for c in best)


@cache
def _ahead_row(vector: Vector, kind: int) -> tuple[int, Vector]:
    return ahead(vector, arcs_of(kind))


@cache
def _behind_row(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    return behind(costs, arcs_of(kind))


def borders(items: list, first: int, last: int, step: Callable, back: Callable) -> list[int]:
    """The states at the borders of ``items`` along the audit-least cheapest path from ``first`` to ``last``."""
    state = [first] * len(items) + [last]
    spans = [(0, len(items))]
    while spans:
        lo, hi = spans.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        forward, backward = _only(state[lo]), _only(state[hi])[0]
        for item in items[lo:mid]:
            forward = step(forward, item)[1]
        for item in reversed(items[mid:hi]):
            backward = back(backward, item)
        costs, ranks = forward
        state[mid] = min(_STATES, key=lambda s: (costs[s] + backward[s], ranks[s]))
        spans += [(lo, mid), (mid, hi)]
    return state


def last_state(vector: Vector) -> tuple[int, str]:
    """Where the cheapest repair ends, and the insertions after the last row."""
    costs, ranks = vector
    return min(((s, _TAIL[s]) for s in _STATES), key=lambda x: (costs[x[0]] + COSTS[INSERT] * len(x[1]), ranks[x[0]], x[1]))


def table_of(kinds: list[int]) -> list[tuple[int, int, int, int]]:
    """(state before, state after, cost, rank) over a span of rows: the arcs of a piece."""
    out = []
    for s in _STATES:
        total, vector = 0, _only(s)
        for kind in kinds:
            grown, vector = _ahead_row(vector, kind)
            total += grown
        out += [(s, t, total + vector[0][t], vector[1][t]) for t in _STATES if vector[0][t] < _FAR]
    return out


def edits_between(kinds: list[int], first: int, last: int) -> tuple[list[str], int, list[int]]:
    """Each row's edits (insertions before it first), their cost, and the states at the borders."""
    state = borders(kinds, first, last, _ahead_row, _behind_row)
    ways = [{(s, t): (cost, edits) for s, t, cost, edits in arcs_of(k)}[pair] for k, pair in zip(kinds, zip(state, state[1:]))]
    return [e for _, e in ways], sum(c for c, _ in ways), state


def applied(roles: list[str], texts: list[str], edits: list[str], first: int) -> list[tuple[str, str]]:
    """(role, text) of the repaired turns."""
    at, out = first, []
    for role, text, some in zip(roles, texts, edits):
        for edit in some:
            if edit == KEEP:
                at = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
                out.append((role, text))
            elif edit != DELETE:
                at = _NEXT[at]
                out.append((_ROLE[at], text if edit == REROLE else ""))
    return out


def illegal_pairs(roles: list[str]) -> int:
    return sum((a[:1] + b[:1]) not in _LEGAL for a, b in zip(roles, roles[1:]))


def _piece(conv, piece: int, turns: list, roles: list[str], texts: list[str], faults: list[int], edits: list[str],
           first: int, cost: int, tail: str = "") -> dict:
    """One output row; ``faults`` are 1 blank, 2 duplicate, 3 truncated."""
    said = applied([*roles, ""], [*texts, ""], [*edits, tail], first)
    known = [t for t in turns if t is not None]
    return {"conv_id": conv, "piece": piece, "audit": "".join(edits) + tail, "repaired": "\n".join(f"{r}:{t}" for r, t in said),
            "n_rows": len(roles), "n_repaired": len(said), **{n: sum(f == k for f in faults) for k, n in ((1, "blank"), (2, "duplicate"), (3, "truncated"))},
            "illegal": illegal_pairs(roles), "cost": cost + COSTS[INSERT] * len(tail),
            "min_turn": min(known, default=None), "max_turn": max(known, default=None), "n_turns": len(set(known))}


_PIECES = ("conv_id long, piece long, audit string, repaired string, n_rows long, n_repaired long, blank long, duplicate long, "
           "truncated long, illegal long, cost long, min_turn long, max_turn long, n_turns long")
_ARROW = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _PIECES.split(", ")])


# --- whole conversations ----------------------------------------------------------

def _digest(role: str, text: str) -> str:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).hexdigest()


def _whole(table: pa.Table) -> pa.Table:
    """A batch of whole conversations -> their pieces, one each."""
    rows = zip(*(table[c].to_pylist() for c in ("conv_id", "turn", "role", "text")))
    by_conv: dict = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn, role[:HEAD], text[:HEAD], _digest(role, text), role, text))
    out = []
    for conv, held in by_conv.items():
        held.sort(key=lambda r: (r[0], r[1] or 0, r[2:]))
        roles, texts = [r[5] for r in held], [r[6] for r in held]
        seen, faults = set(), []
        for role, text in zip(roles, texts):
            faults.append(1 if is_blank(text) else 2 if (role, text) in seen else 3 * is_truncated(text))
            seen.add((role, text))
        kinds = [kind_of(r, f in (1, 2), f == 3) for r, f in zip(roles, faults)]
        vector = _only(_START)
        for kind in kinds:
            vector = _ahead_row(vector, kind)[1]
        last, tail = last_state(vector)
        edits, cost, _ = edits_between(kinds, _START, last)
        out.append(_piece(conv, 0, [r[1] for r in held], roles, texts, faults, edits, _START, cost, tail))
    return pa.Table.from_pylist(out, _ARROW)


# --- conversations in pieces --------------------------------------------------------

_SORT = ["key", "turn", "role_head", "text_head", "digest", "salt"]


def _cut(rows: DataFrame, n_bytes: int) -> DataFrame:
    """Rows in order over many tasks, with ``piece``, the place ``at`` in it, and their own faults."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, at, size, last = (TaskContext.get().partitionId() << 33) - 1, 0, 0, None
        for b in batches:
            pieces, ats, faults = [], [], []
            for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                if key != last or at >= MOST_ROWS or size > MOST_BYTES // 4:
                    piece, at, size, last = piece + 1, 0, 0, key
                pieces.append(piece)
                ats.append(at)
                faults.append(1 if is_blank(text) else 3 * is_truncated(text))
                at, size = at + 1, size + len(text)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(pieces, pa.int64()), pa.array(ats, pa.int64()), pa.array(faults, pa.int64())],
                names=[*b.schema.names, "piece", "at", "fault"])

    head = F.concat(F.char_length("role"), F.lit(":"), "role", "text")
    keyed = rows.select("*", F.substring("role", 1, HEAD).alias("role_head"), F.substring("text", 1, HEAD).alias("text_head"),
                        F.sha2(head, 256).alias("digest"), F.monotonically_increasing_id().alias("salt"))
    ordered = keyed.repartitionByRange(parts(n_bytes, 4 * MOST_BYTES), *_SORT).sortWithinPartitions(*_SORT)
    return stored(map_arrow(ordered, run, f"{_ddl(keyed)}, piece long, at long, fault long"), "cut-turns")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _summary(rows: pd.DataFrame) -> pd.DataFrame:
    """One piece -> its table of costs and what its neighbours need to know."""
    rows = rows.sort_values("at")
    kinds = [kind_of(r, f in (1, 2), f == 3) for r, f in zip(rows["role_head"], rows["fault"])]
    table = table_of(kinds)
    turns = [None if pd.isna(t) else int(t) for t in rows["turn"]]
    return pd.DataFrame([{"key": rows["key"].iloc[0], "piece": rows["piece"].iloc[0], "arcs": [list(a) for a in table],
                          "head": rows["role_head"].iloc[0][:1], "last": rows["role_head"].iloc[-1][:1],
                          "first_turn": turns[0], "last_turn": turns[-1]}])


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one conversation -> the states at their borders (one narrow row a piece)."""
    rows = rows.sort_values("piece").reset_index(drop=True)
    items = [tuple(tuple(int(x) for x in a) for a in arcs) for arcs in rows["arcs"]]
    vector = _only(_START)
    for arcs in items:
        vector = ahead(vector, arcs)[1]
    last, tail = last_state(vector)
    state = borders(items, _START, last, ahead, behind)
    joins = [(a + b) not in _LEGAL for a, b in zip(rows["last"], rows["head"][1:])]
    same = [pd.notna(a) and pd.notna(b) and int(a) == int(b) for a, b in zip(rows["last_turn"], rows["first_turn"][1:])]
    return pd.DataFrame({"key": rows["key"], "piece": rows["piece"], "first": state[:-1], "then": state[1:],
                         "tail": [""] * (len(items) - 1) + [tail], "joint": [0, *map(int, joins)], "shared": [0, *map(int, same)]})


def _mend(table: pa.Table) -> pa.Table:
    """One piece, with its first and last state -> its output row."""
    held = sorted(table.to_pylist(), key=lambda r: r["at"])
    top = held[0]
    roles, texts, faults = ([r[c] for r in held] for c in ("role", "text", "fault"))
    kinds = [kind_of(r, f in (1, 2), f == 3) for r, f in zip(roles, faults)]
    edits, cost, _ = edits_between(kinds, top["first"], top["then"])
    out = _piece(top["conv_id"], top["piece"], [r["turn"] for r in held], roles, texts, faults, edits, top["first"], cost, top["tail"])
    out["illegal"] += top["joint"]
    out["n_turns"] -= top["shared"]
    return pa.Table.from_pylist([out], _ARROW)


def _in_pieces(rows: DataFrame, n_bytes: int) -> DataFrame:
    cut = _cut(rows, n_bytes)
    place = F.struct("piece", "at")
    # A common text of one conversation is one row here; its rows are split by AQE if they are many.
    first = cut.groupBy("key", "digest").agg(F.min(place).alias("seen"), F.count("*").alias("n")).where("n > 1").drop("n")
    fault = F.when((F.col("fault") != 1) & (F.col("seen") < place), 2).otherwise(F.col("fault")).cast("long")
    marked = stored(cut.join(first, ["key", "digest"], "left").withColumn("fault", fault)
                    .select("conv_id", "key", "piece", "at", "turn", "role", "text", "role_head", "fault"), "marked-turns")
    narrow = marked.select("key", "piece", "at", "turn", "role_head", "fault")
    pieces = narrow.groupBy("key", "piece").applyInPandas(
        _summary, "key string, piece long, arcs array<array<long>>, head string, last string, first_turn long, last_turn long")
    states = stored(pieces.groupBy("key").applyInPandas(
        _scan, "key string, piece long, first long, then long, tail string, joint long, shared long"), "piece-states")
    return marked.join(states, ["key", "piece"]).groupBy("key", "piece").applyInArrow(_mend, _PIECES)


def repair(conversations: DataFrame) -> DataFrame:
    """Repaired conversations, a row for each piece: conv_id, piece, audit, repaired, n_rows, n_repaired, blank, duplicate,
    truncated, illegal, cost, min_turn, max_turn, n_turns, whole.

    ``audit`` holds the initials of the edits in order (Keep, Rerole, Delete, Insert), ``repaired`` the
    repaired turns as ``role:text`` joined by newlines. ``whole`` tells that the piece is all of its
    conversation; others follow each other by ``piece``, and ``illegal`` and ``n_turns`` add up over them.

    - null role or text: one space (no legal role; blank); null turn: before all others; null conv_id: one conversation;
    - equal turns: by the first 64 characters of the role, then of the text, then by the SHA-256 of both;
    - repeated rows: all but the first are duplicates; a repeated blank row is blank;
    - a role counts by its first character; Rerole goes to user or assistant; an empty role has none;
    - very long texts: whole, one piece each at most; very long conversations: in pieces;
    - empty table: empty result; other columns are not looked at.
    """
    ship(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    size = F.sum(F.octet_length("text").cast("long") + F.octet_length("role") + 16)
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), size.alias("size"))
    large = (F.col("n") > MOST_ROWS) | (F.col("size") > MOST_BYTES)
    totals = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0)),
                       F.coalesce(F.sum(F.when(large, F.col("size"))), F.lit(0))).first()
    small = rows
    if totals[2]:
        long_ones = stored(sizes.where(large).select("key"), "long-conversations")
        small = rows.join(long_ones, "key", "left_anti")
    batches = parts(max(totals[0] // BATCH_ROWS, totals[1] // MOST_BYTES), 1)
    whole = (small.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches))).groupBy("batch")
             .applyInArrow(_whole, _PIECES).withColumn("whole", F.lit(True)))
    if not totals[2]:
        return whole
    return whole.union(_in_pieces(rows.join(long_ones, "key", "left_semi"), totals[2]).withColumn("whole", F.lit(False)))


_SUMS = ("blank", "duplicate", "truncated", "illegal", "cost", "n_turns")
_AUDITED = ("conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, n_turns long, "
            "min_turn long, max_turn long, audit string, repaired_sha256 string")
_AUDITED_ARROW = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _AUDITED.split(", ")])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> one row per conversation; texts pass through the digest one piece at a time."""
    held: dict | None = None

    def done() -> pa.RecordBatch:
        out = {**held, "audit": "".join(held["audit"]), "repaired_sha256": held["repaired_sha256"].hexdigest()}
        return pa.RecordBatch.from_pylist([out], _AUDITED_ARROW)

    for b in batches:
        for i in range(b.num_rows):
            r = {n: b.column(n)[i].as_py() for n in b.schema.names}
            if held is None or held["conv_id"] != r["conv_id"]:
                if held is not None:
                    yield done()
                held = {**dict.fromkeys(_SUMS, 0), "conv_id": r["conv_id"], "audit": [], "repaired_sha256": hashlib.sha256(),
                        "min_turn": None, "max_turn": None}
                begun = False
            if r["n_repaired"]:
                held["repaired_sha256"].update((("\n" if begun else "") + r["repaired"]).encode("utf-8", "surrogatepass"))
                begun = True
            held["audit"].append(r["audit"])
            for n in _SUMS:
                held[n] += r[n]
            for n, pick in (("min_turn", min), ("max_turn", max)):
                held[n] = pick((x for x in (held[n], r[n]) if x is not None), default=None)
    if held is not None:
        yield done()


def conversation_audits(pieces: DataFrame) -> DataFrame:
    """One row per repaired conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``gaps`` is max turn - min turn + 1 - different turns (nulls aside; 0 without any; at most the largest long).
    A conversation in pieces is digested by one task, a piece at a time, since the digest is one running sum;
    its audit is one string of a character per edit, so a conversation of over 2**31 edits fails.
    """
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    gaps = F.least(F.coalesce(exact("max_turn") - exact("min_turn") + 1 - F.col("n_turns"), F.lit(0)),
                   F.lit((1 << 63) - 1).cast("decimal(20,0)")).cast("long").alias("gaps")
    one = pieces.where("whole").withColumn("repaired_sha256", F.sha2("repaired", 256))
    columns = ["conv_id", gaps, *counts, "audit", "repaired_sha256"]
    many = pieces.where("not whole").select("conv_id", "piece", "audit", "repaired", "n_repaired", *counts, "min_turn", "max_turn", "n_turns")
    streamed = map_arrow(many.repartition("conv_id").sortWithinPartitions("conv_id", "piece"), _streamed, _AUDITED)
    return one.select(*columns).union(streamed.select(*columns))
