"""Document fingerprints: a randomised edit embedding, sampled, banded and verified.

A shared random walk reads a text: step j emits the character under the
head, and a random bit fixed by j and that character says whether the head
moves on. Texts at a small edit distance fall back into step after each edit,
so their emitted strings are at a small Hamming distance. The fingerprint
keeps the emitted characters of shared, ever sparser steps (steps j with a
gap of about j / ``DENSITY``), one hex digit each, up to the step at which the
text ends. The likeness of two fingerprints is the share of the steps, each
sample standing for its gap, on which they agree.

Walks of many texts run side by side, the longest first; a text that has ended
leaves. The whole text is read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocube.llm.common import dropped, map_arrow, parts, ship, stored
from regiocube.llm.components import components
from regiocube.llm.substring import BATCH_BYTES, _batch

SEED = 20240601
DENSITY = 64
#: Steps after which the random bits repeat.
_PERIOD = 4096
#: Texts of which each walks on its own rather than all in arrays.
_FEW = 32
#: Characters walked over at once.
_SLICE = 4 << 20

_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
_NONE = 255


class _Walk:
    """The shared randomness: moves by step and character class, and hex digits of samples."""

    moves: np.ndarray | None = None
    rows: list[bytes]  # the moves of each step, twice over
    digits: np.ndarray

    @classmethod
    def get(cls) -> type["_Walk"]:
        if cls.moves is None:
            rng = np.random.default_rng(SEED)
            cls.moves = rng.integers(0, 2, (_PERIOD, 256), dtype=np.uint8)
            cls.moves[:, 0] = 0  # class 0 is the end of a text
            cls.rows = [row.tobytes() for row in cls.moves] * 2
            cls.digits = rng.integers(0, 16, (_PERIOD, 256), dtype=np.uint8)
            cls.digits[:, 0] = _NONE
        return cls


def sample_steps(most: int) -> np.ndarray:
    """The sampled steps below ``most``: every one at first, then ever sparser."""
    out, j = [], 0
    while j < most:
        out.append(j)
        j += max(1, j // DENSITY)
    return np.array(out, np.int64)


def _classes(text: str) -> np.ndarray:
    """One byte per code point, never 0: ASCII as it is, the rest folded."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cp < 128, cp + 1, 129 + cp % 127).astype(np.uint8)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text: one hex digit per sampled step until the text ends."""
    walk = _Walk.get()
    out = [""] * len(texts)
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    at = 0
    while at < len(order):
        end, held = at, 0
        while end < len(order) and (end == at or held + len(texts[order[end]]) <= _SLICE):
            held += len(texts[order[end]])
            end += 1
        for i, digits in zip(order[at:end], _walk([texts[i] for i in order[at:end]], walk)):
            out[i] = _HEX[digits].tobytes().decode()
        at = end
    return out


def _walk(texts: list[str], walk: type[_Walk]) -> list[np.ndarray]:
    sizes = np.array([len(t) + 1 for t in texts])
    tape = np.zeros(int(sizes.sum()), np.uint8)
    head = np.cumsum(np.r_[0, sizes])[:-1].astype(np.int64)
    for t, a in zip(texts, head.tolist()):
        tape[a:a + len(t)] = _classes(t)
    raw = tape.tobytes()
    lanes = np.arange(len(texts))
    rows: list[tuple[np.ndarray, np.ndarray]] = []  # (lanes, digits) of each sample
    j = 0
    while len(lanes):
        rows.append((lanes, walk.digits[j % _PERIOD].take(tape.take(head))))
        gap = max(1, j // DENSITY)
        head = _steps(tape, raw, head, j, gap, walk)
        j += gap
        going = tape.take(head) != 0
        if not going.all():
            lanes, head = lanes[going], head[going]
    table = np.full((len(texts), len(rows)), _NONE, np.uint8)
    for s, (some, values) in enumerate(rows):
        table[some, s] = values
    lengths = (table != _NONE).sum(axis=1)
    return [row[:n] for row, n in zip(table, lengths.tolist())]


def _steps(tape: np.ndarray, raw: bytes, head: np.ndarray, j: int, n: int, walk: type[_Walk]) -> np.ndarray:
    """The heads after the ``n`` steps from step ``j``; a head at the end of its text stays there."""
    if len(head) > _FEW:
        head = head.copy()
        for k in range(j, j + n):
            head += walk.moves[k % _PERIOD].take(tape.take(head))
        return head
    # Few lanes: a step of each costs less than the array calls of one step.
    out = head.tolist()
    for start in range(j, j + n, _PERIOD):
        k = start % _PERIOD
        some = walk.rows[k:k + min(_PERIOD, j + n - start)]
        for i, h in enumerate(out):
            for row in some:
                h += row[raw[h]]
            out[i] = h
    return np.array(out, np.int64)


def likeness(a: str, b: str) -> float:
    """Share of the steps of the longer fingerprint on which both agree, by samples and their gaps."""
    if not a and not b:
        return 1.0
    n = max(len(a), len(b))
    gaps = _gaps(n)
    m = min(len(a), len(b))
    same = np.frombuffer(a.encode(), np.uint8)[:m] == np.frombuffer(b.encode(), np.uint8)[:m]
    return float(gaps[:m][same].sum() / gaps.sum())


_GAPS = np.ones(1)


def _gaps(n: int) -> np.ndarray:
    """The gap that each of the first ``n`` samples stands for."""
    global _GAPS
    if len(_GAPS) < n:
        gaps, j = [], 0
        for _ in range(2 * n):
            gaps.append(max(1, j // DENSITY))
            j += gaps[-1]
        _GAPS = np.array(gaps, np.float64)
    return _GAPS[:n]


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row's whole text; see ``compare_edited`` for the cases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(fingerprints(texts), pa.string())],
                names=["doc_id", "n_chars", "fingerprint"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(own, run, "doc_id long, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _point(text: str) -> int:
    """The number of a text (60 bits of its SHA-256); ``_points`` is the same in SQL."""
    return int(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()[:15], 16)


def _points(text: Column) -> Column:
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _compare(rows: pa.Table) -> pa.Table:
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("tail", "ascending"), ("doc_id", "ascending"), ("text", "ascending")]))
    texts = rows["text"].to_pylist()
    ids = rows["doc_id"].to_pylist()
    n = len(texts) - sum(rows["tail"].to_pylist())
    changed = [edited(texts[i], texts[i + 1] if i + 1 < len(texts) else texts[0]) for i in range(n)]
    prints = fingerprints(texts + changed)
    own, of_changed = prints[:len(texts)], prints[len(texts):]
    return pa.table({
        "doc_id": pa.array(ids[:n], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array(own[:n], pa.string()),
        "edited_fingerprint": pa.array(of_changed, pa.string()),
        "near_edited": pa.array([likeness(a, b) for a, b in zip(own, of_changed)], pa.float64()),
        "near_next": pa.array([likeness(own[i], own[(i + 1) % len(own)]) for i in range(n)], pa.float64()),
        "point": pa.array([_point(t) for t in texts[:n]], pa.int64())})


def compare_edited(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and their likeness, and that to the next row's.

    The next row follows by doc_id, then text; after the last comes the first. Rows
    lie in batches by doc_id (bounded bytes), and the first row of a batch
    also goes to the batch before it: no task orders all rows.

    - null text: empty; the fingerprint of an empty text is empty, like another empty one (1.0);
    - null doc_ids come last, in batches by a hash of their texts, each in order of its texts;
    - repeated rows and equal ids: in order of their texts, each its own row;
    - a single row is followed by itself; empty table: empty result;
    - other columns of ``docs`` are not looked at; very long texts are read whole.
    """
    return _compared(docs).drop("point")


def _compared(docs: DataFrame) -> DataFrame:
    """``compare_edited`` with the number of each row's text."""
    own = _own(docs)
    ship(docs.sparkSession)
    length = F.octet_length("text").cast("long")
    size = own.agg(F.sum(F.when(F.col("doc_id").isNotNull(), length)).alias("n"),
                   F.sum(F.when(F.col("doc_id").isNull(), length)).alias("none")).first()
    last = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(parts(size["none"] or 0, BATCH_BYTES)))
    dealt = own.withColumn("batch", F.when(F.col("doc_id").isNotNull(), _batch(own, parts(size["n"] or 0, BATCH_BYTES)))
                           .otherwise(last))
    # The first row of each batch, and the batch before it (a row per batch).
    heads = stored(dealt.groupBy("batch").agg(F.min(F.struct(F.col("doc_id"), F.col("text"))).alias("head")), "heads")
    order = Window.orderBy("batch")
    back = heads.select(F.col("batch").alias("from"), F.lag("batch").over(order).alias("before"),
                        F.max("batch").over(Window.partitionBy()).alias("last"))
    tails = (heads.join(back, heads["batch"] == back["from"])
             .select(F.col("head.doc_id").alias("doc_id"), F.col("head.text").alias("text"),
                     F.coalesce("before", "last").alias("batch"), F.lit(1).alias("tail")))
    rows = dealt.select("doc_id", "text", "batch", F.lit(0).alias("tail")).union(tails)
    return rows.groupBy("batch").applyInArrow(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                  "near_edited double, near_next double, point long")


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


# --- banding and verification ---------------------------------------------------

#: A band is a run of steps of the fingerprint's own walk. Edits put a walk out of step for a
#: while, so adjacent steps agree or differ together. Bands lie over the whole text, and a second
#: walk reads it from its end: what edits have done to one walk the other has not met yet.
BAND_STEPS = 32
#: Bands of each walk over the longest text of an octave of lengths (half as many over the shortest).
BANDS = 16
#: Share of the fewer bands that two texts have to agree on before their edit distance is computed.
LEAST_BANDS = 1 / 16
#: Texts of one band above which it counts as crowded (a common head or tail of otherwise different texts).
HOT_CLASSES = 48
#: Rows of a band, and characters of a neighbourhood, that meet in one cell at once, and what of both a task gets about.
_BLOCK, _PLACE_ROWS = 32_000, 8000
_BLOCK_CHARS, _PLACE_CHARS = 1 << 21, 1 << 20
#: Texts alike: their edit distance is at most this share of the longer one's length. Each
#: edit puts the walks out of step for a while, so likeness falls fast with more edits
#: (medians on the given prose: 0.96 at 0.5 %, 0.72 at 2 %, 0.42 at 5 %).
MOST_EDITS = 0.02


def _edits(n: int, most_edits: float) -> int:
    """Edits that a text of ``n`` characters may be away from a longer one."""
    return int(most_edits * n / (1 - most_edits) + 1e-9)


def band_keys(texts: list[str], most_edits: float = MOST_EDITS) -> list[list[int]]:
    """The band keys of each text, from a walk forwards and one backwards.

    Bands begin at shared steps, spaced by the power of two below the length, up to the step at which
    the text ends; a text of which a shorter like one may lie below that power gets the bands
    of the power below too. A text too short for a single edit gets none: only copies are like it."""
    out: list[list[int]] = [[] for _ in texts]
    by_octave: dict[int, list[int]] = {}
    for i, t in enumerate(texts):
        if _edits(len(t), most_edits):
            by_octave.setdefault(len(t).bit_length() - 1, []).append(i)
    for octave, some in by_octave.items():
        each = max(1, _SLICE >> octave + 2)
        for at in range(0, len(some), each):
            _band_walk([texts[i] for i in some[at:at + each]], some[at:at + each], octave, most_edits, out)
    return out


def _spacing(octave: int) -> int:
    return max(BAND_STEPS, (4 << octave) // BANDS)


def _band_walk(texts: list[str], into: list[int], octave: int, most_edits: float, out: list[list[int]]) -> None:
    """Walks over ``texts`` of one octave in both directions, side by side; the keys go to ``out``."""
    walk = _Walk.get()
    sizes = np.array([len(t) for t in texts])
    tape = np.zeros(int((2 * sizes + 2).sum()), np.uint8)
    starts, at = [], 0
    for backwards in (False, True):
        for t in texts:
            c = _classes(t)
            tape[at:at + len(c)] = c[::-1] if backwards else c
            starts.append(at)
            at += len(c) + 1
    raw = tape.tobytes()
    n = len(texts)
    head, lane = np.array(starts, np.int64), np.arange(2 * n)
    below = np.tile(sizes * (1 - most_edits) < 1 << octave, 2)
    octaves = (octave, octave - 1) if below.any() else (octave,)
    step = _spacing(octaves[-1])
    factor = np.uint64(0x9E3779B97F4A7C15)
    j = 0
    while len(head):
        emitted = np.zeros(len(head), np.uint64)
        for k in range(j, j + BAND_STEPS):
            c = tape.take(head)
            emitted = emitted * factor + c
            head = head + walk.moves[k % _PERIOD].take(c)
        going = tape.take(head) != 0
        head, lane, emitted = head[going], lane[going], emitted[going]
        for o in octaves:
            if j % _spacing(o):
                continue
            mine = slice(None) if o == octave else below[lane]
            band = np.uint64(2 * (64 * o + j // _spacing(o)))
            key = (emitted[mine] ^ ((lane[mine] >= n).astype(np.uint64) + band)) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
            for k, x in zip(lane[mine].tolist(), key.view(np.int64).tolist()):
                out[into[k % n]].append(x)
        head = _steps(tape, raw, head, j + BAND_STEPS, step - BAND_STEPS, walk)
        j += step


#: Places of a sketch, a byte each; share of the filled places on which a pair agrees at least.
_PLACES = 64
LEAST_GRAMS = 0.45


def gram_sketch(text: str) -> list[int]:
    """Least hashes of a text's grams, 64 places of a byte in 8 integers.

    Repeats of a gram count as grams of their own, so texts within 2 % edits have at least
    0.78 of all their grams in common (0.76 below 100 characters), and as many of their places agree, give
    or take 0.05 (0.075): LEAST_GRAMS lies over four standard deviations below. An empty place is 255.
    """
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    places = np.full(_PLACES, 0xFFFFFFFF, np.uint64)
    if len(x):
        h = np.sort(_gram_hashes(x) if len(x) >= _GRAM else x)
        new = np.r_[True, h[1:] != h[:-1]]
        at = np.arange(len(h))
        repeat = at - np.maximum.accumulate(np.where(new, at, 0))
        v = (h.astype(np.uint64) + (repeat.astype(np.uint64) << np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v ^= v >> np.uint64(32)
        np.minimum.at(places, (v >> np.uint64(58)).astype(np.int64), v & np.uint64(0xFFFFFFFE))
    # A least hash is near zero, so its bits are mixed before one byte of it is kept.
    low = (places * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) % np.uint64(255)
    return np.where(places == 0xFFFFFFFF, 255, low).astype(np.uint8).view(np.int64).tolist()


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a column of the table per step in the bits of one integer."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(b)) - 1, 1 << (len(b) - 1)
    plus, minus, distance = full, 0, len(b)
    for c in a:
        same = where.get(c, 0)
        down = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        up, left = minus | ~(across | plus) & full, plus & across
        distance += bool(up & top) - bool(left & top)
        up = (up << 1 | 1) & full
        left = left << 1 & full
        plus, minus = (left | ~(down | up)) & full, up & down
    return distance


#: Characters of a gram, and buckets that grams are counted in (shared buckets only hide differences).
_GRAM = 6
_GRAM_BUCKETS = 1 << 14


def _gram_hashes(chars: np.ndarray) -> np.ndarray:
    n = max(0, len(chars) - _GRAM + 1)
    h = np.zeros(n, np.uint32)
    for k in range(_GRAM):
        h = (h ^ chars[k:k + n]) * np.uint32(0x9E3779B1)
    return h


def _grams(chars: np.ndarray) -> np.ndarray:
    return np.bincount((_gram_hashes(chars) >> np.uint32(18)).astype(np.int64), minlength=_GRAM_BUCKETS)


def within(a: str, b: str, most: int) -> bool:
    """Is the edit distance at most ``most``; exact, and cheap where that is plain early."""
    if abs(len(a) - len(b)) > most:
        return False
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (a, b))
    m = min(len(x), len(y))
    differ = np.flatnonzero(x[:m] != y[:m])
    start = int(differ[0]) if len(differ) else m
    differ = np.flatnonzero(x[::-1][:m - start] != y[::-1][:m - start])
    stop = int(differ[0]) if len(differ) else m - start
    a, b = a[start:len(a) - stop], b[start:len(b) - stop]
    if max(len(a), len(b)) <= most:
        return True
    # An edit takes away and adds at most _GRAM grams, so beyond that no alignment is needed.
    more = _grams(x) - _grams(y)
    bound = _GRAM * most
    if max(more[more > 0].sum(), -more[more < 0].sum()) > bound:
        return False
    of_x = _needed(x, y, most)
    if of_x[0] > most:
        return False
    of_y = _needed(y, x, most)
    if of_y[0] > most:
        return False
    return _reaches(x[start:len(x) - stop], y[start:len(y) - stop], most, of_x[start:], of_y[start:])


#: Characters of the short grams whose places are compared.
_SHORT = 3
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _needed(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Edits that ``x`` from each place on needs at least, if all are at most ``most``.

    A short gram that ``y`` has nowhere within ``most`` characters of the same place has an
    edit inside; of such grams as many as lie side by side are counted."""
    n, m = len(x) - _SHORT + 1, len(y) - _SHORT + 1
    out = np.zeros(len(x) + 1, np.int64)
    if n <= 0:
        return out
    # Grams as 31 bits of a hash: equal hashes of different grams only hide an edit.
    of = lambda c, k: (sum(c[i:i + k] * np.uint32(_FACTORS[i]) for i in range(_SHORT)) >> np.uint32(1)).astype(np.int64) << 32
    there = np.r_[np.sort(of(y, max(m, 0)) + np.arange(max(m, 0))), np.int64(2**63 - 1)]
    at = np.arange(n)
    own = of(x, n) + at
    missing = there[np.searchsorted(there, own - np.minimum(at, most))] > own + most
    last = len(x) + 1
    for i in np.flatnonzero(missing)[::-1].tolist():
        if i + _SHORT <= last:
            out[i] = 1
            last = i
    return np.cumsum(out[::-1])[::-1]


#: Characters compared at once along each diagonal, and along the few that go on.
_RUN, _LONG_RUN = 16, 256


def _reaches(x: np.ndarray, y: np.ndarray, most: int, of_x: np.ndarray, of_y: np.ndarray) -> bool:
    """Do ``most`` edits lead from ``x`` to ``y``? After d edits, how far along ``x`` each
    diagonal can be is a vector; diagonals that the edits left cannot bring to the end, by their
    distance from the last one or by the edits that the rest of ``x`` or ``y`` needs at least (``of_x``, ``of_y``), are cut off."""
    n, m = len(x), len(y)
    target = n - m
    # Different ends keep runs from leaving the arrays.
    x = np.r_[x, np.full(_LONG_RUN, 1 << 30, np.uint32)]
    y = np.r_[y, np.full(_LONG_RUN, 1 << 31, np.uint32)]
    lo, reach = 0, _runs(x, y, np.zeros(1, np.int64), np.zeros(1, np.int64))
    for d in range(most + 1):
        at = target - lo
        if 0 <= at < len(reach) and reach[at] >= n:
            return True
        if d == most:
            return False
        left = most - d - 1
        wide = np.full(len(reach) + 4, -(1 << 40))
        wide[2:-2] = reach
        # One more edit: along the diagonal, from the one below (a character of x), from the one above (of y).
        new = np.maximum(np.maximum(wide[1:-1] + 1, wide[:-2] + 1), wide[2:])
        first = lo - 1
        a, b = max(first, target - left, -m), min(first + len(new) - 1, target + left, n)
        if a > b:
            return False
        new = new[a - first:b - first + 1]
        diagonal = np.arange(a, b + 1)
        new = np.minimum(new, np.minimum(n, m + diagonal))
        new = np.where(new < np.maximum(0, diagonal), -(1 << 40), new)
        live = np.flatnonzero(new >= 0)
        new[live] = _runs(x, y, new[live], new[live] - diagonal[live])
        needed = np.maximum(of_x[new[live]], of_y[new[live] - diagonal[live]])
        new[live[needed > left]] = -(1 << 40)
        if not (new >= 0).any():
            return False
        going = np.flatnonzero(new >= 0)
        lo, reach = a + int(going[0]), new[going[0]:going[-1] + 1]
    return False


def _runs(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How far each pair of places goes on with equal characters: the places in ``x`` where they stop."""
    i, j = i.copy(), j.copy()
    going, size = np.arange(len(i)), _RUN
    while len(going):
        steps = np.arange(size)
        same = x[np.minimum(i[going, None] + steps, len(x) - 1)] == y[np.minimum(j[going, None] + steps, len(y) - 1)]
        whole = same.all(axis=1)
        length = np.where(whole, size, same.argmin(axis=1))
        i[going] += length
        j[going] += length
        going = going[whole]
        size = _LONG_RUN if len(going) <= 64 else _RUN
    return i


def near_duplicates(docs: DataFrame, most_edits: float = MOST_EDITS) -> DataFrame:
    """(doc_id, class_id, n_links): documents joined by a small edit distance.

    Equal texts are one point (its smallest doc_id). Points that share a band are
    candidates; a pair is linked if its exact edit distance is at most ``most_edits``
    times the longer length. ``class_id`` is the smallest doc_id reachable. Candidates
    that links already join are not compared, so ``n_links`` counts the links
    that hold the row's text in its class, not all texts that are like it. Pairs whose gram
    sketches disagree (see ``gram_sketch``) are not compared either. Pairs are made in arrays, cell by cell: first those
    of each band by lengths and sketches, then those of each neighbourhood that these hold together,
    where texts are aligned; only pairs that join two sets become rows. The README has the recall.

    - null text: empty; an empty text is linked to equal ones only;
    - null doc_ids take no part and get class null; repeated rows: one row each;
    - equal ids with different texts: each text is its own point;
    - empty table: empty result; other columns of ``docs`` are not looked at.
    """
    return _classed(_own(docs).select("doc_id", _points(F.col("text")).alias("point")), _labels(docs, most_edits)).drop("point")


def edit_fingerprints(docs: DataFrame, most_edits: float = MOST_EDITS) -> DataFrame:
    """``compare_edited`` with the class_id and n_links of ``near_duplicates``."""
    return _classed(_compared(docs), _labels(docs, most_edits)).drop("point")


def _classed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = F.col("doc_id").isNotNull()
    return (rows.join(labels, "point", "left")
            .withColumn("class_id", F.when(known, F.coalesce("class_id", "doc_id")))
            .withColumn("n_links", F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long")))


#: Pairs looked at at once, and cells of their distance tables; above _LONG characters a pair is aligned on its own.
_PAIRS, _CELLS, _LONG = 1 << 18, 1 << 15, 1 << 16
#: Words of a tape compared at once where few diagonals go on.
_AHEAD = 16


def _cells(rows: DataFrame, block: int, most_edits: float) -> DataFrame:
    """(key, step, i, j, point, n, shorter, longer): where each row of ``rows`` (key, point, n, weight, held) meets the others of its key.

    A key that ``held`` at most ``block`` (the sum of its weights) is one cell. In others lengths fall into
    steps of the share that like texts may differ by, so the longer text of a pair lies in the step of the
    shorter one or in the next: each row lies in the window of its step and of the one before. Windows of more
    than ``block`` are dealt over blocks, and each two blocks meet in one cell: each pair meets once."""
    whole = rows.where(F.col("held") <= block).select(
        "key", F.lit(-1).cast("long").alias("step"), F.lit(0).alias("i"), F.lit(0).alias("j"), "point", "n", F.lit(True).alias("shorter"), F.lit(True).alias("longer"))
    step = F.floor(F.log("n") / F.lit(-math.log1p(-most_edits) * (1 + 1e-6)))
    wide = (rows.where(F.col("held") > block)
            .select("key", "point", "n", "weight", step.alias("of"), F.explode(F.array(F.lit(0), F.lit(1))).alias("back"))
            .withColumn("step", F.col("of") - F.col("back")).withColumn("own", F.col("back") == 0))
    each = wide.groupBy("key", "step").agg(F.ceil(F.sum("weight") / F.lit(block)).cast("int").alias("blocks"))
    all_ = F.sequence(F.lit(0), F.col("blocks") - 1)
    # Its block meets the others as the shorter texts (in the own step), and the others it as the longer ones.
    as_short = F.filter(all_, lambda o: F.col("own") | (o == F.col("block")))
    cells = F.concat(
        F.transform(as_short, lambda o: F.struct(F.col("block").alias("i"), o.alias("j"), F.col("own").alias("shorter"), (o == F.col("block")).alias("longer"))),
        F.transform(F.filter(all_, lambda o: o != F.col("block")),
                    lambda o: F.struct(o.alias("i"), F.col("block").alias("j"), F.lit(False).alias("shorter"), F.lit(True).alias("longer"))))
    dealt = (wide.join(each, ["key", "step"]).withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
             .select("key", "step", "point", "n", F.inline(cells)))
    return whole.union(dealt.select(whole.columns))


def _placed(cells: DataFrame, held: DataFrame, block: int, each: int) -> DataFrame:
    """``cells`` with the place that each cell is worked on in, of about ``each`` of what the keys of ``held`` (held) hold."""
    blocks = F.ceil(F.col("held") / F.lit(block))
    n = held.agg(F.sum(F.when(F.col("held") <= block, F.col("held")).otherwise(2 * F.col("held") * (2 * blocks - 1)))).first()[0]
    return cells.withColumn("place", F.pmod(F.xxhash64("key", "step", "i", "j"), F.lit(parts(n or 0, each))))


class _Place:
    """The rows of some cells in order of length, and the sets that their points are joined to so far."""

    def __init__(self, rows: pa.Table, most_edits: float):
        self.rows = rows = rows.sort_by([(c, "ascending") for c in ("key", "step", "i", "j", "n", "point")])
        self.most_edits = most_edits
        self.n, self.shorter, self.longer = (rows[c].to_numpy() for c in ("n", "shorter", "longer"))
        self.points, self.item = np.unique(rows["point"].to_numpy(), return_inverse=True)
        self.label = np.arange(len(self.points))
        self.places = rows["sketch"].combine_chunks().flatten().to_numpy().reshape(-1, _PLACES // 8).view(np.uint8)
        new = np.zeros(rows.num_rows, np.int64)
        for c in ("key", "step", "i", "j"):
            x = rows[c].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        self.cell = np.cumsum(new)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(shorter rows, longer rows): of each cell the pairs that lengths and sketches let pass, without those already joined."""
        n, cell = self.n, self.cell << 40
        most = np.floor(n / (1 - self.most_edits) + 1e-6).astype(np.int64)
        many = np.searchsorted(cell + n, cell + most, "right") - np.arange(len(n)) - 1
        many[~self.shorter] = 0
        sums = np.cumsum(many)
        first = 0
        while first < len(n):
            end = max(first + 1, int(np.searchsorted(sums, sums[first] - many[first] + _PAIRS, "right")))
            some = many[first:end]
            x = np.repeat(np.arange(first, end), some)
            y = np.arange(len(x)) - np.repeat(np.cumsum(some) - some, some) + x + 1
            keep = self.longer[y] & (n[y] - n[x] <= self.most_edits * n[y] + 1e-9) & self.apart(x, y)
            x, y = x[keep], y[keep]
            p, q = self.places[x], self.places[y]
            filled = ((p & q) != 255).sum(axis=1)
            alike = filled - (p != q).sum(axis=1) >= filled * LEAST_GRAMS
            yield x[alike], y[alike]
            first = end

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.label[self.item[x]] != self.label[self.item[y]]

    def join(self, x: np.ndarray, y: np.ndarray) -> pa.Table:
        """Joins the pairs' sets; those pairs that joined two of them."""
        a, b = self.item[x], self.item[y]
        roots, at = np.unique(self.label[np.r_[a, b]], return_inverse=True)
        parent, joins = list(range(len(roots))), []
        for t, (p, q) in enumerate(zip(at[:len(a)].tolist(), at[len(a):].tolist())):
            while parent[p] != p:
                parent[p] = p = parent[parent[p]]
            while parent[q] != q:
                parent[q] = q = parent[parent[q]]
            if p != q:
                parent[max(p, q)] = min(p, q)
                joins.append(t)
        for r, up in enumerate(parent):  # a set's first root comes before its others
            parent[r] = parent[up]
        now = np.arange(len(self.label))
        now[roots] = roots[parent]
        self.label = now[self.label]
        return pa.table({"src": pa.array(self.points[a[joins]], pa.int64()), "dst": pa.array(self.points[b[joins]], pa.int64())})


_EDGES = pa.schema([("src", pa.int64()), ("dst", pa.int64())])


def _near_pairs(rows: pa.Table, most_edits: float) -> pa.Table:
    """(src, dst): pairs that hold together what lengths and sketches let pass (not all such pairs)."""
    place = _Place(rows, most_edits)
    return pa.concat_tables([_EDGES.empty_table(), *(place.join(x, y) for x, y in place.pairs())])


def _links(rows: pa.Table, most_edits: float) -> pa.Table:
    """(src, dst): pairs within ``most_edits`` that hold their classes together; pairs of texts already in one class are not compared."""
    place = _Place(rows, most_edits)
    bands, tape = _Bands(place.rows["keys"]), None
    out = [_EDGES.empty_table()]
    for x, y in place.pairs():
        common = bands.common(x, y)
        x, y = x[common], y[common]
        if len(x) and tape is None:
            tape = _Tape(place.rows["text"])
            tape.families = _Families(tape, place)
        # Few at first: the more is joined, the less is left to compare.
        first, few = 0, 256
        while first < len(x):
            a, b = x[first:first + few], y[first:first + few]
            first, few = first + few, min(2 * few, 1 << 14)
            apart = place.apart(a, b)
            a, b = a[apart], b[apart]
            close = tape.within(a, b, (most_edits * place.n[b] + 1e-9).astype(np.int64))
            out.append(place.join(a[close], b[close]))
    return pa.concat_tables(out)


class _Bands:
    """The bands of each row that other rows have too."""

    def __init__(self, keys: pa.ChunkedArray):
        keys = keys.combine_chunks()
        self.size = pc.list_value_length(keys).to_numpy()
        _, key, many = np.unique(keys.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(self.size)), self.size)
        shared = many[key] > 1
        self.key_count = len(many)
        self.codes = np.unique(row[shared] * self.key_count + key[shared])
        self.ends = np.searchsorted(self.codes, np.arange(len(self.size) + 1) * self.key_count)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Do the pairs agree on LEAST_BANDS of the fewer bands?"""
        out = np.zeros(len(x), bool)
        least = np.maximum(1, np.ceil(np.minimum(self.size[x], self.size[y]) * LEAST_BANDS))
        for at in range(0, len(x), _CELLS):
            a, b = x[at:at + _CELLS], y[at:at + _CELLS]
            some = self.ends[a + 1] - self.ends[a]
            pair = np.repeat(np.arange(len(a)), some)
            code = self.codes[np.arange(len(pair)) - np.repeat(np.cumsum(some) - some, some) + self.ends[a][pair]]
            code += (b - a)[pair] * self.key_count
            found = self.codes[np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)] == code if len(code) else code == 0
            out[at:at + _CELLS] = np.bincount(pair[found], minlength=len(a)) >= least[at:at + _CELLS]
        return out


class _Tape:
    """Texts one after the other, each character in a code of few bytes, and the 8 bytes from each place as an integer."""

    def __init__(self, texts: pa.ChunkedArray):
        self.texts = texts.to_pylist()
        chars = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in self.texts]
        known = np.zeros(0x110000, bool)
        for c in chars:
            known[c] = True
        code = np.cumsum(known)  # 0 is the end of a text
        kind = np.dtype(next(k for k in (np.uint8, np.uint16, np.uint32) if code[-1] <= np.iinfo(k).max))
        self.n = np.array([len(c) for c in chars])
        self.start = np.cumsum(np.r_[0, self.n + 1])[:-1]
        self.codes = tape = np.zeros(int(self.n.sum()) + len(chars) + 8, kind)
        for c, at in zip(chars, self.start.tolist()):
            tape[at:at + len(c)] = code[c]
        self.words = np.ndarray(len(tape) - 8, "<u8", tape.tobytes(), strides=(kind.itemsize,)).copy()
        self.shift = 2 + kind.itemsize.bit_length()
        self.families: _Families | None = None

    def within(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Is the edit distance of each pair (shorter, longer) at most ``most``? Exact."""
        out = np.zeros(len(x), bool)
        order = np.argsort(most, kind="stable")
        if self.families is not None:
            order = order[self.families.least(x[order], y[order]) <= most[order]]
        long = self.n[y[order]] > _LONG
        for t in order[long].tolist():
            out[t] = within(self.texts[x[t]], self.texts[y[t]], int(most[t]))
        order = order[~long]
        first = 0
        while first < len(order):
            least = int(most[order[first]])
            end = min(int(np.searchsorted(most[order], least + least // 4 + 2, "right")), first + max(1, _CELLS // (least + 1)))
            some = order[first:end]
            out[some] = self._reach(x[some], y[some], most[some])
            first = end
        return out

    def _reach(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """``_reaches`` for many pairs side by side: how far along ``x`` each diagonal is after d edits.

        A pair is given up when the blocks that lie beyond all its diagonals need more edits than are left (see ``_Families``)."""
        rest_x, rest_y = (np.zeros((len(x), 1), np.int32),) * 2 if self.families is None else (self.families.rest(x, y), self.families.rest(y, x))
        sx, sy, n, m = self.start[x], self.start[y], self.n[x], self.n[y]
        out, pair = np.zeros(len(x), bool), np.arange(len(x))
        target, all_ = m - n, int(most.max(initial=0))
        below, none = 0, -(1 << 40)
        reach = self._run(sx, sy, n, m, np.zeros((len(x), 1), np.int64), np.zeros(1, np.int64))
        d = 0
        while True:
            at = target - below
            inside = (at >= 0) & (at < reach.shape[1])
            done = inside & (most >= d) & (reach[np.arange(len(at)), np.where(inside, at, 0)] >= n)
            out[pair[done]] = True
            diagonal = below + np.arange(reach.shape[1])
            needed = np.maximum(_beyond(rest_x, reach.max(axis=1)), _beyond(rest_y, (reach + diagonal).max(axis=1)))
            going = ~done & (most > d) & (needed <= most - d)
            if not going.any():
                return out
            if going.mean() < 0.8:
                pair, sx, sy, n, m, target, most, reach, rest_x, rest_y = (
                    v[going] for v in (pair, sx, sy, n, m, target, most, reach, rest_x, rest_y))
            d += 1
            all_ = int(most.max())
            lo = max(-d, int(target.min()) - (all_ - d))
            hi = min(d, int(target.max()) + all_ - d)
            # One more edit: along the diagonal, from the one above (a character of x), from the one below (of y).
            wide = np.full((len(pair), hi - lo + 3), none)
            a, b = max(below, lo - 1), min(below + reach.shape[1] - 1, hi + 1)
            wide[:, a - lo + 1:b - lo + 2] = reach[:, a - below:b - below + 1]
            new = np.maximum(np.maximum(wide[:, 1:-1], wide[:, 2:]) + 1, wide[:, :-2])
            reach, below = self._run(sx, sy, n, m, new, np.arange(lo, hi + 1)), lo

    def _run(self, sx: np.ndarray, sy: np.ndarray, n: np.ndarray, m: np.ndarray, i: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Where along ``x`` the characters of each diagonal stop being equal, from places ``i`` on."""
        end = np.minimum(n[:, None], m[:, None] - diagonal)
        i = np.minimum(i, end).ravel()
        end = end.ravel()
        here = i + np.repeat(sx, len(diagonal))
        there = here + ((sy - sx)[:, None] + diagonal).ravel()
        some: slice | np.ndarray = slice(None)
        step = 64 >> self.shift
        while True:
            v = self.words.take(here, mode="clip") ^ self.words.take(there, mode="clip")
            # The lowest bit that differs lies in the first character that does.
            same = np.bitwise_count((v & (~v + np.uint64(1))) - np.uint64(1)) >> self.shift
            i[some] = np.minimum(i[some] + same, end[some])
            going = np.flatnonzero((v == 0) & (i[some] < end[some]))
            if not len(going):
                return i.reshape(len(sx), len(diagonal))
            some = going if isinstance(some, slice) else some[going]
            here, there = here[going] + step, there[going] + step
            while len(some) <= _CELLS // _AHEAD:  # few go on, and those mostly far: more is compared at once
                ahead = step * np.arange(_AHEAD)
                equal = self.words.take(here[:, None] + ahead, mode="clip") == self.words.take(there[:, None] + ahead, mode="clip")
                far = equal.all(axis=1)
                words = np.where(far, _AHEAD, equal.argmin(axis=1))
                i[some] = np.minimum(i[some] + step * words, end[some])
                here, there = here + step * words, there + step * words
                if not (far & (i[some] < end[some])).any():
                    break


#: Characters of a block, a bit each; texts of a cell that are a family at least, and families of a cell at most
#: (they only save alignments); bits of the blocks' characters held at once, and texts times blocks.
_BIT, _FAMILY, _FAMILIES, _MASKS, _LANES = 64, 3, 8, 1 << 21, 1 << 14


def _beyond(rest: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What ``_Families.rest`` has from each place on."""
    return rest[np.arange(len(rest)), np.clip(-(-place // _BIT), 0, rest.shape[1] - 1)]


class _Families:
    """Edits that pairs of texts need at least, from blocks of a text that others have as they are.

    A pivot of each family is cut into blocks. In an alignment each block that a text has as it is, no two
    overlapping, is aligned to some part of the other text, and the edits of these parts add up. A part's
    edits are at least those of the block and the best part of the other text near the block's place, which depend
    on that text and the block alone: so a text is aligned to the blocks once, not to every other text."""

    def __init__(self, tape: _Tape, place: _Place):
        self.tape, self.n = tape, tape.n
        self.family = np.full(len(tape.n), -1)
        self.grid_at, self.cost_at = np.zeros(len(tape.n), np.int64), np.zeros(len(tape.n), np.int64)
        self.grids, self.costs, self.held = [], [], [0, 0]
        lanes: list[tuple[np.ndarray, ...]] = []  # (places in costs, blocks' places on the tape, first characters, ends) of the texts
        self.hashes = self._hashes()
        cuts = np.flatnonzero(np.r_[True, place.cell[1:] != place.cell[:-1], True])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            most = int(place.most_edits * int(tape.n[a:b].max()) + 1e-9)
            rows = np.arange(a, b)
            for _ in range(_FAMILIES):
                if len(rows) < _FAMILY or not most:
                    break
                rows = self._gather(rows, self._pivot(place.places[rows]), most, lanes)
        del self.hashes
        self.grid = np.concatenate([np.zeros(1, np.int32), *self.grids])
        self.cost = np.concatenate([np.zeros(1, np.uint8), *self.costs])
        if lanes:
            self._align(*map(np.concatenate, zip(*lanes)))

    def _hashes(self) -> np.ndarray:
        """A hash of the _BIT characters from each place of the tape on."""
        h, size = self.tape.words.copy(), 64 >> self.tape.shift
        while size < _BIT:
            h[:-size] = (h[:-size] ^ h[:-size] >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + h[size:]
            size *= 2
        return h

    @staticmethod
    def _pivot(places: np.ndarray) -> int:
        """The text whose sketch has most of the commonest values."""
        many = np.bincount((places + 256 * np.arange(_PLACES)).ravel(), minlength=256 * _PLACES).reshape(_PLACES, 256)
        return int((places == many[:, :255].argmax(axis=1)).sum(axis=1).argmax())

    def _gather(self, rows: np.ndarray, pivot: int, most: int, lanes: list) -> np.ndarray:
        """Makes a family of those of ``rows`` that have an eighth of the pivot's blocks; the others."""
        tape, k = self.tape, int(self.n[rows[pivot]]) // _BIT
        if k < 2:
            return np.delete(rows, pivot)
        blocks = tape.start[rows[pivot]] + _BIT * np.arange(k)
        order = np.argsort(self.hashes[blocks], kind="stable")
        hashes = self.hashes[blocks[order]]
        # Rows of a cell that earlier families took lie between: their places are dropped.
        base = tape.start[rows[0]]
        mine = self.hashes[base:tape.start[rows[-1]] + tape.n[rows[-1]]]
        at = np.minimum(np.searchsorted(hashes, mine), k - 1)
        found = np.flatnonzero(hashes[at] == mine)
        block, found = order[at[found]], found + base
        for c in range(0, _BIT, 64 >> tape.shift):
            same = tape.words[found + c] == tape.words[blocks[block] + c]
            found, block = found[same], block[same]
        row = np.searchsorted(tape.start[rows], found, "right") - 1
        at = found - tape.start[rows[row]]
        moved = np.abs(at - _BIT * block)
        near = (moved <= most) & (at + _BIT <= tape.n[rows[row]])
        row, block, at, moved = row[near], block[near], at[near], moved[near]
        order = np.lexsort((moved, row * k + block))
        order = order[np.r_[True, np.diff((row * k + block)[order]) > 0][:len(order)]]
        places = np.full((len(rows), k), -_BIT)
        places[row[order], block[order]] = at[order]
        before = np.maximum.accumulate(np.c_[np.full(len(rows), -_BIT), places[:, :-1]], axis=1)
        has = (places >= 0) & (places >= before + _BIT)
        member = has.sum(axis=1) >= max(1, k // 8)
        member[pivot] = True
        if member.sum() > 1:
            ours, has, places = rows[member], has[member], places[member]
            self.family[ours] = rows[pivot]
            size = tape.n[ours] // _BIT + 2
            grid = np.full(int(size.sum()), k, np.int32)
            first = np.cumsum(size) - size
            text, block = np.nonzero(has)
            grid[first[text] + places[text, block] // _BIT] = block
            self.grid_at[ours] = self.held[0] + 1 + first
            self.cost_at[ours] = self.held[1] + 1 + (k + 1) * np.arange(len(ours))
            text, block = np.nonzero(~has)
            start, n = tape.start[ours[text]], tape.n[ours[text]]
            lanes.append((self.cost_at[ours[text]] + block, blocks[block], start + np.minimum(n, np.maximum(0, _BIT * block - 2 * most)),
                          start + np.minimum(n, _BIT * (block + 1) + 2 * most)))
            self.grids.append(grid)
            self.costs.append(np.zeros(len(ours) * (k + 1), np.uint8))
            self.held = [self.held[0] + len(grid), self.held[1] + len(self.costs[-1])]
        return rows[~member]

    def _align(self, to: np.ndarray, block: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
        """The least edits between each block and a part of the characters from ``first`` to ``end``: columns of the table in the bits of one integer."""
        kinds = int(self.tape.codes.max()) + 1
        blocks, which = np.unique(block, return_inverse=True)
        each = max(1, _MASKS // kinds)
        for low in range(0, len(blocks), each):
            some = blocks[low:low + each]
            masks = np.zeros(len(some) * kinds, np.uint64)
            for i in range(_BIT):
                masks[np.arange(len(some)) * kinds + self.tape.codes[some + i]] |= np.uint64(1 << i)
            mine = np.flatnonzero((which >= low) & (which < low + each))
            mine = mine[np.argsort(first[mine] - end[mine], kind="stable")]  # the longest first
            for at in range(0, len(mine), _LANES):
                lane = mine[at:at + _LANES]
                self.cost[to[lane]] = self._columns(masks, (which[lane] - low) * kinds, first[lane], end[lane] - first[lane])

    def _columns(self, masks: np.ndarray, own: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        one, top = np.uint64(1), np.uint64(_BIT - 1)
        plus, minus = np.full(len(own), ~np.uint64(0)), np.zeros(len(own), np.uint64)
        now, least = np.full(len(own), _BIT, np.int64), np.full(len(own), _BIT, np.int64)
        going = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
        for j, g in enumerate(going.tolist()):
            up, down = plus[:g], minus[:g]
            same = masks[own[:g] + self.tape.codes[first[:g] + j]]
            across = (((same & up) + up) ^ up) | same
            same |= down
            more, less = down | ~(across | up), up & across
            now[:g] += (more >> top).view(np.int64) - (less >> top).view(np.int64)
            more <<= one
            less <<= one
            plus[:g], minus[:g] = less | ~(same | more), more & same
            np.minimum(least[:g], now[:g], out=least[:g])
        return least

    def _costs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair, by the places of ``x`` in steps of _BIT: the edits of ``x``'s block there and the best part of ``y``."""
        size = self.n[x] // _BIT + 2
        at = np.minimum(np.arange(int(size.max(initial=1))), size[:, None] - 1)  # the last has no block
        same = (self.family[x] == self.family[y]) & (self.family[x] >= 0)
        block = self.grid[np.where(same[:, None], self.grid_at[x][:, None] + at, 0)]
        return self.cost[np.where(same[:, None], self.cost_at[y][:, None] + block, 0)]

    def least(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Edits that each pair needs at least."""
        out = np.zeros(len(x), np.int64)
        some = np.flatnonzero((self.family[x] == self.family[y]) & (self.family[x] >= 0))
        while len(some):
            now, some = np.split(some, [max(1, min(_LANES, _PAIRS * _BIT // int(self.n[y[some[:_LANES]]].max())))])
            a, b = x[now], y[now]
            out[now] = np.maximum(self._costs(a, b).sum(axis=1, dtype=np.int64), self._costs(b, a).sum(axis=1, dtype=np.int64))
        return out

    def rest(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Edits that each pair needs at least from the places of ``x`` on, in steps of _BIT."""
        return np.cumsum(self._costs(x, y)[:, ::-1], axis=1, dtype=np.int32)[:, ::-1]


#: Bits of the sieve that keeps rows without a partner from being moved.
_SIEVE = 1 << 24


def _sieved(rows: DataFrame, partners: DataFrame, name: str) -> DataFrame:
    """The rows of ``rows`` whose number ``name`` may be one of ``partners``: all that are and few others.

    The numbers' bits are broadcast: 2 MB at most, whatever their number."""
    bit = F.pmod(F.col(name), F.lit(_SIEVE))
    sieve = partners.groupBy(F.bitmap_bucket_number(bit).alias("shelf")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    at = F.bitmap_bit_position(bit).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("shelf", F.bitmap_bucket_number(bit)).join(F.broadcast(sieve), "shelf")
            .where(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), at % 8 + 1)) != 0).select(rows.columns))


def _labels(docs: DataFrame, most_edits: float) -> DataFrame:
    """(point, class_id, n_links) of each text that has copies or links."""
    own = _own(docs).where("doc_id is not null").select("doc_id", _points(F.col("text")).alias("point"), "text")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(band_keys(texts, most_edits), pa.list_(pa.int64())),
                 pa.array([gram_sketch(t) for t in texts], pa.list_(pa.int64()))], names=["doc_id", "point", "n", "keys", "sketch"])

    def near(table: pa.Table) -> pa.Table:
        return _near_pairs(table, most_edits)

    def link(table: pa.Table) -> pa.Table:
        return _links(table, most_edits)

    points = stored(map_arrow(own, keys, "doc_id long, point long, n long, keys array<long>, sketch array<long>").groupBy("point").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.any_value("n").alias("n"),
        F.any_value("keys").alias("keys"), F.any_value("sketch").alias("sketch")), "edit-points")
    bands = points.select("point", "n", F.explode(F.array_distinct("keys")).alias("key"))
    # Counted, then joined: a band that very many texts share is split by AQE, not held by one task.
    held = stored(bands.groupBy("key").agg(F.count("*").alias("held")).where("held > 1"), "edit-bands")
    shared = _cells(_sieved(bands, held, "key").join(held, "key").withColumn("weight", F.lit(1)), _BLOCK, most_edits).join(points.select("point", "sketch"), "point")
    # What a band's pairs that may be alike hold together is a neighbourhood; no pair is a row but those that do so.
    edges = stored(_placed(shared, held, _BLOCK, _PLACE_ROWS).groupBy("place").applyInArrow(near, "src long, dst long"), "edit-near")
    hoods = stored(components(edges).select(F.col("node").alias("point"), F.col("component").alias("key")).join(points.select("point", "node", "n"), "point"), "edit-hoods")
    # Each neighbourhood's texts meet once, and its pairs are aligned there.
    chars = stored(hoods.groupBy("key").agg(F.sum("n").alias("held")), "edit-chars")
    met = _placed(_cells(hoods.withColumn("weight", F.col("n")).join(chars, "key"), _BLOCK_CHARS, most_edits), chars, _BLOCK_CHARS, _PLACE_CHARS)
    # By point and doc_id all along, so that texts are not dealt out again, nor copies of one text to one task.
    both, nodes = ["point", "doc_id"], hoods.select("point", F.col("node").alias("doc_id"))
    texts = (_sieved(own, hoods, "point").join(nodes, both).dropDuplicates(both)
             .join(_sieved(points.select("point", F.col("node").alias("doc_id"), "keys", "sketch"), hoods, "point"), both))
    links = stored(met.join(nodes, "point").join(texts, both).drop("doc_id").groupBy("place").applyInArrow(link, "src long, dst long"), "edit-links")
    degree = links.select(F.col("src").alias("point")).union(links.select("dst")).groupBy("point").agg(F.count("*").alias("n_links"))
    member = points.select("point", "node", "copies").join(
        components(links).select(F.col("node").alias("point"), "component"), "point", "left").where("copies > 1 or component is not null")
    member = member.withColumn("component", F.coalesce("component", "point"))
    least = member.groupBy("component").agg(F.min("node").alias("class_id"))
    labels = stored(member.join(least, "component").join(degree, "point", "left")
                    .select("point", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "edit-labels")
    for done in (points, held, edges, hoods, chars, links):
        dropped(done)
    return labels
