"""Sequence packing: shortest-pack-first over the length histogram.

1. Every text becomes ids plus an end id and is cut into pieces of at most
   ``max_tokens``; all but its last piece are full. A piece carries its own
   rank among the pieces of its length and task.
2. The histogram of piece lengths (at most ``max_tokens`` entries) is packed:
   lengths longest first, each into the open patterns with the most room left
   (the shortest pack), splitting pattern counts where needed.
3. Ranks become global by prefix sums over (length, task); each pattern takes
   ranges of ranks of its lengths, so a join on the length with a small table
   of ranges gives each piece its sequence and offset.

Only the histogram and the patterns pass the driver: both are bounded by
``max_tokens`` and do not grow with the documents.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiocube.llm.common import map_arrow, stored, text_slices
from regiocube.llm.tokens import SLICE_BYTES, Encoder

MAX_TOKENS = 2048
END_ID = 1

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, task_rank long"


def pieces(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Every row's ids, ended by ``end_id``, in pieces of at most ``max_tokens`` ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        end = end_id.to_bytes(4, "little")
        schema = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])
        for b in batches:
            keys = b.column(0).to_pylist()
            for i, texts in text_slices(b.column(1), SLICE_BYTES):
                rows: list[tuple] = []
                for doc, ids in zip(keys[i:], encoder.ids(texts)):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, max_tokens):
                        part = ids[4 * start:4 * (start + max_tokens)]
                        n = len(part) // 4
                        rank = seen[n] = seen.get(n, -1) + 1
                        rows.append((doc, start, n, zlib.crc32(part), total, task, rank))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(own, run, _PIECES)


def shortest_pack_first(histogram: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a pattern, how many sequences follow it), packing every piece of the histogram."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by free tokens
    largest: list[int] = []  # a heap of -free
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], count: int, free: int) -> None:
        if free == 0:
            done.append((pattern, count))
            return
        if free not in room:
            room[free] = []
            heapq.heappush(largest, -free)
        room[free].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed: list[tuple[tuple[int, ...], int, int]] = []
        while left and largest and -largest[0] >= length:
            free = -largest[0]
            pattern, count = room[free].pop()
            if not room[free]:
                del room[free]
                heapq.heappop(largest)
            # A pattern takes as many equal pieces as fit at once.
            fits = min(free // length, left)
            uses = min(count, left // fits)
            if uses < count:
                put(pattern, count - uses, free)
            left -= uses * fits
            placed.append((pattern + (length,) * fits, uses, free - fits * length))
        if left:
            fits = min(max_tokens // length, left)
            whole, rest = divmod(left, fits)
            placed.append(((length,) * fits, whole, max_tokens - fits * length))
            if rest:
                placed.append(((length,) * rest, 1, max_tokens - rest * length))
        for pattern, count, free in placed:
            put(pattern, count, free)
    for of_room in room.values():
        done += of_room
    return sorted(done)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): each slot of a pattern takes a range of ranks."""
    out = []
    used: dict[int, int] = {}
    sequence = 0
    for lengths, count in patterns:
        offset = 0
        for n in lengths:
            first = used.get(n, 0)
            used[n] = first + count
            out.append((n, first, first + count, sequence, offset))
            offset += n
        sequence += count
    return out


def pack(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    - null or empty text: one piece, the end id;
    - very long texts: cut every ``max_tokens`` ids, no id lost;
    - repeated rows and null doc_ids: pieces of their own;
    - empty table: empty result; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, vocabulary, max_tokens, end_id), "pieces")
    held = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # Tasks before this one, per length: a window holds a row per task.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # A row per piece is many times its size in the files of ``cut``, so it is not broadcast.
    ranked = cut.join(base.hint("merge"), ["length", "task"]).withColumn("rank", F.col("base") + F.col("task_rank"))
    found = slots(shortest_pack_first(histogram, max_tokens))
    places = spark.createDataFrame(pa.table(
        {c: pa.array([x[k] for x in found], pa.int64()) for k, c in enumerate(("length", "first", "stop", "sequence", "offset"))}))
    # Its size is bounded by max_tokens, not by the documents: patterns are
    # split at most once per distinct length and open pattern.
    return (ranked.join(F.broadcast(places), "length").where("rank >= first and rank < stop")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset"))
