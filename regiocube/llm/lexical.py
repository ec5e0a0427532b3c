"""Ranked lexical search: hybrid of term-at-a-time and document-at-a-time.

The documents are dealt to segments (about ``SEGMENT_BYTES`` of text each), and each
segment is inverted for the queries' terms alone; Spark sums the segments' document
frequencies and lengths. Then every segment answers every query:

- the query's short lists are summed term by term into accumulators;
- the accumulators then are one iterator beside the long lists, each with the greatest
  score of every block of ``BLOCK`` documents;
- a block whose bounds do not add up to the bar (the score of the k-th best so far) is
  skipped; in the others, the long lists are looked up in falling order of their bounds, and
  documents drop out once their score and the bounds left stay below the bar.

A task keeps the k best of a query over all its segments, so the bar rises as it goes on,
and hands on k rows per query; Spark merges them in two rounds.

Queries come in blocks of about ``QUERY_BYTES`` of text, each of which passes over all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiocube.llm.common import map_arrow, parts, stored, text_bytes

TOP = 50
#: Text (and documents) of a segment, the unit of memory.
SEGMENT_BYTES = 8 << 20
SEGMENT_DOCS = 8192
#: Documents under one bound.
BLOCK = 64
#: A list is short if it holds at most this share of a segment's documents.
SHORT_SHARE = 1 / 16
#: Bytes of the queries whose terms a task holds at once.
QUERY_BYTES = 4 << 20
#: Partial results are merged in so many lots first.
LOTS = 64
_PIECE = 1 << 20

# Letters and digits of ASCII (A-Z lower-cased) and all other bytes of UTF-8 make terms; the rest separates them.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def term_counts(text: bytes) -> tuple[int, Counter]:
    """Terms with repeats, and how often each occurs; long texts go piece by piece."""
    data = text.translate(_FOLD)
    total, counts, at = 0, Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + _PIECE) if len(data) - at > _PIECE else -1
        words = data[at:end if end >= 0 else len(data)].split()
        total += len(words)
        counts.update(words)
        at = end if end >= 0 else len(data)
    return total, counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


_SEGMENT = "docs array<long>, lengths array<long>, terms array<int>, ends array<long>, places array<int>, tfs array<long>"


def _inverted(vocabulary: dict[bytes, int]):
    """Documents -> segments: doc_ids and lengths of the documents, and one list of (place, tf) per known term."""
    known = vocabulary.keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, lengths, held, size = [], [], [], 0

        def segment() -> pa.RecordBatch:
            terms = np.concatenate([h[0] for h in held] or [np.zeros(0, np.int64)])
            tfs = np.concatenate([h[1] for h in held] or [np.zeros(0, np.int64)])
            places = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
            order = np.argsort(terms, kind="stable")
            of, starts = np.unique(terms[order], return_index=True)
            ends = np.r_[starts[1:], len(terms)] if len(of) else starts
            cells = [pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                     pa.array([of.astype(np.int32)], pa.list_(pa.int32())), pa.array([ends], pa.list_(pa.int64())),
                     pa.array([places[order].astype(np.int32)], pa.list_(pa.int32())), pa.array([tfs[order]], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(cells, names=["docs", "lengths", "terms", "ends", "places", "tfs"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                data = (text.as_buffer().to_pybytes() if text.is_valid else b"")
                total, counts = term_counts(data)
                if not total:
                    continue
                mine = [t for t in counts if t in vocabulary] if len(counts) <= len(known) else list(known & counts.keys())
                docs.append(doc)
                lengths.append(total)
                held.append((np.array([vocabulary[t] for t in mine], np.int64), np.array([counts[t] for t in mine], np.int64)))
                size += len(data)
                if size >= SEGMENT_BYTES or len(docs) >= SEGMENT_DOCS:
                    yield segment()
                    docs, lengths, held, size = [], [], [], 0
        if docs:
            yield segment()
    return run


class Segment:
    """One segment with the scores of its postings and their bounds per block of documents."""

    def __init__(self, docs: list, lengths: np.ndarray, terms: np.ndarray, ends: np.ndarray, places: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, n_docs: int, n_terms: int):
        self.size = len(docs)
        #: Null ids after all others.
        self.ids = np.array([0 if d is None else d for d in docs], np.int64)
        self.no_id = np.array([d is None for d in docs], bool)
        m = np.array([100 - 50 + (50 * int(n) * n_docs) // n_terms for n in lengths], np.int64)
        starts = np.r_[0, ends[:-1]].astype(np.int64) if len(ends) else ends
        score = np.repeat(weights[terms], ends - starts) * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[places]))
        self.lists = {int(t): (places[a:e], score[a:e]) for t, a, e in zip(terms, starts, ends)}
        self.bounds: dict[int, np.ndarray] = {}

    def blocks_of(self, places: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """The greatest score per block of documents."""
        out = np.zeros(-(-self.size // BLOCK), np.int64)
        if len(places):
            block = places // BLOCK
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            out[block[first]] = np.maximum.reduceat(scores, first)
        return out

    def bound(self, term: int) -> np.ndarray:
        if term not in self.bounds:
            self.bounds[term] = self.blocks_of(*self.lists[term])
        return self.bounds[term]

    def search(self, terms: list[int], bar: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of all documents whose score is at least ``bar`` (1 or more)."""
        mine = [t for t in terms if t in self.lists]
        most = max(1, int(self.size * SHORT_SHARE))
        long = sorted((t for t in mine if len(self.lists[t][0]) > most), key=lambda t: -int(self.bound(t).max()))
        summed = np.zeros(self.size, np.int64)
        for t in mine:
            if len(self.lists[t][0]) <= most:
                places, scores = self.lists[t]
                summed[places] += scores
        touched = np.flatnonzero(summed)
        blocks = self.blocks_of(touched, summed[touched])
        for t in long:
            blocks = blocks + self.bound(t)
        live = np.flatnonzero(blocks >= bar)
        at = (live[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < self.size]
        score = summed[at]
        # What the long lists from here on can add, per block.
        left = sum((self.bound(t) for t in long), np.zeros(len(blocks), np.int64))
        keep = score + left[at // BLOCK] >= bar
        at, score = at[keep], score[keep]
        for t in long:
            places, scores = self.lists[t]
            i = np.searchsorted(places, at)
            i[i == len(places)] = 0
            score = score + np.where(places[i] == at, scores[i], 0)
            left = left - self.bound(t)
            keep = score + left[at // BLOCK] >= bar
            at, score = at[keep], score[keep]
        return at, score


def _searched(queries: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """Segments -> the ``top`` best documents of each query in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none.astype(bool), none) for _ in queries]  # ids, no id, scores; best first
        for b in batches:
            for i in range(b.num_rows):
                docs = b.column(0)[i].as_py()
                lengths, terms, ends, places, tfs = (b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(1, 6))
                s = Segment(docs, lengths, terms, ends, places, tfs, weights, n_docs, n_terms)
                for q, wanted in enumerate(queries):
                    ids, no_id, scores = best[q]
                    at, found = s.search(wanted, int(scores[-1]) if len(scores) == top else 1)
                    if len(at):
                        ids, no_id, scores = np.r_[ids, s.ids[at]], np.r_[no_id, s.no_id[at]], np.r_[scores, found]
                        order = np.lexsort((ids, no_id, -scores))[:top]
                        best[q] = ids[order], no_id[order], scores[order]
        counts = [len(x[0]) for x in best]
        ids, no_id, scores = (np.concatenate([x[k] for x in best]) if best else none for k in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), counts), pa.int64()), pa.array(ids, pa.int64(), mask=no_id.astype(bool)),
             pa.array(scores, pa.int64())], names=["query", "doc_id", "score"])
    return run


def _block_search(docs: DataFrame, items: list, top: int) -> DataFrame | None:
    """The best documents of some items, of which the driver holds the texts."""
    found = [term_counts((r["text"] or "").encode("utf-8", "surrogatepass"))[1] for r in items]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*found)))} if found else {}
    if not vocabulary:
        return None
    spark = docs.sparkSession
    segments = stored(map_arrow(docs.select("doc_id", "text"), _inverted(vocabulary), _SEGMENT), "segments")
    total = segments.agg(F.sum(F.size("docs").cast("long")).alias("n"),
                         F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")).first()
    if not total["n"]:
        return None
    # Lists of a segment: term, and how many documents it has there.
    sizes = F.transform("ends", lambda e, i: e - F.when(i == 0, 0).otherwise(F.col("ends")[i - 1]))
    lists = segments.select(F.explode(F.arrays_zip(F.col("terms").alias("term"), sizes.alias("df"))).alias("x")).select("x.*")
    df = lists.groupBy("term").agg(F.sum("df").alias("df")).toPandas()  # a row per term of the block
    weights = np.zeros(len(vocabulary), np.int64)
    weights[df["term"].to_numpy(np.int64)] = [weight(int(total["n"]), int(n)) for n in df["df"]]
    queries = [[vocabulary[t] for t in terms] for terms in found]
    best = map_arrow(segments, _searched(queries, weights, int(total["n"]), int(total["l"]), top), "query long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    lots = Window.partitionBy("query", "lot").orderBy(*order)
    merged = (best.withColumn("lot", F.pmod(F.spark_partition_id(), F.lit(LOTS)))
              .withColumn("place", F.row_number().over(lots)).where(F.col("place") <= top).drop("lot", "place"))
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
    names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(items)], "query long, item_id long")
    return ranked.join(names, "query").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item's terms, of score above 0.

    Terms are maximal runs of letters and digits (ASCII, A-Z lower-cased) and of all characters beyond ASCII.
    A document's score is the sum, over the item's different terms, of
    w * ((10**9 * tf) div (1000 * tf + 20 * m)) with w = floor(1000 * ln((2 N + 2) / (2 df + 1))) and
    m = 100 - 50 + ((50 * n * N) div L).

    - null, empty or term-free texts: such a document is not counted and not found, such an item has no rows;
    - ties: smaller doc_id first, null ids last; repeated rows: documents each; repeated item rows: items each;
    - fewer documents than ``top``: all; empty tables: empty result; very long texts: whole, in pieces;
    - other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = parts(text_bytes(items), QUERY_BYTES)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    # A block's texts are about QUERY_BYTES, however many the items are.
    found = [_block_search(docs, dealt.where(F.col("block") == k).collect(), top) for k in range(blocks)]
    found = [f for f in found if f is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
