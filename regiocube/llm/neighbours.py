"""Approximate nearest neighbours: an adaptive dimension scan of probed lists.

Vectors are lengthened by one coordinate so that the largest inner product is
the smallest distance, assigned to the lists of a coarse k-means, and rotated at
random. A query probes its nearest lists. Within a list the scan goes through
blocks of columns: after each block a hypothesis test compares the partial
distance, scaled to all columns, with the query's bar; candidates that are
significantly farther are abandoned. Survivors get their exact inner product,
in double precision over the original vectors.

The centres, how many lists a query probes, and the bar of each query (the
distance of its ``k``-th nearest in the sample, so at least ``k`` vectors are as
near) come from at most ``SAMPLE_ROWS`` vectors drawn by a hash of their id; every
vector is indexed. The bar stands at ``BAR`` times ``k``, so that the probed lists hold
``k`` within it although they miss some; a query that still finds fewer than ``k`` is
searched again in all lists without a bar. A list is dealt in blocks of bounded size against blocks of the queries that
probe it, so a list with very many vectors, or one that very many queries
probe, is the work of many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiocube.llm.common import map_arrow, stored

SAMPLE_ROWS = 20_000
#: Vectors per list, about (lists are at most MOST_LISTS), and per block of a list.
LIST_ROWS = 1024
MOST_LISTS = 4096
BLOCK_ROWS = 4096
#: Queries in a block, and columns in a block of the scan.
BLOCK_QUERIES = 512
COLUMNS = 32
#: Share of the true neighbours that the probed lists must hold, on the sample.
TARGET = 0.97
#: Sharpness of the test: a larger value abandons fewer candidates wrongly.
EPSILON = 2.1
#: The bar is the distance of the (BAR * k)-th nearest sampled vector.
BAR = 3
#: Share of pairs still alive below which the scan goes on pair by pair.
SPARSE = 0.2
SEED = 5


@dataclass
class Index:
    """What the sample fits: the longest norm, the rotation, the centres and the probes."""

    longest: float
    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    sample_ids: np.ndarray
    sample: np.ndarray  # lengthened

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest ** 2 - np.einsum("ij,ij->i", x, x), 0))
        return np.hstack([x, rest[:, None]])

    def as_query(self, x: np.ndarray) -> np.ndarray:
        """Queries at the common length: only their direction decides the order."""
        norms = np.linalg.norm(x, axis=1, keepdims=True)
        return np.hstack([x * (self.longest / np.where(norms > 0, norms, 1)), np.zeros((len(x), 1))])

    def bars(self, ids: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
        """The k-th smallest squared distance from each query to a sampled vector of another id."""
        out = np.full(len(y), np.inf)
        norms = (self.sample ** 2).sum(1)
        for i in range(0, len(y) if len(norms) > k else 0, 64):
            part = y[i:i + 64]
            far = (part ** 2).sum(1)[:, None] + norms - 2 * part @ self.sample.T
            far[ids[i:i + 64, None] == self.sample_ids] = np.inf
            out[i:i + 64] = np.partition(far, k - 1, axis=1)[:, k - 1]
        return out

    def nearest_lists(self, y: np.ndarray, n: int) -> np.ndarray:
        far = (self.centres ** 2).sum(1) - 2 * y @ self.centres.T
        return np.argsort(far, axis=1, kind="stable")[:, :n]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>, norm) of the rows that take part.

    Left out: a null id or vector, null or non-finite components, zero vectors,
    and lengths other than the commonest one (the longer of equally common ones).
    """
    v = F.col("v")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.where(good).withColumn("norm", F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))).where("norm > 0")
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).first()
    return rows.where(F.size("v") == (common["d"] if common else 0))


def _centres(x: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Lloyd's k-means; an empty list takes the point that lies farthest from its centre."""
    centres = x[rng.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        far = (centres ** 2).sum(1) - 2 * x @ centres.T
        own = far.argmin(axis=1)
        counts = np.bincount(own, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        empty = np.flatnonzero(counts == 0)
        if len(empty):
            centres[empty] = x[np.argsort(-far[np.arange(len(x)), own], kind="stable")[:len(empty)]]
    return centres


def fit(rows: DataFrame, k: int, sample_rows: int = SAMPLE_ROWS, target: float = TARGET) -> Index | None:
    """The index of ``usable`` rows; None for an empty table."""
    known = rows.agg(F.count("*").alias("n"), F.max("norm").alias("m")).first()
    if not known["n"]:
        return None
    share = min(1.0, 0.9 * sample_rows / known["n"])
    draw = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30))
    # Equal vectors add nothing to a clustering, and would hide how far the others lie.
    some = rows.select("vec_id", "v").where(draw).limit(sample_rows).toArrow()
    if not some.num_rows:
        some = rows.select("vec_id", "v").limit(1).toArrow()
    drawn = _matrix(some["v"])
    rng = np.random.default_rng(SEED)
    d = drawn.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    index = Index(float(known["m"]), rotation, np.zeros((1, d)), 1, some["vec_id"].to_numpy(), drawn)
    index.sample = index.lengthened(drawn)
    points = np.unique(index.sample, axis=0)
    index.centres = _centres(points, max(1, min(MOST_LISTS, known["n"] // LIST_ROWS, len(points) // 4)), rng)
    index.probes = _probes(index, points, k, share, target)
    return index


def _probes(index: Index, points: np.ndarray, k: int, share: float, target: float) -> int:
    """The fewest lists that hold ``target`` of the sampled queries' neighbours among the sampled vectors."""
    lists = len(index.centres)
    if lists == 1 or len(points) < 3:
        return lists
    asked = points[::max(1, len(points) // 256)]
    queries = index.as_query(asked[:, :-1])
    near = np.argsort(-(queries @ points.T), axis=1, kind="stable")[:, :max(2, min(len(points), round(k * share) + 1))]
    own = index.nearest_lists(points, 1)[:, 0]
    order = index.nearest_lists(queries, lists)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(lists), order.shape), axis=1)
    needed = np.take_along_axis(place, own[near], axis=1).ravel()
    return int(min(lists, np.quantile(needed, target, method="higher") + 1))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long vectors without nulls as a matrix."""
    flat = pc.list_flatten(column).to_numpy()
    return np.asarray(flat, np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _deal(index: Index):
    """Batches of (vec_id, v) with the list of each."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                lists = index.nearest_lists(index.lengthened(_matrix(b.column(1))), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lists.astype(np.int64))], names=["vec_id", "v", "list"])
    return run


def _probe(index: Index, probes: int, k: int | None):
    """Batches of queries (vec_id, v) with the bar (infinite without ``k``) and, in a row each, the lists that they probe."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                y = index.as_query(_matrix(b.column(1)))
                lists = index.nearest_lists(y, probes)
                again = pa.array(np.repeat(np.arange(b.num_rows), lists.shape[1]))
                bars = pa.array(np.full(len(y), np.inf) if k is None else index.bars(b.column(0).to_numpy(), y, BAR * k))
                yield pa.RecordBatch.from_arrays([b.column(0).take(again), b.column(1).take(again), bars.take(again),
                                                  pa.array(lists.ravel().astype(np.int64))], names=["vec_id", "v", "bar", "list"])
    return run


def scan(queries: np.ndarray, points: np.ndarray, bar: np.ndarray, columns: int = COLUMNS,
         epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) that survive the adaptive scan of rotated ``points``.

    After each block of d of D columns a pair stays if its partial distance is at
    most d / D * (1 + epsilon / sqrt(d)) ** 2 times the query's bar: for a random
    rotation, a point within the bar fails that test with a probability that
    falls exponentially with epsilon squared. After the last block the test is
    exact. While many pairs are alive a block is one matrix product; once
    few are left, the scan goes on with those alone.
    """
    none = np.zeros(0, np.int64)
    if not len(points) or not len(queries):
        return none, none
    width = points.shape[1]
    q = p = None
    so_far = np.zeros((len(queries), len(points)))
    for start in range(0, width, columns):
        part = slice(start, min(start + columns, width))
        most = _slack(part.stop, width, epsilon) * bar + 1e-9 * np.where(np.isfinite(bar), bar, 0) + 1e-12
        if q is None:
            a, b = queries[:, part], points[:, part]
            so_far += (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
            stays = so_far <= most[:, None]
            if part.stop == width or stays.mean() < SPARSE:
                q, p = np.nonzero(stays)
                so_far = so_far[q, p]
            else:
                so_far[~stays] = np.inf
        else:
            so_far = so_far + ((points[p, part] - queries[q, part]) ** 2).sum(1)
            stays = so_far <= most[q]
            q, p, so_far = q[stays], p[stays], so_far[stays]
    return q, p


def _slack(done: int, width: int, epsilon: float) -> float:
    return 1.0 if done >= width else min(1.0, done / width * (1 + epsilon / np.sqrt(done)) ** 2)


def _search(index: Index, k: int):
    """A block of a list against a block of the queries that probe it -> each query's k best in it."""
    def run(found: pa.Table, asked: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not found.num_rows or not asked.num_rows:
            return empty
        x, y = _matrix(found["v"]), _matrix(asked["v"])
        ids, who, bar = found["vec_id"].to_numpy(), asked["vec_id"].to_numpy(), asked["bar"].to_numpy()
        rotated, rotated_queries = index.lengthened(x) @ index.rotation, index.as_query(y) @ index.rotation
        out = []
        for s in range(0, len(y), 16):
            q, p = scan(rotated_queries[s:s + 16], rotated, bar[s:s + 16])
            q = q + s
            other = ids[p] != who[q]
            q, p = q[other], p[other]
            score = (x[p] * y[q]).sum(axis=1)
            order = np.lexsort((ids[p], -score, q))
            q, p, score = q[order], p[order], score[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
            best = rank < k
            out.append((who[q[best]], ids[p[best]], score[best]))
        return pa.table({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("query_id", "vec_id", "score"))}).cast(empty.schema)
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            sample_rows: int = SAMPLE_ROWS, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the largest inner product found for each query.

    ``queries`` are rows like those of ``vectors``; a query is never its own neighbour (by id).

    - vectors that take no part, as candidates or queries: see ``usable``;
    - fewer candidates than k: all of them;
    - equal scores: smaller id first; equal vectors have equal scores;
    - rows that repeat an id: candidates each, hence possibly found twice; as a query an id
      is answered once, for the least of its vectors;
    - empty table: empty result; other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_col, vector_col), "vectors")
    asked = usable(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    index = fit(rows, k, sample_rows, target)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = "vec_id long, v array<double>, list long"
    probed = kind.replace("list", "bar double, list")
    listed = stored(map_arrow(rows.select("vec_id", "v"), _deal(index), kind), "lists")
    fitting = asked.select("vec_id", "v").where(F.size("v") == index.rotation.shape[0] - 1)
    probing = stored(map_arrow(fitting, _probe(index, index.probes, k), probed), "probes")
    found = stored(_best(index, listed, probing, k), "found")
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, rows.count() - 1))
    short = stored(fitting.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
    if short.isEmpty():
        return found
    again = stored(map_arrow(short, _probe(index, len(index.centres), None), probed), "probes-again")
    whole = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti")
    return whole.select(found.columns).union(_best(index, listed, again, k))


def _best(index: Index, listed: DataFrame, probing: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best in the lists that it probes, within its bar."""
    index = replace(index, sample=np.zeros((0, 0)), sample_ids=np.zeros(0))  # the scan needs the bars alone
    sizes = (listed.groupBy("list").agg(F.count("*").alias("n"))
             .join(probing.groupBy("list").agg(F.count("*").alias("m")), "list")
             .select("list", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"),
                     F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("query_blocks")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    # list sizes: one row per list, at most MOST_LISTS
    sizes = F.broadcast(sizes)
    left = listed.join(sizes, "list").withColumn("block", one("blocks")).withColumn("query_block", every("query_blocks"))
    right = probing.join(sizes, "list").withColumn("query_block", one("query_blocks")).withColumn("block", every("blocks"))
    keys = ["list", "block", "query_block"]
    found = (left.select("vec_id", "v", *keys).groupBy(*keys).cogroup(right.select("vec_id", "v", "bar", *keys).groupBy(*keys))
             .applyInArrow(_search(index, k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
