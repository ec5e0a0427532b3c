"""Exact substring dedup: Rabin-Karp hashes of every window of ``WINDOW`` words, and the words of those that repeat.

Documents are dealt to batches that are disjoint, ordered ranges of doc_id, of like bytes.

1. A batch hashes every window of its texts and sends its distinct hashes, sorted, in one
   blob per hash bucket (4 bytes a window: the rest of the hash is the bucket's number).
2. A bucket counts in how many batches each hash is and tells those batches if it is in several.
3. For the windows so found, a batch sends a 128-bit digest of the words themselves. Digests
   meet in buckets again, and a batch is told which of its digests a smaller batch has.
4. With that, and with its own documents in order, a batch knows of every window whether its
   words also start in a document with a smaller doc_id; windows that overlap or touch
   merge into maximal removal intervals.

So a hash only finds candidates: windows of equal hash and different words cost a digest
more, and are never taken for equal. Equality is that of 128 bits of BLAKE2 over the words,
of which no two different inputs with equal digests are known.

A passage, however frequent, is one hash and one digest per batch, so no bucket, batch or
key grows with the copies of one passage. Texts are moved once; of a window 4 bytes move, and
of a repeated one 16 more. Counting goes over sorted blobs instead of a row per window, since
a row costs several times its hash; Spark deals, shuffles and retries the blobs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocube.llm.common import WORD_PATTERN, parts, ship

WINDOW = 13
#: Bytes of text in a batch, and windows in a bucket: the memory of one task.
BATCH_BYTES = 4 << 20
BUCKET_WINDOWS = 1_000_000
#: Points of the doc_id distribution that balance the batches (no effect on results).
KNOTS = 128
#: Bytes hashed in one piece; a longer text is hashed piece by piece.
_PIECE = 1 << 20

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bytes of a digest of a window's words.
_DIGEST = 16
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the byte base and of its inverse, made once per worker."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = np.uint64(pow(int(_BYTE_BASE), -1, 1 << 64))
            cls.up, cls.down = _powers(_BYTE_BASE, n), _powers(inverse, n)
        return cls.up[:n], cls.down[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends): a 64-bit hash and the extent of each word (run of bytes other than ASCII white space)."""
    out: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data) and not _SPACE[data[end]]:  # a piece ends between words
            end += 1
        b = np.frombuffer(data, np.uint8, end - at, at)
        inside = np.zeros(len(b) + 2, np.int8)
        inside[1:-1] = ~_SPACE[b]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(starts):
            up, down = _Tables.get(len(b))
            total = np.empty(len(b) + 1, np.uint64)
            total[0] = 0
            np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
            out.append((_mixed((total[ends] - total[starts]) * down[starts]), starts + at, ends + at))
        at = end
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))  # type: ignore[return-value]


def word_hashes(data: bytes) -> np.ndarray:
    return words_of(data)[0]


def window_hashes(words: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The rolling polynomial of every ``window`` consecutive word hashes."""
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h *= _WORD_BASE
        h += words[k:k + n]
    return _mixed(h)


#: Word hashes and the window's words -> a 64-bit hash per window.
Hashed = Callable[[np.ndarray, int], np.ndarray]


class _Batch:
    """The documents of a batch by doc_id, and the keys of all their windows in order."""

    def __init__(self, docs: pa.Table, window: int, buckets: int, hashed: Hashed):
        self.docs = docs.take(pc.sort_indices(docs, sort_keys=[("doc_id", "ascending")]))
        self.ids = self.docs["doc_id"].to_numpy()
        self.texts = [(t or "").encode("utf-8", "surrogatepass") for t in self.docs["text"].to_pylist()]
        self.window, self.buckets = window, buckets
        self.extents, keys = [], []
        for t in self.texts:
            hashes, starts, ends = words_of(t)
            self.extents.append((starts, ends))
            keys.append(hashed(hashes, window))
        self.counts = np.array([len(k) for k in keys], np.int64)
        hashes = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        # A key is the bucket (equal ranges of the upper half of the hash) and the lower half.
        self.keys = (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)

    def found(self, told: pa.Table) -> np.ndarray:
        """Which windows have a key that other batches hold too."""
        blobs = zip(told["bucket"].to_pylist(), told["blob"].to_pylist())
        flagged = [np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(k << 32) for k, x in blobs]
        if not flagged:
            return np.zeros(len(self.keys), bool)
        known = np.sort(np.concatenate(flagged))
        at = np.searchsorted(known, self.keys)
        at[at == len(known)] = 0
        return known[at] == self.keys

    def repeated_here(self) -> np.ndarray:
        """Which windows have a key that another window of the batch has too."""
        order = np.argsort(self.keys, kind="stable")
        same = np.diff(self.keys[order]) == 0
        out = np.zeros(len(self.keys), bool)
        out[order[1:]] |= same
        out[order[:-1]] |= same
        return out

    def digests(self, wanted: np.ndarray) -> np.ndarray:
        """(n, 2) big-endian halves of the digests of the wanted windows' words, joined by one space."""
        out = []
        at = 0
        for text, (starts, ends), n in zip(self.texts, self.extents, self.counts.tolist()):
            mine = np.flatnonzero(wanted[at:at + n])
            at += n
            if not len(mine):
                continue
            # Runs of consecutive windows: their words are joined once.
            cuts = np.flatnonzero(np.diff(mine) > 1) + 1
            for run in np.split(mine, cuts):
                a, b = int(run[0]), int(run[-1]) + self.window
                joined = b" ".join(text[starts[a]:ends[b - 1]].split())
                offset = np.r_[0, np.cumsum(ends[a:b] - starts[a:b] + 1)].tolist()
                w = self.window
                out += [hashlib.blake2b(joined[offset[i]:offset[i + w] - 1], digest_size=_DIGEST).digest() for i in range(len(run))]
        return np.frombuffer(b"".join(out), ">u8").reshape(-1, 2).astype(np.uint64)


def _distinct(digests: np.ndarray) -> np.ndarray:
    digests = digests[np.lexsort((digests[:, 1], digests[:, 0]))]
    return digests[np.r_[True, (digests[1:] != digests[:-1]).any(axis=1)]] if len(digests) else digests


def _blobs(bucket: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Rows in order of their bucket, cut into one blob per bucket."""
    if not len(rows):
        return [], []
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return bucket[np.r_[0, cuts]].tolist(), [x.tobytes() for x in np.split(rows, cuts)]


def _table(batch: list[int], bucket: list[int], blob: list[bytes]) -> pa.Table:
    return pa.table({"batch": pa.array(batch, pa.int64()), "bucket": pa.array(bucket, pa.int64()), "blob": pa.array(blob, pa.binary())})


_SENT = "batch long, bucket long, blob binary"


def _send_keys(window: int, buckets: int, hashed: Hashed):
    """Batch -> (batch, bucket, blob of the distinct keys in that bucket)."""
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        distinct = np.unique(_Batch(docs, window, buckets, hashed).keys)
        names, blobs = _blobs((distinct >> np.uint64(32)).astype(np.int64), distinct.astype(np.uint32))
        return _table([key[0].as_py()] * len(blobs), names, blobs)
    return run


def _in_several(rows: pa.Table) -> pa.Table:
    """Bucket of keys -> for each batch those of its keys that are in several batches."""
    blobs = [np.frombuffer(x, np.uint32) for x in rows["blob"].to_pylist()]
    keys = np.concatenate(blobs)
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    several = np.zeros(len(keys), bool)
    several[order[1:]] |= same
    several[order[:-1]] |= same
    masks = np.split(several, np.cumsum([len(x) for x in blobs])[:-1])
    found = [(b, k, x[m].tobytes()) for b, k, x, m in zip(rows["batch"].to_pylist(), rows["bucket"].to_pylist(), blobs, masks) if m.any()]
    return _table(*map(list, zip(*found))) if found else _table([], [], [])


def _digest_bucket(digests: np.ndarray, buckets: int) -> np.ndarray:
    return ((digests[:, 0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _send_digests(window: int, buckets: int, hashed: Hashed):
    """Batch, and its keys in several batches -> (batch, bucket, blob of the distinct digests of their words)."""
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, told: pa.Table) -> pa.Table:
        if not told.num_rows or not docs.num_rows:
            return _table([], [], [])
        batch = _Batch(docs, window, buckets, hashed)
        distinct = _distinct(batch.digests(batch.found(told)))
        names, blobs = _blobs(_digest_bucket(distinct, buckets), distinct)
        return _table([key[0].as_py()] * len(blobs), names, blobs)
    return run


def _in_smaller(rows: pa.Table) -> pa.Table:
    """Bucket of digests -> for each batch the places of those of its digests that a smaller batch holds."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("batch", "ascending")]))
    blobs = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in rows["blob"].to_pylist()]
    digests = np.concatenate(blobs)
    order = np.lexsort((digests[:, 1], digests[:, 0]))  # stable: smaller batches first
    ordered = digests[order]
    again = np.zeros(len(digests), bool)
    again[order[1:]] = (ordered[1:] == ordered[:-1]).all(axis=1)
    masks = np.split(again, np.cumsum([len(x) for x in blobs])[:-1])
    found = [(b, k, np.flatnonzero(m).astype(np.uint32).tobytes())
             for b, k, m in zip(rows["batch"].to_pylist(), rows["bucket"].to_pylist(), masks) if m.any()]
    return _table(*map(list, zip(*found))) if found else _table([], [], [])


def _covered(again: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Which words the repeated windows of one document cover."""
    step = np.zeros(n_words + 1, np.int32)
    step[:len(again)] += again
    step[window:window + len(again)] -= again
    return np.cumsum(step[:n_words]) > 0


def _intervals(covered: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.r_[0, covered.astype(np.int8), 0])
    return [{"start": int(a), "stop": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _repeated(batch: _Batch, told: pa.Table) -> np.ndarray:
    """Which windows' words also start in a document with a smaller doc_id, in this batch or a smaller one."""
    keys = told.filter(pc.field("kind") == _KEYS)
    found = batch.found(keys)
    here = batch.repeated_here()
    some = found | here
    out = np.zeros(len(some), bool)
    if not some.any():
        return out
    digests = batch.digests(some)
    # The places refer to the digests that this batch has sent, by bucket.
    sent = _distinct(digests[found[some]])
    begins = np.searchsorted(_digest_bucket(sent, batch.buckets), np.arange(batch.buckets)) if len(sent) else []
    places = told.filter(pc.field("kind") == _PLACES)
    outside = np.zeros(len(sent), bool)
    for k, blob in zip(places["bucket"].to_pylist(), places["blob"].to_pylist()):
        outside[begins[k] + np.frombuffer(blob, np.uint32)] = True
    # Equal digests in order of their documents: the first is the smallest.
    owner = np.repeat(batch.ids, batch.counts)[some]
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    group = np.cumsum(np.r_[0, (ordered[1:] != ordered[:-1]).any(axis=1)]) if len(ordered) else np.zeros(0, np.int64)
    first = owner[order][np.searchsorted(group, np.arange(group[-1] + 1))]
    again = np.zeros(len(digests), bool)
    again[order] = first[group] < owner[order]
    if outside.any():
        known = sent[outside]
        both = np.concatenate([known, digests])
        rank = np.lexsort((both[:, 1], both[:, 0]))  # stable: a known digest comes before its equals
        new = np.r_[True, (both[rank][1:] != both[rank][:-1]).any(axis=1)]
        of_known = (rank < len(known))[np.maximum.accumulate(np.where(new, np.arange(len(rank)), 0))]
        held = np.zeros(len(both), bool)
        held[rank] = of_known
        again |= held[len(known):]
    out[some] = again
    return out


_KEYS, _PLACES = 0, 1


def _cut(window: int, buckets: int, hashed: Hashed, digest: bool, with_text: bool):
    """A batch and what it was told -> its documents without the repeated words."""
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        batch = _Batch(docs, window, buckets, hashed)
        again = _repeated(batch, told)
        n_words, kept, removed, gone = [], [], [], []
        at = 0
        for text, (starts, _), m in zip(batch.texts, batch.extents, batch.counts.tolist()):
            words, n = text.split(), len(starts)
            mine = again[at:at + m]
            at += m
            if mine.any():
                covered = _covered(mine, n, window)
                words = list(compress(words, (~covered).tolist()))
                removed.append(_intervals(covered))
            else:
                removed.append([])
            n_words.append(n)
            gone.append(n - len(words))
            kept.append(b" ".join(words))
        texts_out = [hashlib.sha256(k).hexdigest() if digest else k.decode("utf-8", "surrogatepass") for k in kept]
        carried = {"text": batch.docs["text"]} if with_text else {}
        return pa.table({"row": batch.docs["row"], **carried, "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                         "kept": pa.array(texts_out, pa.string()), "removed": pa.array(removed, _SPANS)})
    return run


def _batch(docs: DataFrame, batches: int) -> Column:
    """An order-preserving map of doc_id to ranges of like bytes, about ``batches`` of them.

    The distribution of doc_id gives KNOTS ranges of like rows; each is cut evenly
    into as many pieces as its share of the bytes asks for.
    """
    points = [k / KNOTS for k in range(KNOTS)]
    knots = docs.agg(F.percentile_approx("doc_id", points, 10_000).alias("k"), F.max("doc_id").alias("m")).first()
    if knots["k"] is None:
        return F.lit(0).cast("long")
    at = sorted(set(knots["k"]))
    ends = [*at[1:], min(knots["m"] + 1, (1 << 63) - 1)]
    lows = F.array(*[F.lit(a).cast("long") for a in at])
    i = F.greatest(F.size(F.filter(lows, lambda a: a <= F.col("doc_id"))), F.lit(1))
    sizes = {r["i"]: r["n"] or 0 for r in docs.groupBy(i.alias("i")).agg(F.sum(F.octet_length("text").cast("long")).alias("n")).collect()}
    total = max(1, sum(sizes.values()))
    each = [max(1, -(-batches * sizes.get(k, 0) // total)) for k in range(1, len(at) + 1)]
    begins = [sum(each[:k]) for k in range(len(each))]
    ranges = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"), F.lit(n).cast("long").alias("n"),
                                F.lit(first).cast("long").alias("first")) for a, b, n, first in zip(at, ends, each, begins)])
    r = F.element_at(ranges, i)
    share = F.try_divide(F.col("doc_id").cast("double") - r["a"], r["b"].cast("double") - r["a"])
    inner = F.coalesce(F.floor(share * r["n"]), F.lit(0))
    return (r["first"] + F.least(F.greatest(inner, F.lit(0)), r["n"] - 1)).cast("long")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, keep: Sequence[str] = ("doc_id",),
                     digest: bool = False, hashed: Hashed = window_hashes) -> DataFrame:
    """Remove every word that a window covers whose words also start in a document with a smaller doc_id.

    Returns per row of ``docs``: struct ``row`` of its columns ``keep``, n_words,
    n_removed, kept (the other words joined by one space) and removed, the maximal
    removal intervals as word positions [start, stop). With ``digest`` kept is
    the lowercase hex SHA-256 of the kept text. ``hashed`` is the rolling hash that finds
    candidates; any function of a window's word hashes gives the same result.

    - null or empty text, or white space alone: no words, nothing removed, kept empty;
    - fewer words than ``window``: nothing removed;
    - repeated rows: a row with the same doc_id is not a smaller one, so
      neither loses words to the other;
    - null doc_id: neither smaller nor larger than any; whole text kept;
    - empty table: empty result; clashing column names stay inside ``row``.
    """
    ship(docs.sparkSession)
    # The text moves once, beside the other columns.
    with_text = "text" in keep
    other = [F.col(f"`{c}`") for c in keep if c != "text"] or [F.lit(None).cast("int").alias("none")]
    own = docs.select(F.struct(*other).alias("row"),
                      F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = own.where("doc_id is not null")
    size = known.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    dealt = known.withColumn("batch", _batch(known, parts(size, BATCH_BYTES)))
    # Six bytes a word at least in prose; more buckets than needed do no harm.
    buckets = parts(size // 6, BUCKET_WINDOWS)
    batches = dealt.groupBy("batch")
    sent = batches.applyInArrow(_send_keys(window, buckets, hashed), _SENT)
    # Used twice, by the digests' senders and at the end; one plan, so texts and keys are shuffled once.
    told = sent.groupBy("bucket").applyInArrow(_in_several, _SENT)
    digests = batches.cogroup(told.groupBy("batch")).applyInArrow(_send_digests(window, buckets, hashed), _SENT)
    places = digests.groupBy("bucket").applyInArrow(_in_smaller, _SENT)
    back = told.withColumn("kind", F.lit(_KEYS)).union(places.withColumn("kind", F.lit(_PLACES)))
    spans = "array<struct<start: long, stop: long>>"
    result = T.StructType([own.schema["row"], *([own.schema["text"]] if with_text else []), *T._parse_datatype_string(
        f"n_words long, n_removed long, kept string, removed {spans}").fields])
    done = batches.cogroup(back.groupBy("batch")).applyInArrow(_cut(window, buckets, hashed, digest, with_text), result)
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD_PATTERN})"), F.lit(1))
    kept = F.array_join(words, " ")
    whole = own.where("doc_id is null").select(
        "row", *(["text"] if with_text else []), F.size(words).cast("long"), F.lit(0).cast("long"), F.sha2(kept, 256) if digest else kept, F.array().cast(spans))
    back = F.struct(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in keep]).alias("row")
    return done.union(whole).select(back, "n_words", "n_removed", "kept", "removed")
