"""SimHash near-duplicates: segment-popcount embedding and a grid range-join.

Fingerprint: every shingle of ``SHINGLE`` words of the whole text votes with
the 64 bits of its XXH64; a bit is set if set in over half the shingles.

Search: the fingerprint is cut into 32 segments of two bits and mapped to the
vector of their bit counts (0, 1 or 2). Two fingerprints within ``max_bits``
differing bits have count vectors within Manhattan distance ``max_bits``. The
32 coordinates are dealt into ``max_bits + 3`` groups; a distance of at most
``max_bits`` leaves at least three groups untouched, so both points share the
grid cell of some choice of three groups (about 14 coordinates). Points meet
in those cells; the join condition tests the full Manhattan distance (one
popcount, because a count in unary code turns distance into differing bits)
and then the exact number of differing bits. A pair is emitted only in the
first cell that it shares, so every link leaves the join once, and only
links leave it. Equal fingerprints are one point: copies never meet in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocube.llm.common import map_arrow, stored
from regiocube.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42

#: Shingles hashed before their votes are added up: bounds memory for long texts.
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text as an unsigned integer; 0 without words.

    Only A-Z are lower-cased; words split at ASCII white space; a text of
    fewer words than ``shingle`` has one shingle, the whole sequence.
    """
    if text is None:
        return 0
    words = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not words:
        return 0
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    n = len(spaces) + 2 - shingle
    if n <= 1:
        return xxhash.xxh64_intdigest(words, SEED)
    starts = [0, *(spaces[:n - 1] + 1).tolist()]
    ends = [*spaces[shingle - 1:].tolist(), len(words)]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for k in range(0, n, _BLOCK):
        hashes = np.fromiter((digest(words[a:b], SEED) for a, b in zip(starts[k:k + _BLOCK], ends[k:k + _BLOCK])),
                             np.uint64)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                     text_col: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """(id_col, simhash long, the string columns ``also``) for every row; the bits are those of the unsigned value."""
    names = [id_col, "simhash", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64)), *b.columns[2:]], names=names)

    own = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col), *also)
    return map_arrow(own, run, f"`{id_col}` long, simhash long" + "".join(f", {c} string" for c in also))


def _unary(x: Column) -> Column:
    """Each two-bit segment as its bit count in unary: 0, 1, 2 -> 00, 01, 11."""
    low = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(x, 1)
    return x.bitwiseOR(high).bitwiseAND(low).bitwiseOR(F.shiftleft(x.bitwiseAND(high).bitwiseAND(low), 1))


def _group_masks(groups: int) -> list[int]:
    """Masks over the 64 bits: coordinate (segment) i belongs to group i mod groups."""
    return [sum(3 << (2 * i) for i in range(g, 32, groups)) for g in range(groups)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(src, dst) for all links between the distinct points ``prints`` (node, simhash).

    ``node`` identifies a fingerprint; ``simhash`` values are distinct.
    """
    if not 1 <= max_bits <= 8:
        raise ValueError("max_bits must lie in 1..8")
    groups = max_bits + 3
    masks = _group_masks(groups)
    choices = [(sum(1 << g for g in c), _signed(sum(masks[g] for g in c))) for c in combinations(range(groups), 3)]
    cells = (prints.select("node", "simhash", _unary(F.col("simhash")).alias("counts"))
             .withColumn("choice", F.explode(F.array(*[F.struct(F.lit(c).alias("groups"), F.lit(m).alias("mask"))
                                                        for c, m in choices])))
             .select("node", "simhash", "counts", F.col("choice.groups").alias("groups"),
                     F.col("counts").bitwiseAND(F.col("choice.mask")).alias("cell")))
    a, b = cells.alias("a"), cells.alias("b")
    apart = F.col("a.counts").bitwiseXOR(F.col("b.counts"))
    same = None
    for g, m in enumerate(masks):
        bit = F.when(apart.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(1 << g)).otherwise(F.lit(0))
        same = bit if same is None else same.bitwiseOR(bit)
    # The three lowest bits of the untouched groups name the first shared cell.
    one = same.bitwiseAND(-same)
    rest = same.bitwiseXOR(one)
    two = rest.bitwiseAND(-rest)
    rest2 = rest.bitwiseXOR(two)
    first = one.bitwiseOR(two).bitwiseOR(rest2.bitwiseAND(-rest2))
    # Spark sizes the cells by the points' files, over 35 times too low, and would broadcast them: both sides are dealt out.
    return (a.join(b.hint("merge"), (F.col("a.groups") == F.col("b.groups")) & (F.col("a.cell") == F.col("b.cell"))
                   & (F.col("a.simhash") < F.col("b.simhash"))
                   & (F.bit_count(apart) <= max_bits)
                   & (F.bit_count(F.col("a.simhash").bitwiseXOR(F.col("b.simhash"))) <= max_bits)
                   & (first == F.col("a.groups")))
            .select(F.col("a.node").alias("src"), F.col("b.node").alias("dst")))


def simhash_classes(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, simhash, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, itself included.

    - null or empty text, or white space alone: fingerprint 0, linked like any other;
    - repeated rows and copies: one row each, all in one component;
    - equal ids with texts that are not alike: each is in the component of its own fingerprint;
    - null id: the row keeps its fingerprint; its component is the smallest
      non-null id reachable over its fingerprint (null if there is none);
    - empty table: empty result; other columns of ``docs`` are not looked at.
    """
    prints = stored(with_fingerprint(docs, shingle, id_col, text_col), "simhash")
    return _with_classes(prints, max_bits, id_col).select(id_col, "simhash", "component_id")


def _with_classes(prints: DataFrame, max_bits: int, id_col: str = "doc_id") -> DataFrame:
    """``prints`` with ``class`` (a fingerprint of the row's component, the same for all of it) and ``component_id``.

    Fingerprints are the nodes, so rows that only have their id in common stay in components of their own.
    """
    points = stored(prints.groupBy("simhash").agg(F.min(id_col).alias("least")).where("least is not null"), "simhash-points")
    linked = stored(components(near_pairs(points.select(F.col("simhash").alias("node"), "simhash"), max_bits)), "simhash-linked")
    least = (linked.join(points, F.col("node") == F.col("simhash")).groupBy("component")
             .agg(F.min("least").alias("component_id")).withColumnRenamed("component", "class"))
    named = linked.join(least, F.col("component") == F.col("class")).select("node", "class", "component_id")
    labels = (points.join(named, F.col("simhash") == F.col("node"), "left")
              .select("simhash", F.coalesce("class", "simhash").alias("class"),
                      F.coalesce("component_id", "least").alias("component_id")))
    return prints.join(labels, "simhash", "left")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` of each near-duplicate component: one that has its smallest doc_id.

    All columns stay, whatever their names.

    - rows that repeat a doc_id with texts that are not alike are in components of their own: each stays;
    - of different texts of one component under its smallest doc_id the one with the least digest stays, of
      equal ones the row whose other plain columns have the least hash (null and empty texts are equal);
    - rows without a doc_id can be told apart by nothing: all stay;
    - empty table: empty result.
    """
    own = docs.select("doc_id", "text", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("digest"))
    prints = stored(with_fingerprint(own.where("doc_id is not null"), shingle, also=["digest"]), "simhash")
    # Copies under one id are combined before they move; a leader is one row per component.
    each = prints.groupBy("doc_id", "digest", "simhash").agg(F.count("*").alias("many"))
    leaders = stored(_with_classes(each, max_bits).where("doc_id = component_id").groupBy("doc_id", "class")
                     .agg(F.min(F.struct("digest", "many")).alias("first")).select("doc_id", "first.*"), "simhash-leaders")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("digest"))
    plain = [F.col(f"row.`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    single = rows.join(leaders.where("many = 1"), ["doc_id", "digest"], "left_semi").select("row")
    repeated = (rows.join(leaders.where("many > 1"), ["doc_id", "digest"], "left_semi").groupBy("doc_id", "digest")
                .agg(F.min_by("row", F.xxhash64(*plain)).alias("row")).select("row"))
    return single.union(repeated).select("row.*").union(docs.where("doc_id is null"))
