"""geo_benchmark family: every region against its reference-group peers and
its own country.

Partitioning argument (why plain windows are safe here): every window below
is partitioned by at least ``year`` (+ ``nuts_level``) + all breakdown dims,
and ``(year, geo, dims)`` is the mart's primary key (gate ``check_key``). A
window partition therefore holds at most one row per geo code of one level,
bounded by the size of the classification (about 1,500 NUTS3 regions in the
real classification), not by the data volume; a task may host many such
partitions but never an unbounded one. All windows share the leading
partition columns ``P``, so Spark plans a single exchange on ``P`` and the
later windows (on supersets of ``P``) reuse it.

Slice-first: the benchmark columns are defined only on reference-slice rows
and every slice dimension is a partition dimension, so the slice rows form
whole window partitions. The windows therefore run on the slice rows alone
and the remaining rows are appended with NULL benchmarks — equal to the
CASE-gated form over all rows, with a fraction of the sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocube.constants import EU27, EU27_AGGREGATE
from regiocube.functions.codes import is_member, slice_predicate
from regiocube.functions.numeric import pct_distance, round_half_away
from regiocube.operators.enrich import analysable
from regiocube.operators.ranks import same, with_ranks

BENCH_COLS = ("media_eu_value", "media_paese_value", "percentile_eu", "rank_nazionale",
              "distanza_media_eu_pct")
_TYPES = {"media_eu_value": "double", "media_paese_value": "double", "percentile_eu": "double",
          "rank_nazionale": "long", "distanza_media_eu_pct": "double"}


def _geo_cols(df: DataFrame) -> list[str]:
    want = ["year", "geo", "geo_label_en", "nuts_level", "nuts_parent_code",
            "nuts_parent_label_en", "country"]
    return [c for c in want if c in df.columns]


def _dim_cols(df: DataFrame, dims: Sequence[str]) -> list[str]:
    out = []
    for d in dims:
        out.append(d)
        if f"{d}_label_en" in df.columns:
            out.append(f"{d}_label_en")
    return out


def _with_peers(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    """``df`` with the reference group's mean per partition (``__avg_ref``) and each reference row's
    percent rank among it (``__share``), without a window over a partition."""
    means = df.groupBy(*[F.col(c).alias(f"__p_{c}") for c in partition]).agg(
        F.avg(F.when(F.col("__is_ref"), F.col("value"))).alias("__avg_ref"))
    out = with_ranks(df, partition, "value", "__low", "__n_ref", where=F.col("__is_ref"))
    out = out.join(means, same(out, means, partition, "__p_"), "left").drop(*[f"__p_{c}" for c in partition])
    return out.withColumn("__share", _percent_rank("__low", "__n_ref"))


def _percent_rank(rank: str, n: str) -> Column:
    return F.when(F.col(n) > 1, (F.col(rank) - 1).cast("double") / (F.col(n) - 1)).when(F.col(n) == 1, F.lit(0.0))


def geo_benchmark(
    clean: DataFrame,
    slice_: Mapping[str, object],
    dims: Sequence[str],
    ref_group: Sequence[str] = EU27,
    level_in_partition: bool = True,
    round_media: int = 2,
    round_pct: int = 4,
    round_dist: int = 1,
    slice_first: bool = True,
    carry_dims: Sequence[str] = (),
    bounded: bool = True,
) -> DataFrame:
    """MRT-1 / MRT-1a.

    One row per analysable clean row (value and country present). On rows of
    the reference slice only (NULL elsewhere):

    * ``media_eu_value``: mean of reference-group rows over P, rounded;
    * ``media_paese_value``: mean over P + country, rounded;
    * ``percentile_eu``: ``percent_rank`` over (P, is_ref) by value, only for
      reference-group rows;
    * ``rank_nazionale``: ``rank`` over P + country by value descending (not
      gated by group membership);
    * ``distanza_media_eu_pct``: percent distance from the *unrounded*
      reference mean with an absolute denominator.

    P = year (+ nuts_level unless ``level_in_partition=False``) + ``dims``.
    ``dims`` must contain every slice dimension. ``carry_dims`` are grain
    dims passed through without entering the partition (one published mart
    keys on a dim it does not partition by; correct while that dim has a
    single value per partition). With ``bounded=False`` nothing is taken for
    bounded: means are aggregations, ranks come from value ranges
    (``operators.ranks``), and no partition has to fit one task.
    """
    missing = [d for d in slice_ if d not in dims]
    if missing:
        raise ValueError(f"slice dims {missing} must be partition dims")
    P = ["year"] + (["nuts_level"] if level_in_partition else []) + list(dims)
    carry = _geo_cols(clean) + _dim_cols(clean, [*dims, *carry_dims]) + ["value"]
    tail = [c for c in ("flag", "flag_desc_en") if c in clean.columns]
    base = analysable(clean).select(*carry, *tail,
                                    is_member("country", ref_group).alias("__is_ref"))
    in_slice = F.coalesce(slice_predicate(slice_), F.lit(False))

    def bench(df: DataFrame, gate: Column | None) -> DataFrame:
        def g(c: Column) -> Column:
            return c if gate is None else F.when(gate, c)
        w_p = Window.partitionBy(*P)
        w_c = Window.partitionBy(*P, "country")
        w_ref = Window.partitionBy(*P, "__is_ref").orderBy(F.col("value").asc_nulls_last())
        w_rank = Window.partitionBy(*P, "country").orderBy(F.col("value").desc_nulls_last())
        avg_ref = F.avg(F.when(F.col("__is_ref"), F.col("value"))).over(w_p)
        out = df.withColumn("__avg_ref", avg_ref)
        out = out.select(
            *carry,
            g(round_half_away("__avg_ref", round_media)).alias("media_eu_value"),
            g(round_half_away(F.avg("value").over(w_c), round_media)).alias("media_paese_value"),
            g(F.when(F.col("__is_ref"), round_half_away(F.percent_rank().over(w_ref), round_pct)))
            .alias("percentile_eu"),
            g(F.rank().over(w_rank).cast("long")).alias("rank_nazionale"),
            g(pct_distance("value", "__avg_ref", round_dist)).alias("distanza_media_eu_pct"),
            *tail,
        )
        return out

    def ranged(df: DataFrame) -> DataFrame:
        national = df.groupBy(*[F.col(c).alias(f"__c_{c}") for c in (*P, "country")]).agg(F.avg("value").alias("__avg_country"))
        out = with_ranks(_with_peers(df, P), [*P, "country"], "value", "__rank", descending=True)
        out = out.join(national, same(out, national, [*P, "country"], "__c_"), "left")
        return out.select(
            *carry, round_half_away("__avg_ref", round_media).alias("media_eu_value"),
            round_half_away("__avg_country", round_media).alias("media_paese_value"),
            F.when(F.col("__is_ref"), round_half_away("__share", round_pct)).alias("percentile_eu"),
            F.col("__rank").alias("rank_nazionale"), pct_distance("value", "__avg_ref", round_dist).alias("distanza_media_eu_pct"),
            *tail)

    if not bounded:
        in_rows = ranged(base.filter(in_slice))
    elif not slice_first:
        return bench(base, in_slice)
    else:
        in_rows = bench(base.filter(in_slice), None)
    out_rows = base.filter(~in_slice).select(
        *carry, *[F.lit(None).cast(_TYPES[c]).alias(c) for c in BENCH_COLS], *tail)
    return in_rows.unionByName(out_rows)


def geo_benchmark_published(
    clean: DataFrame,
    fixed: Mapping[str, object],
    dims: Sequence[str],
    ref_group: Sequence[str] = EU27,
    aggregate_geo: str = EU27_AGGREGATE,
    round_media: int = 2,
    round_pct: int = 4,
    round_dist: int = 2,
    bounded: bool = True,
) -> DataFrame:
    """MRT-1b: base pre-filtered to ``fixed``; adds the published aggregate's
    value (``valore_eu27``, LEFT JOIN on year + dims) and the point distance
    ``distanza_eu27_pp``; no national rank; the percent distance divides by
    the raw (signed) reference mean. ``bounded`` as in ``geo_benchmark``.
    """
    fixed_pred = slice_predicate(fixed)
    P = ["year", "nuts_level", *dims]
    cols = (["year", "geo", "geo_label_en", "nuts_level", "country"]
            + ["__is_ref", "nuts_parent_code", "nuts_parent_label_en"]
            + _dim_cols(clean, dims) + ["value", "flag", "flag_desc_en"])
    base = (analysable(clean).filter(fixed_pred)
            .withColumn("__is_ref", is_member("country", ref_group))
            .select(*cols))
    agg = (clean.filter((F.col("geo") == F.lit(aggregate_geo)) & fixed_pred)
                .select(F.col("year").alias("__y"), *[F.col(d).alias(f"__{d}") for d in dims],
                        F.col("value").alias("valore_eu27")))
    cond = base["year"] == agg["__y"]
    for d in dims:
        cond = cond & (base[d] == agg[f"__{d}"])
    joined = base.join(agg, cond, "left").drop("__y", *[f"__{d}" for d in dims])
    w_p = Window.partitionBy(*P)
    w_c = Window.partitionBy(*P[:1], "country", *P[1:])
    w_ref = Window.partitionBy(*P, "__is_ref").orderBy(F.col("value").asc_nulls_last())
    if bounded:
        out = joined.withColumn("__avg_ref", F.avg(F.when(F.col("__is_ref"), F.col("value"))).over(w_p))
        national, share = F.avg("value").over(w_c), F.percent_rank().over(w_ref)
    else:
        of_country = ["year", "country", *P[1:]]
        means = joined.groupBy(*[F.col(c).alias(f"__c_{c}") for c in of_country]).agg(F.avg("value").alias("__avg_country"))
        out = _with_peers(joined, P)
        out = out.join(means, same(out, means, of_country, "__c_"), "left")
        national, share = F.col("__avg_country"), F.col("__share")
    return out.select(
        *[c if c != "__is_ref" else F.col("__is_ref").alias("is_eu") for c in cols],
        "valore_eu27",
        round_half_away("__avg_ref", round_media).alias("media_eu_value"),
        round_half_away(national, round_media).alias("media_paese_value"),
        F.when(F.col("__is_ref"), round_half_away(share, round_pct)).alias("percentile_eu"),
        round_half_away(F.col("value") - F.col("valore_eu27"), 2).alias("distanza_eu27_pp"),
        pct_distance("value", "__avg_ref", round_dist, abs_denominator=False)
        .alias("distanza_media_eu_pct"),
    )


def geo_benchmark_joined(
    clean: DataFrame,
    fixed: Mapping[str, object],
    carry_dims: Sequence[str] = (),
    round_dist: int = 2,
    bounded: bool = True,
) -> DataFrame:
    """MRT-1c (aggregate-then-join flavour).

    Base = ``fixed`` rows with a country (NULL values kept). The "EU" mean and
    percentile are over *all* countries by (year, nuts_level), unrounded;
    ``media_paese_value`` is the country mean by year and
    ``rank_nazionale`` ranks countries by that mean (descending, NULLs last).
    Means come from partial aggregation + join (no row-level shuffle into few
    partitions); the percentile window is bounded by the geo count per level
    (``bounded`` as in ``geo_benchmark``).
    """
    fixed_pred = slice_predicate(fixed)
    base_cols = (["year", "geo", "geo_label_en", "nuts_level", "country",
                  "nuts_parent_code", "nuts_parent_label_en"]
                 + _dim_cols(clean, carry_dims) + ["value", "flag", "flag_desc_en"])
    base = clean.filter(fixed_pred & F.col("country").isNotNull()).select(*base_cols)
    bm = base.groupBy("year", "nuts_level").agg(F.avg("value").alias("media_eu_value"))
    ca = base.groupBy("year", "country").agg(F.avg("value").alias("media_paese_value"))
    ca = ca.withColumn("rank_nazionale", F.rank().over(
        Window.partitionBy("year").orderBy(F.col("media_paese_value").desc_nulls_last())).cast("long"))
    pr = F.percent_rank().over(
        Window.partitionBy("year", "nuts_level").orderBy(F.col("value").asc_nulls_last()))
    if bounded:
        placed = base.withColumn("percentile_eu", pr)
    else:
        placed = with_ranks(base, ["year", "nuts_level"], "value", "__low", "__n").withColumn(
            "percentile_eu", _percent_rank("__low", "__n"))
    out = (placed
               .join(bm, ["year", "nuts_level"], "left")
               .join(ca, ["year", "country"], "left"))
    m = F.col("media_eu_value")
    dist = F.when(m.isNotNull() & (m != 0),
                  round_half_away((F.col("value") - m) / m * F.lit(100.0), round_dist))
    return out.select(*base_cols, "media_eu_value", "media_paese_value", "percentile_eu",
                      "rank_nazionale", dist.alias("distanza_media_eu_pct"))
