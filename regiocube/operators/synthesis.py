"""Country synthesis and cross-country rankings (MRT-2 S1..S7).

All windows here run over country-level rows of one year (and breakdown
dims): a partition holds at most one row per country, so it is bounded by
the number of countries. Inputs are reduced by partial aggregation before
the only shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiocube.constants import EU27, EU27_AGGREGATE
from regiocube.functions.codes import is_member, slice_predicate
from regiocube.functions.numeric import pct_distance, round_half_away, safe_div
from regiocube.operators.ranks import with_ranks

RANK_COL = "rank_procapite_eu"
DIST_COL = "distanza_media_eu_pct"


def _ranked(df: DataFrame, metric: str, part: Sequence[str], gate: str, rank_col: str) -> Column:
    w = Window.partitionBy(*part, gate).orderBy(F.col(metric).desc_nulls_last())
    return F.when(F.col(gate), F.rank().over(w).cast("long")).alias(rank_col)


def _distance(metric: str, part: Sequence[str], gate: str, digits: int) -> Column:
    w = Window.partitionBy(*part) if part else Window.partitionBy()
    ref = F.avg(F.when(F.col(gate), F.col(metric))).over(w)
    return pct_distance(F.col(metric), ref, digits)


def _dims_with_labels(df: DataFrame, dims: Sequence[str]) -> list[str]:
    out = []
    for d in dims:
        out.append(d)
        if f"{d}_label_en" in df.columns:
            out.append(f"{d}_label_en")
    return out


def country_synthesis(
    clean: DataFrame,
    metrics: Mapping[str, Mapping[str, object]],
    dims: Sequence[str] = (),
    ref_group: Sequence[str] = EU27,
    rank_by: str | None = None,
    rank_col: str = RANK_COL,
    round_dist: int = 1,
    with_label: bool = False,
    emit_is_eu: bool = False,
) -> DataFrame:
    """S1: pivot country rows into one metric column per slice
    (``MAX(CASE WHEN slice THEN value END)`` by year, country[, dims]).

    Rank among reference-group countries by ``rank_by`` (default: the first
    metric) descending with NULLs last — a member with rows but no value in
    the slice keeps a NULL metric and still takes the last rank; percent
    distance from the members' mean is shown for every country.
    """
    names = list(metrics)
    rank_by = rank_by or names[0]
    dcols = _dims_with_labels(clean, dims)
    base = clean.filter((F.col("nuts_level") == F.lit("country")) & F.col("value").isNotNull())
    label = [F.col("geo_label_en").alias("country_label_en")] if with_label else []
    cv = base.groupBy("year", *dcols, F.col("geo").alias("country"), *label).agg(
        *[F.max(F.when(slice_predicate(s), F.col("value"))).alias(n) for n, s in metrics.items()])
    cv = cv.withColumn("__is_ref", is_member("country", ref_group))
    part = ["year", *dims]
    return cv.select(
        "year", "country", *(["country_label_en"] if with_label else []), *dcols, *names,
        _ranked(cv, rank_by, part, "__is_ref", rank_col),
        _distance(rank_by, part, "__is_ref", round_dist).alias(DIST_COL),
        *([F.col("__is_ref").alias("is_eu")] if emit_is_eu else []),
    )


def country_rollup(
    clean: DataFrame,
    slice_: Mapping[str, object],
    metric: str,
    level: str = "NUTS2",
    agg: str = "sum",
    round_metric: int = 0,
    ref_group: Sequence[str] = EU27,
    rank_col: str = RANK_COL,
    round_dist: int = 1,
) -> DataFrame:
    """S2: country value rolled up from regions of ``level`` (SUM, or the
    unweighted AVG), rounded before ranking; ``MAX(is_ref)`` carries the flag.
    """
    fn = {"sum": F.sum, "avg": F.avg}[agg]
    rv = clean.filter(slice_predicate(slice_) & (F.col("nuts_level") == F.lit(level))
                      & F.col("value").isNotNull() & F.col("country").isNotNull())
    cv = rv.groupBy("year", "country").agg(
        F.max(is_member("country", ref_group)).alias("__is_ref"),
        round_half_away(fn("value"), round_metric).alias(metric))
    return cv.select(
        "year", "country", metric,
        _ranked(cv, metric, ["year"], "__is_ref", rank_col),
        _distance(metric, ["year"], "__is_ref", round_dist).alias(DIST_COL),
    )


def country_direct(
    clean: DataFrame,
    slice_: Mapping[str, object],
    metric: str,
    round_metric: int = 0,
    ref_group: Sequence[str] = EU27,
    rank_col: str = RANK_COL,
    round_dist: int = 1,
) -> DataFrame:
    """S3: country rows of the slice, ``ROUND(value, k)`` before rank and
    distance; emits ``is_eu``."""
    rows = clean.filter(slice_predicate(slice_) & (F.col("nuts_level") == F.lit("country"))
                        & F.col("value").isNotNull() & F.col("country").isNotNull())
    cv = rows.select("year", "country", is_member("country", ref_group).alias("is_eu"),
                     round_half_away("value", round_metric).alias(metric))
    return cv.select(
        "year", "country", "is_eu", metric,
        _ranked(cv, metric, ["year"], "is_eu", rank_col),
        _distance(metric, ["year"], "is_eu", round_dist).alias(DIST_COL),
    )


def country_rollup_covered(
    clean: DataFrame,
    slice_: Mapping[str, object],
    metric: str,
    level: str = "NUTS3",
    ref_group: Sequence[str] = EU27,
    round_dist: int = 1,
) -> DataFrame:
    """S4: SUM over regions of ``level`` with coverage: regions with data vs
    all regions (distinct geo codes), ``copertura_pct``; rank and distance
    only for members with full coverage; countries whose sum is NULL are
    dropped."""
    rows = clean.filter((F.col("nuts_level") == F.lit(level)) & slice_predicate(slice_)
                        & F.col("country").isNotNull())
    cv = rows.groupBy("year", "country").agg(
        F.sum("value").alias(metric),
        F.count_distinct(F.when(F.col("value").isNotNull(), F.col("geo"))).alias("n_nuts3_con_dato"),
        F.count_distinct("geo").alias("n_nuts3"),
    ).filter(F.col(metric).isNotNull())
    cv = cv.select(
        "*",
        round_half_away(safe_div(F.col("n_nuts3_con_dato").cast("double") * F.lit(100.0),
                                 F.col("n_nuts3").cast("double")), 1).alias("copertura_pct"),
        (is_member("country", ref_group) & (F.col("n_nuts3_con_dato") == F.col("n_nuts3")))
        .alias("__rankable"),
    )
    w = Window.partitionBy("year", "__rankable").orderBy(F.col(metric).desc_nulls_last())
    ref = F.avg(F.when(F.col("__rankable"), F.col(metric))).over(Window.partitionBy("year"))
    return cv.select(
        "year", "country", metric, "n_nuts3_con_dato", "n_nuts3", "copertura_pct",
        F.when(F.col("__rankable"), F.rank().over(w).cast("long")).alias("rank_eu"),
        F.when(F.col("__rankable"), pct_distance(F.col(metric), ref, round_dist)).alias(DIST_COL),
    )


def country_synthesis_reconciled(
    clean: DataFrame,
    metrics: Mapping[str, Mapping[str, object]],
    rank_cols: Mapping[str, str],
    reconcile: Mapping[str, object],
    reconcile_col: str,
    level: str = "NUTS3",
    ref_group: Sequence[str] = EU27,
    round_dist: int = 1,
) -> DataFrame:
    """S5: pivoted metrics with one reference-group rank per metric, the
    distance on the first metric, and a LEFT-joined cross-check column =
    SUM of ``reconcile`` rows over regions of ``level``."""
    names = list(metrics)
    base = clean.filter((F.col("nuts_level") == F.lit("country")) & F.col("value").isNotNull())
    cv = base.groupBy("year", F.col("geo").alias("country")).agg(
        *[F.max(F.when(slice_predicate(s), F.col("value"))).alias(n) for n, s in metrics.items()])
    cv = cv.withColumn("__is_ref", is_member("country", ref_group))
    nt = (clean.filter(slice_predicate(reconcile) & (F.col("nuts_level") == F.lit(level))
                       & F.col("value").isNotNull() & F.col("country").isNotNull())
               .groupBy("year", "country").agg(F.sum("value").alias(reconcile_col)))
    j = cv.join(nt, ["year", "country"], "left")
    return j.select(
        "year", "country", *names, reconcile_col,
        *[_ranked(j, m, ["year"], "__is_ref", rank_cols[m]) for m in names if m in rank_cols],
        _distance(names[0], ["year"], "__is_ref", round_dist).alias(DIST_COL),
    )


def country_vs_published(
    clean: DataFrame,
    fixed: Mapping[str, object],
    dims: Sequence[str],
    metric: str,
    ref_group: Sequence[str] = EU27,
    aggregate_geo: str = EU27_AGGREGATE,
) -> DataFrame:
    """S6: country values against the published aggregate row: point
    distance ``distanza_eu27_pp`` and a member rank by (year, dims)."""
    pred = slice_predicate(fixed)
    dcols = _dims_with_labels(clean, dims)
    c = clean.filter((F.col("nuts_level") == F.lit("country")) & pred & F.col("value").isNotNull()).select(
        "year", "country", "geo_label_en", is_member("country", ref_group).alias("is_eu"),
        *dcols, F.col("value").alias(metric), "flag")
    e = clean.filter((F.col("geo") == F.lit(aggregate_geo)) & pred).select(
        F.col("year").alias("__y"), *[F.col(d).alias(f"__{d}") for d in dims],
        F.col("value").alias("valore_eu27"))
    cond = c["year"] == e["__y"]
    for d in dims:
        cond = cond & (c[d] == e[f"__{d}"])
    j = c.join(e, cond, "left").drop("__y", *[f"__{d}" for d in dims])
    w = Window.partitionBy("year", *dims, "is_eu").orderBy(F.col(metric).desc_nulls_last())
    return j.select(
        *c.columns, "valore_eu27",
        round_half_away(F.col(metric) - F.col("valore_eu27"), 2).alias("distanza_eu27_pp"),
        F.when(F.col("is_eu"), F.rank().over(w).cast("long")).alias("rank_eu"),
    )


def country_ranking(clean: DataFrame, fixed: Mapping[str, object], metric: str,
                    rank_col: str = "rank_totale_eu", bounded: bool = True) -> DataFrame:
    """S7: rank of every country row (no group gate, NULL values kept). With
    ``bounded=False`` no year has to fit one task (``operators.ranks``)."""
    c = clean.filter((F.col("nuts_level") == F.lit("country")) & slice_predicate(fixed)).select(
        "year", "country", F.col("value").alias(metric))
    if not bounded:
        return with_ranks(c, ["year"], metric, rank_col, descending=True)
    w = Window.partitionBy("year").orderBy(F.col(metric).desc_nulls_last())
    return c.select("year", "country", metric, F.rank().over(w).cast("long").alias(rank_col))
