"""Pivots, shares and slices (MRT-6, 9-15).

Pivots are conditional aggregations with a literal column list
(``MAX(CASE WHEN dim = code THEN value END)``): partial aggregation
map-side, one exchange on the group key, no value discovery job. Slices
and extracts are narrow filter/projections that push down to the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocube.functions.codes import is_country_citizen, slice_predicate
from regiocube.functions.numeric import round_half_away, safe_div, to_bigint


def _pivot_aggs(dim: str, columns: Mapping[str, str]) -> list[Column]:
    return [F.max(F.when(F.col(dim) == F.lit(code), F.col("value"))).alias(name)
            for code, name in columns.items()]


def share_pivot(
    clean: DataFrame,
    slice_: Mapping[str, object],
    mode_col: str,
    modes: Mapping[str, str],
    required: str | None = None,
    with_sum: bool = True,
    level: str | None = "country",
    keys: Sequence[str] = ("year", "country"),
) -> DataFrame:
    """MRT-6: one column per mode share, ``somma_modi_pct`` (optional) and
    ``residuo_pct = round(100 - sum(coalesce(share, 0)), 2)``; keeps the rows
    where the ``required`` share (default: the first mode) is present.

    ``modes`` maps code -> output column. ``level`` restricts the rows to one
    geo level (the published flows carry country rows only).
    """
    pred = F.col("country").isNotNull() & slice_predicate(slice_) & F.col(mode_col).isin(list(modes))
    if level is not None:
        pred = pred & (F.col("nuts_level") == F.lit(level))
    piv = clean.filter(pred).groupBy(*keys).agg(*_pivot_aggs(mode_col, modes))
    names = list(modes.values())
    total = None
    for n in names:
        term = F.coalesce(F.col(n), F.lit(0))
        total = term if total is None else total + term
    req = required or names[0]
    extra = [round_half_away(total, 2).alias("somma_modi_pct")] if with_sum else []
    return piv.filter(F.col(req).isNotNull()).select(
        *keys, *names, *extra, round_half_away(F.lit(100) - total, 2).alias("residuo_pct"))


def flagged_slice(
    clean: DataFrame,
    slice_: Mapping[str, object],
    cat: str,
    totals: Sequence[str],
    measure: str,
    flag_col: str = "is_total",
) -> DataFrame:
    """MRT-9: slice rows with a value, a boolean marking non-additive
    (total/aggregate) categories, and the value as BIGINT."""
    cols = ["year", "geo", "geo_label_en", "nuts_level", "country", cat]
    if f"{cat}_label_en" in clean.columns:
        cols.append(f"{cat}_label_en")
    return clean.filter(slice_predicate(slice_) & F.col("value").isNotNull()).select(
        *cols, F.col(cat).isin(list(totals)).alias(flag_col), to_bigint("value").alias(measure))


def citizenship_slice(
    clean: DataFrame,
    slice_: Mapping[str, object],
    measure: str,
    citizen_col: str = "citizen",
) -> DataFrame:
    """MRT-10: rows whose citizenship is a real country (two letters, not
    the EU/EA aggregates), value as BIGINT."""
    return clean.filter(slice_predicate(slice_) & is_country_citizen(citizen_col)
                        & F.col("value").isNotNull()).select(
        "year", "geo", "geo_label_en", "nuts_level", "country", citizen_col,
        f"{citizen_col}_label_en", to_bigint("value").alias(measure))


def complement_share(
    clean: DataFrame,
    slice_: Mapping[str, object],
    cat: str,
    total: str,
    part: str,
    names: Sequence[str] = ("popolazione_totale", "nazionali", "stranieri"),
    share_col: str = "quota_stranieri_pct",
) -> DataFrame:
    """MRT-11: total and part pivoted per region-year; complement = total -
    part and its share of the total (rows with a total only)."""
    keys = ["year", "geo", "geo_label_en", "nuts_level", "country"]
    piv = clean.filter(slice_predicate(slice_) & F.col(cat).isin(total, part)).groupBy(*keys).agg(
        *_pivot_aggs(cat, {total: "__tot", part: "__part"}))
    comp = F.col("__tot") - F.col("__part")
    return piv.filter(F.col("__tot").isNotNull()).select(
        *keys, to_bigint("__tot").alias(names[0]), to_bigint("__part").alias(names[1]),
        to_bigint(comp).alias(names[2]),
        round_half_away(safe_div(comp, F.col("__tot")) * F.lit(100), 2).alias(share_col))


def item_pivot(
    clean: DataFrame,
    item_col: str,
    items: Mapping[str, str],
    derived: Mapping[str, Sequence[tuple[int, str]]] | None = None,
    units: Sequence[str] | None = None,
    level: str | None = "country",
    keys: Sequence[str] = ("year", "country", "unit"),
) -> DataFrame:
    """MRT-12: items -> columns per (year, country, unit) plus derived
    columns given as signed sums of items, e.g.
    ``{"domanda_interna": [(1, "B1GQ"), (-1, "P6"), (1, "P7")]}`` (NULL if
    any term is NULL)."""
    pred = F.col("country").isNotNull()
    if units is not None:
        pred = pred & F.col("unit").isin(list(units))
    if level is not None:
        pred = pred & (F.col("nuts_level") == F.lit(level))
    piv = clean.filter(pred).groupBy(*keys).agg(*_pivot_aggs(item_col, items))
    out = [*keys, *items.values()]
    for name, terms in (derived or {}).items():
        expr = None
        for sign, code in terms:
            c = F.col(items[code])
            if expr is None:
                expr = c if sign > 0 else -c
            else:
                expr = expr + c if sign > 0 else expr - c
        out.append(expr.alias(name))
    return piv.select(*out)


def extract(
    clean: DataFrame,
    where: Column,
    cols: Sequence[str | Column],
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """MRT-13 / MRT-15: filter + projection (+ renames such as
    ``value -> vacancy_rate_pct``)."""
    out = clean.filter(where).select(*cols)
    for src, dst in (rename or {}).items():
        out = out.withColumnRenamed(src, dst)
    return out


def unit_join(
    clean: DataFrame,
    unit_a: str,
    unit_b: str,
    keys: Sequence[str],
    where: Column,
    carry: Sequence[str] = ("geo_label_en", "nuts_level"),
    names: Sequence[str] = ("km", "per_1000_km2"),
) -> DataFrame:
    """MRT-14: the ``unit_a`` value of each (year, geo, ...) key with the ``unit_b`` value
    beside it (NULL where there is none); keys without an ``unit_a`` value are dropped.
    One scan and one aggregation: both units of a key meet in one group (``carry`` depends
    on the key; a unit has one row per key, see ``quality.check_key``)."""
    def of(unit: str) -> Column:
        return F.max(F.when(F.col("unit") == F.lit(unit), F.col("value")))

    pairs = clean.filter(where & F.col("unit").isin(unit_a, unit_b)).groupBy(*keys, *carry).agg(
        of(unit_a).alias(names[0]), of(unit_b).alias(names[1]))
    return pairs.filter(F.col(names[0]).isNotNull())
