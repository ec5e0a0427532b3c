"""Standing of a focus country; composition gaps; mode gaps; recognition
rates (MRT-4, 5, 7, 8).

Every mart here is conditional aggregation over one scan of the clean table:
rows are reduced per geography, then per year, and what used to be a window, a
published-or-computed join or a two-sided join is an aggregate with a filter.
The lists built per year hold one value per country.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocube.constants import EU27, EU27_AGGREGATE
from regiocube.functions.codes import slice_predicate
from regiocube.functions.numeric import round_half_away, safe_div, to_bigint


def _pick(condition: Column, value: Column | str = "value") -> Column:
    return F.max(F.when(condition, F.col(value) if isinstance(value, str) else value))


def position_share(
    clean: DataFrame,
    slice_: Mapping[str, object],
    focus: str,
    eu_total: str = "published",
    level: str = "country",
    measure: str = "valore",
    ref_group: Sequence[str] = EU27,
    aggregate_geo: str = EU27_AGGREGATE,
    rate: Mapping[str, object] | None = None,
) -> DataFrame:
    """MRT-4 (+ MRT-8a with ``rate``): one row per year in which the focus
    country has a value.

    Its rank is one more than the number of countries of ``level`` with a
    larger value; its share is ``round(value / NULLIF(total, 0) * 100, 2)`` of
    the reference-group total: the aggregate's own row (``published``), the
    sum over the member countries (``computed``), or the first where present,
    else the second (``fallback``).

    ``rate = {"dim": "decision", "pos": "POS", "neg": "NEG", "slice": {...}}``
    adds recognition rates ``pos / (pos + neg) * 100`` for the focus country
    and the reference group (published POS/NEG of the aggregate, else the
    sums over the member countries).
    """
    if eu_total not in ("published", "computed", "fallback"):
        raise ValueError(eu_total)
    own = slice_predicate(slice_)
    measures = {"v": own}
    if rate is not None:
        of_rate = slice_predicate(rate["slice"])
        measures["p"] = of_rate & (F.col(rate["dim"]) == F.lit(rate["pos"]))
        measures["n"] = of_rate & (F.col(rate["dim"]) == F.lit(rate["neg"]))
    wanted = None
    for cond in measures.values():
        wanted = cond if wanted is None else wanted | cond
    geos = (clean.filter(wanted & F.col("value").isNotNull()).groupBy("year", "geo", "country", "nuts_level")
                 .agg(*[_pick(cond).alias(name) for name, cond in measures.items()]))
    peer = F.col("country").isNotNull() & (F.col("nuts_level") == F.lit(level)) & F.col("v").isNotNull()
    aggs = [F.collect_list(F.when(peer, F.col("v"))).alias("peers"),
            _pick(peer & (F.col("country") == F.lit(focus)), "v").alias("own"),
            _pick(F.col("geo") == F.lit(aggregate_geo), "v").alias("published"),
            F.sum(F.when(peer & F.col("country").isin(list(ref_group)), F.col("v"))).alias("computed")]
    for m in list(measures)[1:]:
        aggs += [_pick(F.col("geo") == F.lit(focus), m).alias(f"own_{m}"),
                 _pick(F.col("geo") == F.lit(aggregate_geo), m).alias(f"published_{m}"),
                 F.sum(F.when(F.col("geo").isin(list(ref_group)), F.col(m))).alias(f"computed_{m}")]
    years = geos.groupBy("year").agg(*aggs).filter(F.col("own").isNotNull())
    total = {"published": F.col("published"), "computed": F.col("computed"),
             "fallback": F.coalesce("published", "computed")}[eu_total]
    cols = [
        "year",
        to_bigint("own").alias(f"{measure}_it"),
        (F.size(F.filter("peers", lambda v: v > F.col("own"))) + 1).cast("long").alias("posizione_it"),
        F.size("peers").cast("long").alias("n_paesi"),
        to_bigint(total).alias(f"{measure}_ue27"),
        round_half_away(safe_div(F.col("own"), total) * F.lit(100), 2).alias("quota_it_su_ue27_pct"),
    ]
    if rate is not None:
        def rate_of(p: Column, n: Column) -> Column:
            return round_half_away(safe_div(p, p + n) * F.lit(100), 2)

        cols += [rate_of(F.col("own_p"), F.col("own_n")).alias("tasso_riconoscimento_it_pct"),
                 rate_of(F.coalesce("published_p", "computed_p"), F.coalesce("published_n", "computed_n"))
                 .alias("tasso_riconoscimento_ue27_pct")]
    return years.select(*cols)


def composition_gap(
    clean: DataFrame,
    slice_: Mapping[str, object],
    cat: str,
    categories: Sequence[str],
    total: str = "TOTAL",
    focus: str = "IT",
    ref_geo: str = EU27_AGGREGATE,
) -> DataFrame:
    """MRT-5: share of each category in the *published* total row (not the
    sum of categories, which may be incomplete), focus vs reference, and the
    gap in points. A category published on one side only stays, with NULLs.

    One aggregate per year holds both sides of every category; the rows come
    from an array of the (fixed) categories."""
    rows = clean.filter(slice_predicate(slice_) & F.col("geo").isin(focus, ref_geo)
                        & F.col(cat).isin(total, *categories) & F.col("value").isNotNull())
    sides = {"i": focus, "u": ref_geo}
    codes = [total, *categories]
    years = rows.groupBy("year").agg(*[
        _pick((F.col("geo") == F.lit(geo)) & (F.col(cat) == F.lit(code))).alias(f"{side}{k}")
        for side, geo in sides.items() for k, code in enumerate(codes)])

    def published(side: str, k: int) -> Column:
        return F.col(f"{side}{k}").isNotNull() & F.col(f"{side}0").isNotNull()

    def share(side: str, k: int) -> Column:
        return safe_div(F.col(f"{side}{k}"), F.col(f"{side}0")) * F.lit(100)

    items = F.array(*[F.struct(F.lit(code).alias("code"), (published("i", k) | published("u", k)).alias("any"),
                               share("i", k).alias("i"), share("u", k).alias("u"))
                      for k, code in enumerate(codes) if k])
    return (years.select("year", F.explode(items).alias("x")).filter(F.col("x.any")).select(
        "year", F.col("x.code").alias(cat), round_half_away("x.i", 2).alias("quota_it_pct"),
        round_half_away("x.u", 2).alias("quota_ue27_pct"),
        round_half_away(F.col("x.i") - F.col("x.u"), 2).alias("delta_pp")))


def mode_gap(
    clean: DataFrame,
    slice_: Mapping[str, object],
    mode_col: str,
    modes: Mapping[str, str],
    focus: str = "IT",
    ref_geo: str = EU27_AGGREGATE,
) -> DataFrame:
    """MRT-7: focus vs reference per labelled mode (``modes``: output label ->
    code). Rows exist where the focus country reports the mode; ``delta_pp``
    is NULL where the reference lacks it."""
    labels = F.create_map(*[F.lit(x) for lab, code in modes.items() for x in (code, lab)])
    rows = clean.filter(slice_predicate(slice_) & F.col(mode_col).isin(list(modes.values()))
                        & F.col("geo").isin(focus, ref_geo))
    of_focus = F.col("geo") == F.lit(focus)
    pairs = rows.groupBy("year", mode_col).agg(
        F.count_if(of_focus).alias("reports"), _pick(of_focus).alias("quota_it_pct"),
        _pick(F.col("geo") == F.lit(ref_geo)).alias("quota_ue27_pct"))
    return pairs.filter(F.col("reports") > 0).select(
        "year", F.element_at(labels, F.col(mode_col)).alias("modo"), "quota_it_pct", "quota_ue27_pct",
        round_half_away(F.col("quota_it_pct") - F.col("quota_ue27_pct"), 2).alias("delta_pp"))


def rate_by(
    clean: DataFrame,
    slice_: Mapping[str, object],
    keys: Sequence[str],
    dim: str,
    total: str,
    pos: str,
    neg: str,
    names: Sequence[str] = ("decisioni", "accolte", "dinieghi"),
    rate_col: str = "tasso_riconoscimento_pct",
    row_filter=None,
) -> DataFrame:
    """MRT-8b: per ``keys`` the TOTAL/POS/NEG values (BIGINT) and the rate
    ``100 * pos / NULLIF(pos + neg, 0)`` (2 dp)."""
    pred = slice_predicate(slice_) & F.col(dim).isin(total, pos, neg) & F.col("value").isNotNull()
    if row_filter is not None:
        pred = pred & row_filter
    g = clean.filter(pred).groupBy(*keys).agg(
        *[F.max(F.when(F.col(dim) == F.lit(code), F.col("value"))).alias(f"__{i}")
          for i, code in enumerate((total, pos, neg))])
    return g.select(
        *keys,
        to_bigint("__0").alias(names[0]), to_bigint("__1").alias(names[1]),
        to_bigint("__2").alias(names[2]),
        round_half_away(safe_div(F.lit(100.0) * F.col("__1"), F.col("__1") + F.col("__2")), 2)
        .alias(rate_col))
