"""trend: first/last observed value per series, deltas and CAGR.

The published form looks each endpoint up with correlated scalar subqueries
(up to nine per row), which Spark would plan as one join per lookup. Here the
endpoints come from ``min_by/max_by`` over counted years: the rows of a series and
year are counted, then the first and last year are taken with their counts. Both
aggregations run on one exchange, on the series key. A series holds one row per
year, so no group is unbounded.

Two rows of one series at its first or last year make the lookup ambiguous, and
the published engine's scalar subqueries raise there. So does the plan:
the endpoint's value is an assertion on its count, evaluated where the value
is; no separate pass is needed. Years in between may repeat, as there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiocube.functions.codes import slice_predicate
from regiocube.functions.numeric import cagr_pct, round_half_away, safe_div
from regiocube.operators.enrich import analysable

DEFAULT_CARRY = ("geo_label_en", "nuts_level", "country")


def trend(
    clean: DataFrame,
    slice_: Mapping[str, object],
    keys: Sequence[str] = ("geo",),
    carry: Sequence[str] = DEFAULT_CARRY,
    round_abs: int = 2,
    round_pct: int = 1,
    round_cagr: int = 3,
    guard_last_nonneg: bool = False,
    time_col: str = "year",
) -> DataFrame:
    """MRT-3 / 3a / 3b.

    Per series (``keys`` + functionally dependent ``carry`` columns) over the
    slice rows with a value and a country: first/last year with data,
    ``years_observed = last - first``, first/last value,
    ``delta_abs = round(last - first)``,
    ``delta_pct = round((last / NULLIF(first, 0) - 1) * 100)``, and
    ``cagr_pct`` only when the window spans more than one year and the first
    value is positive (and, with ``guard_last_nonneg``, the last value is not
    negative). A series with two rows at its first or last year fails the job.
    """
    group = [*keys, *[c for c in carry if c not in keys]]
    ends = endpoints(clean, slice_, keys, carry, time_col)

    def only(end: str) -> Column:
        about = F.concat(F.lit(f"two observations at the {end} {time_col} of series "),
                         F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
        return F.when(F.col(f"{end}_rows") > 1, F.raise_error(about).cast("double")).otherwise(F.col(f"{end}_value"))

    g = ends.select(*group, "first_year", "last_year", only("first").alias("first_value"), only("last").alias("last_value"))
    fv, lv = F.col("first_value"), F.col("last_value")
    return g.select(
        *group, "first_year", "last_year",
        (F.col("last_year") - F.col("first_year")).alias("years_observed"),
        "first_value", "last_value",
        round_half_away(lv - fv, round_abs).alias("delta_abs"),
        round_half_away((safe_div(lv, fv) - F.lit(1)) * F.lit(100), round_pct).alias("delta_pct"),
        cagr_pct(fv, lv, "first_year", "last_year", round_cagr, guard_last_nonneg).alias("cagr_pct"),
    )


def endpoints(clean: DataFrame, slice_: Mapping[str, object], keys: Sequence[str] = ("geo",),
              carry: Sequence[str] = DEFAULT_CARRY, time_col: str = "year") -> DataFrame:
    """First and last year of each series, with the value there and how many rows hold that year.

    ``first_value`` and ``last_value`` are one of several where ``first_rows`` or ``last_rows`` is not 1.
    """
    group = [*keys, *[c for c in carry if c not in keys]]
    rows = analysable(clean).filter(slice_predicate(slice_)).select(*group, F.col(time_col).alias("__time"), "value")
    # One exchange: dealt by series, both aggregations find their rows together.
    years = rows.repartition(*group).groupBy(*group, "__time").agg(
        F.count(F.lit(1)).alias("__rows"), F.first("value").alias("__value"))
    held = F.struct("__value", "__rows")
    g = years.groupBy(*group).agg(F.min("__time").alias("first_year"), F.max("__time").alias("last_year"),
                                  F.min_by(held, "__time").alias("__first"), F.max_by(held, "__time").alias("__last"))
    return g.select(*group, "first_year", "last_year", F.col("__first.__value").alias("first_value"),
                    F.col("__last.__value").alias("last_value"), F.col("__first.__rows").alias("first_rows"),
                    F.col("__last.__rows").alias("last_rows"))
