"""Data-quality gates (DQ-1..DQ-17) as aggregate jobs.

Every check returns a small report DataFrame with the schema
``check_name string, subject string, n_checked long, n_bad long`` computed by one
aggregation over the checked table (partial aggregation, no row ever
collected), or a detail DataFrame where the check is a listing (coverage,
series breaks). ``run_gates`` combines reports and raises on failures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from regiocube.constants import EU27
from regiocube.functions.codes import is_member, slice_predicate
from regiocube.functions.numeric import round_half_away

REPORT_COLS = ("check_name", "subject", "n_checked", "n_bad")
BENCH_COLS = ("media_eu_value", "media_paese_value", "percentile_eu", "rank_nazionale",
              "distanza_media_eu_pct")


def _report(df: DataFrame, check: str, subject: str, bad: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_checked"),
                  F.count_if(bad).alias("n_bad")).select(
        F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), "n_checked", "n_bad")


def check_columns(spark: SparkSession, df: DataFrame, cols: Sequence[str], subject: str = "table"
                  ) -> DataFrame:
    """DQ-1: required columns present (schema only, no data read)."""
    missing = [c for c in cols if c not in df.columns]
    return spark.createDataFrame([("required_columns", subject, len(cols), len(missing))],
                                 "check_name string, subject string, n_checked long, n_bad long")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ-2: one aggregation counting NULLs of every column."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("subject"), F.col(f"__null_{i}").alias("n_bad"))
            for i, c in enumerate(cols)]
    return agg.select("__n", F.explode(F.array(*rows)).alias("r")).select(
        F.lit("not_null").alias("check_name"), "r.subject", F.col("__n").alias("n_checked"), "r.n_bad")


def check_min_rows(df: DataFrame, n: int) -> DataFrame:
    """DQ-3: at least ``n`` rows."""
    return df.agg(F.count(F.lit(1)).alias("n_checked")).select(
        F.lit("min_rows").alias("check_name"), F.lit(str(n)).alias("subject"), "n_checked",
        F.when(F.col("n_checked") < n, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("n_bad"))


def check_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-4: primary-key uniqueness: distinct keys checked, keys occurring
    more than once counted as bad (one shuffle on the key)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return _report(g, "primary_key", ",".join(keys), F.col("__n") > 1)


def check_slice_gating(bench: DataFrame, slice_: Mapping[str, object],
                       cols: Sequence[str] = BENCH_COLS) -> DataFrame:
    """DQ-6: benchmark columns are NULL on every row outside the slice."""
    outside = bench.filter(~F.coalesce(slice_predicate(slice_), F.lit(False)))
    any_set = None
    for c in cols:
        x = F.col(c).isNotNull()
        any_set = x if any_set is None else any_set | x
    return _report(outside, "slice_gating", ",".join(f"{k}={v}" for k, v in slice_.items()), any_set)


def check_rank_top(bench: DataFrame, slice_: Mapping[str, object], partition: Sequence[str]
                   ) -> DataFrame:
    """DQ-7: every rank-1 row holds the maximum of its national partition
    (window bounded by the regions of one country and level)."""
    rows = bench.filter(slice_predicate(slice_))
    top = F.max("value").over(Window.partitionBy(*partition))
    r = rows.select("rank_nazionale", "value", top.alias("__max")).filter(F.col("rank_nazionale") == 1)
    return _report(r, "rank_top", ",".join(partition), F.col("value") != F.col("__max"))


def check_complete(bench: DataFrame, slice_: Mapping[str, object], ref_group: Sequence[str] = EU27,
                   cols: Sequence[str] = BENCH_COLS) -> DataFrame:
    """DQ-8: reference-group rows of the slice carry every benchmark column."""
    rows = bench.filter(slice_predicate(slice_) & is_member("country", ref_group))
    any_null = None
    for c in cols:
        x = F.col(c).isNull()
        any_null = x if any_null is None else any_null | x
    return _report(rows, "complete", "reference group", any_null)


def check_non_ref_null(bench: DataFrame, ref_group: Sequence[str] = EU27) -> DataFrame:
    """DQ-9: rows outside the reference group have no percentile."""
    rows = bench.filter(~is_member("country", ref_group))
    return _report(rows, "non_ref_percentile_null", "percentile_eu", F.col("percentile_eu").isNotNull())


def check_trend(trend: DataFrame) -> DataFrame:
    """DQ-10: CAGR NULL on single-year windows; geo never NULL."""
    a = _report(trend, "cagr_single_year", "cagr_pct",
                (F.col("first_year") == F.col("last_year")) & F.col("cagr_pct").isNotNull())
    b = _report(trend, "not_null", "geo", F.col("geo").isNull())
    return a.unionByName(b)


def reconcile(mart: DataFrame, value_col: str, clean: DataFrame, slice_: Mapping[str, object],
              level: str, tol: float = 1.0, keys: Sequence[str] = ("year", "country")) -> DataFrame:
    """DQ-11: a country figure of a mart equals the roll-up of the clean
    regions of ``level`` within ``tol`` (rows without either side are not
    counted as checked)."""
    roll = (clean.filter(slice_predicate(slice_) & (F.col("nuts_level") == F.lit(level))
                         & F.col("value").isNotNull() & F.col("country").isNotNull())
                 .groupBy(*keys).agg(F.sum("value").alias("__roll")))
    j = mart.select(*keys, F.col(value_col).alias("__mart")).join(roll, list(keys), "inner")
    j = j.filter(F.col("__mart").isNotNull())
    return _report(j, "reconcile", f"{value_col}~{level}", F.abs(F.col("__mart") - F.col("__roll")) >= tol)


def check_additive(df: DataFrame, cat: str, parts: Sequence[str], total: str, keys: Sequence[str],
                   tol: float = 0.5) -> DataFrame:
    """DQ-12: the parts add up to the published total per key (keys where
    all parts and the total are present)."""
    g = df.filter(F.col(cat).isin(*parts, total) & F.col("value").isNotNull()).groupBy(*keys).agg(
        F.sum(F.when(F.col(cat).isin(list(parts)), F.col("value"))).alias("__parts"),
        F.count_if(F.col(cat).isin(list(parts))).alias("__np"),
        F.max(F.when(F.col(cat) == F.lit(total), F.col("value"))).alias("__total"))
    g = g.filter((F.col("__np") == len(parts)) & F.col("__total").isNotNull())
    return _report(g, "additive", f"{'+'.join(parts)}={total}",
                   F.abs(F.col("__parts") - F.col("__total")) > tol)


def check_flag(df: DataFrame, flag_col: str, rule: Column) -> DataFrame:
    """DQ-13: a boolean flag column agrees with its category rule."""
    return _report(df, "flag_rule", flag_col, ~F.col(flag_col).eqNullSafe(rule))


def check_labels(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """DQ-14: codes without a label (orphans), one aggregation for all dims."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(d).isNotNull() & F.col(f"{d}_label_en").isNull()).alias(f"__o{i}")
                   for i, d in enumerate(dims)])
    rows = [F.struct(F.lit(d).alias("subject"), F.col(f"__o{i}").alias("n_bad")) for i, d in enumerate(dims)]
    return agg.select("__n", F.explode(F.array(*rows)).alias("r")).select(
        F.lit("labels").alias("check_name"), "r.subject", F.col("__n").alias("n_checked"), "r.n_bad")


def coverage_by_year(df: DataFrame, keys: Sequence[str] = ("geo",), time_col: str = "year"
                     ) -> DataFrame:
    """DQ-15: distinct series with a value per year and the change against
    the previous year (a drop signals a source gap). One row per year."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    g = (df.filter(F.col("value").isNotNull()).groupBy(time_col)
           .agg(F.count_distinct(key).alias("n_series")))
    # One partition of at most |years| rows.
    prev = F.lag("n_series").over(Window.orderBy(time_col))
    return g.select(time_col, "n_series", prev.alias("n_prev"),
                    round_half_away((F.col("n_series") - prev) / prev * F.lit(100), 1).alias("change_pct"))


def series_breaks(df: DataFrame, keys: Sequence[str], threshold: float = 0.15,
                  time_col: str = "year") -> DataFrame:
    """DQ-16: year-on-year relative changes above ``threshold``, listed per
    series (window per series: one row per year, bounded)."""
    w = Window.partitionBy(*keys).orderBy(time_col)
    prev_v, prev_t = F.lag("value").over(w), F.lag(time_col).over(w)
    x = df.filter(F.col("value").isNotNull()).select(
        *keys, time_col, "value", prev_t.alias("prev_year"), prev_v.alias("prev_value"))
    rel = F.abs(F.col("value") / F.nullif(F.col("prev_value"), F.lit(0)) - F.lit(1))
    return x.filter(F.col("prev_value").isNotNull() & (rel > threshold)).select(
        *keys, time_col, "prev_year", "prev_value", "value")


def check_constant(df: DataFrame, col: str) -> DataFrame:
    """DQ-17: a column expected constant holds one distinct value."""
    g = df.agg(F.count_distinct(col).alias("__d"), F.count(F.lit(1)).alias("n_checked"))
    return g.select(F.lit("constant").alias("check_name"), F.lit(col).alias("subject"), "n_checked",
                    F.when(F.col("__d") > 1, F.col("__d") - 1).otherwise(F.lit(0)).cast("long").alias("n_bad"))


def check_stable(df: DataFrame, delta_col: str, limit: float, max_share: float) -> DataFrame:
    """DQ-17: few series move more than ``limit``; bad when the share of
    such series exceeds ``max_share`` (reported as the count of movers)."""
    g = df.agg(F.count(F.lit(1)).alias("n_checked"),
               F.count_if(F.abs(F.col(delta_col)) > limit).alias("__m"))
    return g.select(F.lit("stable").alias("check_name"), F.lit(delta_col).alias("subject"), "n_checked",
                    F.when(F.col("__m") > F.col("n_checked") * max_share, F.col("__m"))
                    .otherwise(F.lit(0)).cast("long").alias("n_bad"))


def check_tables(spark: SparkSession, present: Sequence[str], required: Sequence[str], subject: str) -> DataFrame:
    """DQ-5: the required tables have been written."""
    missing = [t for t in required if t not in present]
    return spark.createDataFrame([("required_tables", subject, len(required), len(missing))],
                                 "check_name string, subject string, n_checked long, n_bad long")


def table_gates(df: DataFrame, required: Sequence[str], not_null: Sequence[str], min_rows: int,
                subject: str) -> DataFrame:
    """DQ-1 + DQ-2 + DQ-3 in one aggregation over the table. A required
    column that is missing counts as bad; a column of ``not_null`` that is
    missing is NULL in every row."""
    present = [c for c in not_null if c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(present)])
    missing = len([c for c in required if c not in df.columns])

    def row(check: str, about: str, checked: Column, bad: Column) -> Column:
        return F.struct(F.lit(check).alias("check_name"), F.lit(about).alias("subject"),
                        checked.cast("long").alias("n_checked"), bad.cast("long").alias("n_bad"))

    rows = [row("required_columns", subject, F.lit(len(required)), F.lit(missing)),
            row("min_rows", str(min_rows), F.col("__n"), (F.col("__n") < min_rows).cast("int"))]
    for c in not_null:
        bad = F.col(f"__null_{present.index(c)}") if c in present else F.col("__n")
        rows.append(row("not_null", c, F.col("__n"), bad))
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


class TableMetrics:
    """DQ-1 to DQ-4 of a table, counted while it is written.

    ``attach`` puts the counts into the plan of the write itself (one scan, no
    second pass): rows and NULLs as observed metrics, and the key by the place of each
    row among those of its key. ``rows`` are the gates' report after the write.
    A column of ``not_null`` that is missing is NULL in every row; a key
    with a missing column is not checked, the missing column is reported.
    """

    def __init__(self, subject: str, required: Sequence[str] = (), not_null: Sequence[str] = (), min_rows: int = 0,
                 key: Sequence[str] = ()):
        self.subject, self.required, self.not_null, self.min_rows, self.key = subject, required, not_null, min_rows, key
        self._seen = Observation()
        self._columns: list[str] = []

    @property
    def _with_key(self) -> bool:
        return bool(self.key) and set(self.key) <= set(self._columns)

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the row's place among the rows of its key (one row per key where the gate holds)."""
        self._columns = df.columns
        if not self._with_key:
            return df
        return df.withColumn("__copy", F.row_number().over(Window.partitionBy(*self.key).orderBy(self.key[0])))

    def attach(self, df: DataFrame) -> DataFrame:
        """The plan to write: above any sort, since sampling for a sort runs what is below it twice."""
        self._columns = self._columns or df.columns
        present = [c for c in self.not_null if c in self._columns]
        counts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(present)]]
        if self._with_key:
            counts += [F.count_if(F.col("__copy") == k).alias(name) for k, name in ((1, "keys"), (2, "doubled"))]
        return df.observe(self._seen, *counts).drop("__copy")

    @property
    def n_rows(self) -> int:
        return self._seen.get["n"]

    def rows(self) -> list[dict]:
        """One row per gate, as ``run_gates`` returns them; only after the write."""
        seen = self._seen.get
        present = [c for c in self.not_null if c in self._columns]

        def row(check: str, subject: str, checked: int, bad: int) -> dict:
            return {"check_name": check, "subject": subject, "n_checked": checked, "n_bad": bad}

        out = [row("required_columns", self.subject, len(self.required), len([c for c in self.required if c not in self._columns])),
               row("min_rows", str(self.min_rows), seen["n"], int(seen["n"] < self.min_rows))]
        out += [row("not_null", c, seen["n"], seen[f"null_{present.index(c)}"] if c in present else seen["n"]) for c in self.not_null]
        if self._with_key:
            out.append(row("primary_key", ",".join(self.key), seen["keys"], seen["doubled"]))
        return out


class GateFailure(RuntimeError):
    pass


def run_gates(reports: Sequence[DataFrame], fail_on_error: bool = True) -> list[dict]:
    """DQ-5: combine the reports (a few rows each) and fail on any bad count.

    Only the report rows reach the driver: one row per check.
    """
    if not reports:
        return []
    allr = reports[0]
    for r in reports[1:]:
        allr = allr.unionByName(r)
    rows = [r.asDict() for r in allr.collect()]
    bad = [r for r in rows if r["n_bad"]]
    if bad and fail_on_error:
        raise GateFailure(f"{len(bad)} gate(s) failed: {bad}")
    return rows
