"""Registered queries: each operator applied to the clean cubes of the test
tables. Every callable takes (spark, sf_dir) and returns a DataFrame.

The parameters mirror the published instances (slice, partition dims,
rounding); codes are those of the test-table encoding (see
``regiocube.sources.starcube``): benchmark unit ``EUR_HAB``, totals
``cat = 'TOTAL'``, the reference group = nations of region EUROPE, the focus
country = its first member, the published aggregate ``EU27_2020``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from regiocube.operators import benchmark as bm
from regiocube.operators import consumer as cq
from regiocube.operators import enrich as en
from regiocube.operators import quality as dq
from regiocube.sources.sdmx import read_sdmx_tsv as _read_tsv
from regiocube.sources.sdmx import wide_layout as _wide_layout
from regiocube.operators import position as po
from regiocube.operators import shares as sh
from regiocube.operators import synthesis as sy
from regiocube.operators import trend as tr
from regiocube.plans.cubes import cubes
from regiocube.session import scratch_root

Query = Callable[[SparkSession, str], DataFrame]

BENCH_SLICE = {"unit": "EUR_HAB", "cat": "TOTAL"}


def geo_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1: every region vs. reference-group peers of its level and its country."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark(c.clean(), BENCH_SLICE, ["unit", "cat"], c.ref, round_media=2)


def geo_benchmark_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1a: partitions without nuts_level (levels compared together)."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark(c.clean(), BENCH_SLICE, ["unit", "cat"], c.ref,
                            level_in_partition=False, round_media=2)


def geo_benchmark_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1b: pre-filtered slice, published aggregate value and pp distance."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark_published(c.clean(), {"unit": "EUR_HAB"}, ["cat"], c.ref)


def geo_benchmark_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1c: aggregate-then-join means over all countries."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark_joined(c.clean(), {"unit": "MIO_EUR", "cat": "TOTAL"}, ["unit"])


def geo_benchmark_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1 with ranks by value ranges: no level and year has to fit one task."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark(c.clean(), BENCH_SLICE, ["unit", "cat"], c.ref, round_media=2, bounded=False)


def geo_benchmark_country_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1a with ranks by value ranges."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark(c.clean(), BENCH_SLICE, ["unit", "cat"], c.ref, level_in_partition=False, round_media=2,
                            bounded=False)


def geo_benchmark_published_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1b with ranks by value ranges."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark_published(c.clean(), {"unit": "EUR_HAB"}, ["cat"], c.ref, bounded=False)


def geo_benchmark_joined_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-1c with ranks by value ranges."""
    c = cubes(spark, sf_dir)
    return bm.geo_benchmark_joined(c.clean(), {"unit": "MIO_EUR", "cat": "TOTAL"}, ["unit"], bounded=False)


TOTAL_EUR_HAB = {"unit": "EUR_HAB", "cat": "TOTAL"}
TOTAL_MIO_EUR = {"unit": "MIO_EUR", "cat": "TOTAL"}
TOTAL_NR = {"unit": "NR", "cat": "TOTAL"}


def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-3: per-region trend of amount per order (abs 1 dp, CAGR 2 dp)."""
    c = cubes(spark, sf_dir)
    return tr.trend(c.clean(), TOTAL_EUR_HAB, round_abs=1, round_cagr=2)


def trend_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-3 / DQ-4: the series whose first or last year has two observations, with
    their counts (``trend`` itself fails on them); the clean table with some years doubled."""
    rows = cubes(spark, sf_dir).clean()
    twice = rows.unionByName(rows.filter((F.col("nuts_level") == "NUTS1") & F.col("year").isin(1992, 1995))).unionByName(
        rows.filter((F.col("nuts_level") == "country") & (F.col("year") == 1998)))
    ends = tr.endpoints(twice, TOTAL_NR)
    return ends.filter("first_rows > 1 or last_rows > 1").select("geo", "first_year", "last_year", "first_rows", "last_rows")


def trend_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-3a: trend per region and category."""
    c = cubes(spark, sf_dir)
    return tr.trend(c.clean(), {"unit": "NR"}, keys=("geo", "cat"),
                    carry=("geo_label_en", "nuts_level", "country", "cat_label_en"))


def trend_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-3a: trend per region and calendar month (deseasonalised)."""
    c = cubes(spark, sf_dir)
    return tr.trend(c.monthly(), TOTAL_NR, keys=("geo", "month"),
                    carry=("geo_label_en", "nuts_level", "country", "month_label_en"), round_abs=1)


def trend_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-3b: CAGR additionally requires a non-negative last value."""
    c = cubes(spark, sf_dir)
    return tr.trend(c.clean(), TOTAL_MIO_EUR, guard_last_nonneg=True)


def synthesis_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1: country-row pivot of three units, ranked by amount per order."""
    c = cubes(spark, sf_dir)
    return sy.country_synthesis(
        c.clean(), {"amount_per_order": TOTAL_EUR_HAB, "lines": TOTAL_NR, "amount": TOTAL_MIO_EUR},
        ref_group=c.ref)


def synthesis_pivot_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with a breakdown dim: one ranking per category (line counts:
    integer-valued, so the group mean is exact in any summation order)."""
    c = cubes(spark, sf_dir)
    return sy.country_synthesis(c.clean(), {"lines": {"unit": "NR"}}, dims=["cat"],
                                ref_group=c.ref)


def synthesis_pivot_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, multi-metric flavour: country label, ``is_eu``, ranked by the
    second metric."""
    c = cubes(spark, sf_dir)
    return sy.country_synthesis(
        c.clean(), {"lines": TOTAL_NR, "amount_per_order": TOTAL_EUR_HAB, "amount": TOTAL_MIO_EUR},
        ref_group=c.ref, rank_by="amount_per_order", rank_col="rank_eu", with_label=True,
        emit_is_eu=True)


def synthesis_rollup_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2: country total = SUM over NUTS2 regions, rounded to units."""
    c = cubes(spark, sf_dir)
    return sy.country_rollup(c.clean(), TOTAL_NR, "lines", level="NUTS2", agg="sum",
                             round_metric=0, ref_group=c.ref)


def synthesis_rollup_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2: country value = unweighted AVG over NUTS2 regions, 1 dp."""
    c = cubes(spark, sf_dir)
    return sy.country_rollup(c.clean(), TOTAL_EUR_HAB, "amount_per_order", level="NUTS2",
                             agg="avg", round_metric=1, ref_group=c.ref)


def synthesis_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: direct country rows rounded before rank and distance."""
    c = cubes(spark, sf_dir)
    return sy.country_direct(c.clean(), TOTAL_MIO_EUR, "amount", round_metric=0, ref_group=c.ref)


def synthesis_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4: NUTS3 roll-up gated by full regional coverage."""
    c = cubes(spark, sf_dir)
    return sy.country_rollup_covered(c.clean(), TOTAL_NR, "lines", level="NUTS3", ref_group=c.ref)


def synthesis_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5: two pivoted metrics, two ranks, NUTS3 reconciliation column."""
    c = cubes(spark, sf_dir)
    return sy.country_synthesis_reconciled(
        c.clean(), {"amount_per_order": TOTAL_EUR_HAB, "amount": TOTAL_MIO_EUR},
        {"amount_per_order": "rank_procapite_eu", "amount": "rank_totale_eu"},
        TOTAL_MIO_EUR, "amount_nuts3_sum", ref_group=c.ref)


def synthesis_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6: country values vs. the published aggregate (pp distance, rank)."""
    c = cubes(spark, sf_dir)
    return sy.country_vs_published(c.clean(), {"unit": "EUR_HAB"}, ["cat"], "amount_per_order",
                                   ref_group=c.ref)


def synthesis_ungated_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 with ranks by value ranges."""
    c = cubes(spark, sf_dir)
    return sy.country_ranking(c.clean(), TOTAL_MIO_EUR, "amount", bounded=False)


def synthesis_ungated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7: rank of every country, no reference-group gate."""
    c = cubes(spark, sf_dir)
    return sy.country_ranking(c.clean(), TOTAL_MIO_EUR, "amount")


def position_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-4: focus country rank/share vs. the published aggregate row."""
    c = cubes(spark, sf_dir)
    return po.position_share(c.clean(), TOTAL_NR, c.focus, "published", ref_group=c.ref)


def position_computed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-4: share of the SUM over reference-group countries."""
    c = cubes(spark, sf_dir)
    return po.position_share(c.clean(), TOTAL_MIO_EUR, c.focus, "computed", ref_group=c.ref)


def position_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-4: published total where present, else the computed sum."""
    c = cubes(spark, sf_dir)
    return po.position_share(c.clean(), TOTAL_NR, c.focus, "fallback", measure="domande",
                             ref_group=c.ref)


def recognition_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-4 fallback + MRT-8a: adds POS/(POS+NEG) rates, focus and group."""
    c = cubes(spark, sf_dir)
    return po.position_share(
        c.clean(), TOTAL_NR, c.focus, "fallback", measure="decisioni", ref_group=c.ref,
        rate={"dim": "cat", "pos": "A", "neg": "R", "slice": {"unit": "NR"}})


def recognition_rate_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-8b: TOTAL/POS/NEG and the rate per region-year."""
    c = cubes(spark, sf_dir)
    return po.rate_by(c.clean(), {"unit": "NR"},
                      ["year", "geo", "geo_label_en", "nuts_level", "country"],
                      "cat", "TOTAL", "A", "R")


def composition_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-5: category shares of the published total, focus vs aggregate."""
    c = cubes(spark, sf_dir)
    return po.composition_gap(c.clean(), {"unit": "NR"}, "cat", ["A", "N", "R"], "TOTAL",
                              focus=c.focus)


MODES = {"accepted": "A", "not_returned": "N", "returned": "R"}


def mode_gap_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-7 (three modes): focus share vs aggregate share per mode."""
    c = cubes(spark, sf_dir)
    return po.mode_gap(c.clean(), {"unit": "PC"}, "cat", MODES, focus=c.focus)


def mode_gap_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-7 (two modes, inner on the focus side)."""
    c = cubes(spark, sf_dir)
    return po.mode_gap(c.clean(), {"unit": "PC"}, "cat", {"accepted": "A", "returned": "R"},
                       focus=c.focus)


def share_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-6: mode shares, their sum and the residual."""
    c = cubes(spark, sf_dir)
    return sh.share_pivot(c.clean(), {"unit": "PC"}, "cat",
                          {"A": "quota_a_pct", "N": "quota_n_pct", "R": "quota_r_pct"})


def share_pivot_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-6 (two modes, residual only)."""
    c = cubes(spark, sf_dir)
    return sh.share_pivot(c.clean(), {"unit": "PC"}, "cat", {"A": "quota_a_pct", "R": "quota_r_pct"},
                          with_sum=False)


def flagged_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-9: line counts with the non-additive TOTAL flagged."""
    c = cubes(spark, sf_dir)
    return sh.flagged_slice(c.clean(), {"unit": "NR"}, "cat", ["TOTAL"], "lines")


def citizenship_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-10: counts by supplier nation, real countries only."""
    c = cubes(spark, sf_dir)
    return sh.citizenship_slice(c.citizen(), {"unit": "NR"}, "persone")


def complement_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-11: total vs own-nation suppliers, complement and its share."""
    c = cubes(spark, sf_dir)
    return sh.complement_share(c.citizen(), {"unit": "NR"}, "citizen", "TOTAL", "NAT")


def item_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-12: categories -> columns per (year, country, unit) + derived."""
    c = cubes(spark, sf_dir)
    return sh.item_pivot(
        c.clean(), "cat",
        {"TOTAL": "total", "A": "accepted", "N": "not_returned", "R": "returned"},
        {"net_of_returns": [(1, "TOTAL"), (-1, "A"), (1, "R")]},
        units=["NR", "MIO_EUR"])


def quarterly_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-13: country quarterly series of selected categories."""
    c = cubes(spark, sf_dir)
    q = c.quarterly()
    return sh.extract(q, F.col("country").isNotNull() & F.col("cat").isin("TOTAL", "A", "R")
                      & (F.col("unit") == "NR"),
                      ["year", "quarter", "country", "geo", "geo_label_en", "nuts_level",
                       "cat", "cat_label_en", "unit", "value"])


def quarterly_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-13: the focus country's quarterly total, value renamed."""
    c = cubes(spark, sf_dir)
    q = c.quarterly()
    return sh.extract(q, (F.col("geo") == c.focus) & (F.col("cat") == "TOTAL"),
                      ["year", "quarter", "value"], {"value": "lines"})


def quarterly_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-13: focus, aggregate and a peer set side by side."""
    c = cubes(spark, sf_dir)
    q = c.quarterly()
    peers = [c.focus, "EU27_2020", *c.ref[1:], "01", "02"]
    return sh.extract(q, F.col("geo").isin(peers) & (F.col("cat") == "TOTAL"),
                      ["year", "quarter", "geo", "geo_label_en", "value"], {"value": "lines"})


def unit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-14: two units of the focus country's NUTS1/NUTS2 regions side by side."""
    c = cubes(spark, sf_dir)
    where = F.col("geo").startswith(c.focus) & F.col("nuts_level").isin("NUTS1", "NUTS2")
    return sh.unit_join(c.clean(), "MIO_EUR", "NR", ["year", "geo", "cat"], where,
                        names=("amount", "lines"))


def unit_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-14: plain one-unit extract."""
    c = cubes(spark, sf_dir)
    return sh.extract(c.clean(), (F.col("unit") == "MIO_EUR") & F.col("value").isNotNull(),
                      ["year", "geo", "geo_label_en", "nuts_level", "country", "cat", "cat_label_en",
                       "value"], {"value": "amount"})


def stock_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-15: counts without the heterogeneous total, as BIGINT."""
    c = cubes(spark, sf_dir)
    from regiocube.functions.numeric import to_bigint
    return sh.extract(c.clean(), (F.col("unit") == "NR") & F.col("cat").isNotNull()
                      & (F.col("cat") != "TOTAL") & F.col("value").isNotNull(),
                      ["year", "geo", "geo_label_en", "nuts_level", "country", "cat", "cat_label_en",
                       to_bigint("value").alias("lines")])


def stock_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MRT-15: a ratio taken as published (share of category A)."""
    c = cubes(spark, sf_dir)
    return sh.extract(c.clean(), (F.col("unit") == "PC") & (F.col("cat") == "A")
                      & F.col("value").isNotNull(),
                      ["year", "geo", "geo_label_en", "nuts_level", "country", "value"],
                      {"value": "share_a_pct"})


# ------------------------------------------------------ enrichment / ingest
def enrich_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-1/2/3: the whole clean table (labels, hierarchy, country, flags)."""
    return cubes(spark, sf_dir).clean()


def derive_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-3: country derived only for geographies with a level."""
    c = cubes(spark, sf_dir)
    return c.clean().select("geo", "nuts_level", "country").distinct()


def split_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-4: ``YYYY-Qn`` -> year INT + quarter."""
    c = cubes(spark, sf_dir)
    return en.with_period_split(c.quarterly_raw(), "year").select(
        "geo", "cat", "year", "quarter", "value")


def map_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-6c: month number -> month name (inline label map)."""
    c = cubes(spark, sf_dir)
    return c.monthly().select("geo", "cat", "year", "month", "month_label_en", "value")


def build_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-7: geo hierarchy from labels + LEVEL/IS_STANDARD_CODE annotations."""
    return cubes(spark, sf_dir).geo()


wide_frame = _wide_layout


def _landed_obs(spark: SparkSession, sf_dir: str, source_filter=None) -> DataFrame:
    """The raw layer as ingest sees it: the wide SDMX TSV landed once per
    build and read back by ``read_sdmx_tsv`` (SRC-1)."""
    return _read_tsv(spark, cubes(spark, sf_dir).landed_tsv(), source_filter=source_filter)


def melt_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1: wide SDMX layout -> long observations (value, flag, ':' -> NULL)."""
    return _landed_obs(spark, sf_dir)


def source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2: keep only the totals slice right after the melt."""
    return _landed_obs(spark, sf_dir, {"unit": "NR", "cat": "TOTAL"})


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-8: melted observations without a value are rejected."""
    return en.drop_incomplete(_landed_obs(spark, sf_dir))


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured Streaming landing: the raw annual observations land as
    parquet in a fresh folder under the session's checkpoint dir and an
    ``availableNow`` stream enriches them into the clean table (stream-static
    joins with the bounded dimensions, exactly-once per landed file)."""
    import uuid

    from regiocube.constants import FLAG_LABELS, FREQ_LABELS
    from regiocube.sources import starcube as sc
    from regiocube.streaming.landing import clean_stream

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "stream")
    c.obs().write.parquet(f"{run}/landing/batch-0")
    q = clean_stream(
        spark, f"{run}/landing/*", ["freq", "unit", "cat", "geo"], c.geo(), f"{run}/clean",
        name=f"landing_{uuid.uuid4().hex[:8]}",
        codelists={"freq": sc.codelist(spark, FREQ_LABELS), "unit": sc.codelist(spark, sc.UNIT_LABELS),
                   "cat": sc.codelist(spark, sc.CAT_LABELS)},
        flags=sc.codelist(spark, FLAG_LABELS), checkpoint_dir=f"{run}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{run}/clean")


# ---------------------------------------------------------- sources / sinks
def _scratch_run(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the session's shared scratch folder, removed when
    this process ends (its rows are read until then)."""
    import atexit
    import uuid

    root = scratch_root(spark)
    if root is None:
        raise RuntimeError("no shared scratch folder: set spark.checkpoint.dir")
    path = f"{root.rstrip('/')}/regiocube-io/{kind}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended before
        return
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def sdmx_tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 from a real file: the wide layout is written as tab-separated
    text (one header line per part file) and read back by ``read_sdmx_tsv``."""
    from regiocube.sources.sdmx import read_sdmx_tsv, write_sdmx_tsv

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "sdmx")
    write_sdmx_tsv(wide_frame(c.obs()), run)
    return read_sdmx_tsv(spark, run)


def sdmx_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, a folder of files with different periods: the years up to 1996
    and those from 1996 on land as wide files of their own and are read
    together; values bind to their year by name."""
    from regiocube.sources.sdmx import read_sdmx_tsv, write_sdmx_tsv

    obs, run = cubes(spark, sf_dir).obs(), _scratch_run(spark, "sdmx-folder")
    for part in (F.col("year") <= 1996, F.col("year") >= 1996):
        write_sdmx_tsv(wide_frame(obs.filter(part)), run, mode="append")
    return en.drop_incomplete(read_sdmx_tsv(spark, run))


def support_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: a support file (the citizenship codes) landed as CSV labels the
    raw citizenship cube."""
    from regiocube.sources import starcube as sc
    from regiocube.sources.readers import read_codelist

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "support")
    sc.citizen_codelist(spark, c.geo()).write.option("header", "true").option("escape", '"').csv(run)
    return en.enrich_labels(c.citizen().drop("citizen_label_en"), {"citizen": read_codelist(spark, run, "csv")})


def cast_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-5: observations as text, suppressed values as ``NaN`` and the values
    of one year as junk, cast back (junk and NaN become NULL)."""
    text = (F.when(F.col("value").isNull(), F.lit("NaN")).when(F.col("year") == 1995, F.lit("n/a"))
            .otherwise(F.col("value").cast("string")))
    raw = cubes(spark, sf_dir).obs().select("unit", "cat", "geo", F.col("year").cast("string").alias("year"),
                                            text.alias("value"))
    return en.cast_observations(raw)


def _mapped(spark: SparkSession, sf_dir: str, mapping: dict, default: str | None) -> DataFrame:
    rows = cubes(spark, sf_dir).obs().select("unit", "cat", "geo", "year")
    return en.with_mapped_labels(rows, {"cat": (mapping, default)})


def map_labels_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-6a: inline label map; an unknown code is its own label."""
    return _mapped(spark, sf_dir, {"A": "Accepted", "R": "Returned"}, "code")


def map_labels_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-6b: inline label map; an unknown code has no label."""
    return _mapped(spark, sf_dir, {"A": "Accepted", "R": "Returned"}, None)


def map_labels_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR-6d: the code itself is the label."""
    return _mapped(spark, sf_dir, {}, "code")


def _codelists(spark: SparkSession) -> dict[str, DataFrame]:
    from regiocube.constants import FLAG_LABELS, FREQ_LABELS
    from regiocube.sources import starcube as sc

    return {"freq": sc.codelist(spark, FREQ_LABELS), "unit": sc.codelist(spark, sc.UNIT_LABELS),
            "cat": sc.codelist(spark, sc.CAT_LABELS), "flag": sc.codelist(spark, FLAG_LABELS)}


def clean_monthly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly dataset run end to end (land, clean, mart, gates); its written clean table."""
    from regiocube.constants import MONTH_LABELS
    from regiocube.plans.runner import run_dataset
    from regiocube.plans.spec import DatasetSpec, MartSpec
    from regiocube.sources import starcube as sc

    c, run = cubes(spark, sf_dir), _scratch_run(spark, "monthly")
    spec = DatasetSpec(
        slug="star-monthly", dataflow="STAR_M", dims=("freq", "unit", "cat", "geo"), codelist_dims=("cat",),
        label_maps={"month": (MONTH_LABELS, None)}, period="month", not_null=("geo", "year", "month"),
        marts=(MartSpec("mart_trend", lambda clean: tr.trend(
            clean, TOTAL_NR, keys=("geo", "month"), carry=("geo_label_en", "nuts_level", "country", "month_label_en")),
            ("geo", "month"), 1, ("country", "month", "nuts_level", "geo"), ("cagr_pct",), TOTAL_NR,
            ("geo", "month", "year")),))
    run_dataset(spark, spec, sc.monthly_obs(c.cells(), c.ref), c.geo(), _codelists(spark), run, 2026)
    return spark.read.parquet(f"{run}/star-monthly/2026/clean.parquet")


def _annual_spec(slug: str):
    """The annual cube as a dataset with one mart."""
    from regiocube.plans.spec import DatasetSpec, MartSpec

    return DatasetSpec(
        slug=slug, dataflow="STAR_A", dims=("freq", "unit", "cat", "geo"), codelist_dims=("cat",),
        marts=(MartSpec("mart_trend", lambda clean: tr.trend(clean, TOTAL_EUR_HAB), ("geo",), 10,
                        ("country", "nuts_level", "geo"), ("geo_label_en", "cagr_pct"), TOTAL_EUR_HAB, ("geo", "year")),))


GATE_COLUMNS = "check_name string, subject string, n_checked long, n_bad long"


def dq_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-1 (with DQ-2/3 in the same pass): the declared columns of the clean
    table, and one that it does not have."""
    spec = _annual_spec("star-annual")
    return dq.table_gates(cubes(spark, sf_dir).clean(), (*spec.required_columns, "absent"), ("geo", "absent"), 1000,
                          "clean")


def dq_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-5: the gate report of a whole dataset run (one row per gate)."""
    from regiocube.plans.runner import run_dataset

    c, run = cubes(spark, sf_dir), _scratch_run(spark, "gates")
    rows = run_dataset(spark, _annual_spec("star-annual"), c.obs(), c.geo(), _codelists(spark), run, 2026)
    return spark.createDataFrame([(r["check_name"], r["subject"], r["n_checked"], r["n_bad"]) for r in rows], GATE_COLUMNS)


def failed_gate_keeps_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-5 / SNK-2: a vintage is published, then a run on half the observations fails a
    gate of its mart; the published trend mart as it is read afterwards."""
    import dataclasses

    from regiocube.plans.runner import run_dataset
    from regiocube.plans.vintage import vintage_folder

    c, run, spec = cubes(spark, sf_dir), _scratch_run(spark, "kept"), _annual_spec("star-annual")
    run_dataset(spark, spec, c.obs(), c.geo(), _codelists(spark), run, 2026)
    strict = dataclasses.replace(spec, marts=tuple(dataclasses.replace(m, min_rows=1 << 40) for m in spec.marts))
    try:
        run_dataset(spark, strict, c.obs().filter("year < 1996"), c.geo(), _codelists(spark), run, 2026)
        raise AssertionError("the gate did not fail")
    except dq.GateFailure:
        pass
    return spark.read.parquet(f"{vintage_folder(run, 'star-annual', 2026)}/mart_trend.parquet")


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-6: a batch of three datasets, one of which lacks a codelist and
    one of which has each observation twice; the batch goes on. One row per
    dataset, with the clean rows that its run left."""
    from regiocube.plans.runner import run_all
    from regiocube.plans.vintage import rejected_folder, vintage_folder

    c, run = cubes(spark, sf_dir), _scratch_run(spark, "batch")
    lists = _codelists(spark)
    out = run_all(spark, {s: _annual_spec(s) for s in ("whole", "doubled")},
                  {"whole": c.obs(), "doubled": c.obs().unionByName(c.obs())}, c.geo(), lists, run, 2026)
    out += run_all(spark, {"unlabelled": _annual_spec("unlabelled")}, {"unlabelled": c.obs()}, c.geo(),
                   {k: v for k, v in lists.items() if k != "cat"}, run, 2026)
    ended = spark.createDataFrame([(r["dataset"], r["n_bad"]) for r in out if r["check_name"] == "dataset_run"],
                                  "dataset string, n_bad long")
    rows = None
    for slug in ("whole", "doubled", "unlabelled"):
        folder = vintage_folder if slug == "whole" else rejected_folder
        n = (spark.read.parquet(f"{folder(run, slug, 2026)}/clean.parquet").agg(F.count(F.lit(1)).alias("clean_rows"))
             .withColumn("dataset", F.lit(slug)))
        rows = n if rows is None else rows.unionByName(n)
    return ended.join(rows, "dataset").select("dataset", "n_bad", "clean_rows")


def clean_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 + SRC-7: the clean table written partitioned by year, read back."""
    from regiocube.sources.sinks import write_clean

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "clean")
    write_clean(c.clean(), run)
    return spark.read.parquet(run)


def geo_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3 + SRC-4: the hierarchy as one CSV and back (blank -> NULL)."""
    from regiocube.sources.readers import read_geo
    from regiocube.sources.sinks import write_geo

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "geo")
    write_geo(c.geo(), run)
    return read_geo(spark, run)


def latest_vintage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6: two landed vintages (an older, shorter one and the current
    one); only the newest folder is read."""
    from regiocube.sources.readers import read_latest

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "vintages")
    c.obs().filter(F.col("year") <= 1999).write.parquet(f"{run}/2025")
    c.obs().write.parquet(f"{run}/2026")
    return read_latest(spark, run)


def landed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6: two landed vintages, the newer one in folders by unit and year; its
    partitions are one table, and the columns in folder names keep their declared types."""
    from regiocube.plans.runner import land

    c, run = cubes(spark, sf_dir), _scratch_run(spark, "partitions")
    c.obs().filter(F.col("year") <= 1999).write.parquet(f"{run}/2025")
    c.obs().write.partitionBy("unit", "year").parquet(f"{run}/2026")
    return land(spark, _annual_spec("star-annual"), run)


def landed_csv_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6: observations landed as CSV with a declared delimiter and encoding."""
    import dataclasses

    from regiocube.plans.runner import land

    c, run = cubes(spark, sf_dir), _scratch_run(spark, "options")
    c.obs().write.option("header", "true").option("sep", ";").option("encoding", "ISO-8859-1").csv(run)
    spec = dataclasses.replace(_annual_spec("star-annual"), read_options={"delimiter": ";", "encoding": "ISO-8859-1"})
    return land(spark, spec, run)


def typed_csv_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: observations landed as CSV text in another column order, read
    with the declared types bound by column name."""
    from regiocube.sources.readers import read_obs

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "typed")
    schema = "freq string, unit string, cat string, geo string, year int, value double, flag string"
    c.obs().select("value", "geo", "flag", "year", "cat", "unit", "freq").write.option(
        "header", "true").csv(run)
    return read_obs(spark, run, schema, fmt="csv")


def codelist_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3: the citizenship codelist (country labels of the hierarchy plus
    the aggregate codes) lands as parquet under the irregular header
    ``(code, description_en)``; ``read_codelist`` normalises it and the
    raw citizenship cube is labelled from it (ENR-1)."""
    from regiocube.sources import starcube as sc
    from regiocube.sources.readers import read_codelist

    c = cubes(spark, sf_dir)
    run = _scratch_run(spark, "codelist")
    cl = sc.citizen_codelist(spark, c.geo())
    cl.select("code", F.col("label_en").alias("description_en")).write.parquet(run)
    cl = read_codelist(spark, run)
    return en.enrich_labels(c.citizen().drop("citizen_label_en"), {"citizen": cl})


def mart_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2 + SNK-4: the benchmark mart published in its row order and read
    back from ``<root>/<slug>/<vintage>/<mart>.parquet``."""
    from regiocube.sources.sinks import write_mart

    run = _scratch_run(spark, "marts")
    bench = geo_benchmark(spark, sf_dir)
    path = write_mart(bench, run, "star-cube", 2026, "mart_geo_benchmark",
                      sort_keys=["-year", "nuts_level", "country", "geo", "unit", "cat"])
    return spark.read.parquet(path)


# ---------------------------------------------------------- data quality
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-2 on the clean table."""
    return dq.check_not_null(cubes(spark, sf_dir).clean(), ["geo", "year", "value", "country"])


def dq_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-4: (freq, unit, cat, geo, year) is the clean table's key."""
    return dq.check_key(cubes(spark, sf_dir).clean(), ["freq", "unit", "cat", "geo", "year"])


def dq_min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-3 on the benchmark mart."""
    return dq.check_min_rows(geo_benchmark(spark, sf_dir), 1000)


def dq_slice_gating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-6: benchmark columns NULL outside the reference slice."""
    return dq.check_slice_gating(geo_benchmark(spark, sf_dir), BENCH_SLICE)


def dq_rank_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-7: rank 1 is the national maximum."""
    return dq.check_rank_top(geo_benchmark(spark, sf_dir), BENCH_SLICE,
                             ["year", "country", "nuts_level", "unit", "cat"])


def dq_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-8: reference-group slice rows are complete."""
    c = cubes(spark, sf_dir)
    return dq.check_complete(geo_benchmark(spark, sf_dir), BENCH_SLICE, c.ref)


def dq_non_ref_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-9: no percentile outside the reference group."""
    c = cubes(spark, sf_dir)
    return dq.check_non_ref_null(geo_benchmark(spark, sf_dir), c.ref)


def dq_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-10 on the trend mart."""
    return dq.check_trend(trend(spark, sf_dir))


def dq_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-11: country amount vs. roll-up of NUTS3 amounts (tolerance 1)."""
    c = cubes(spark, sf_dir)
    return dq.reconcile(synthesis_reconciled(spark, sf_dir), "amount", c.clean(), TOTAL_MIO_EUR, "NUTS3")


def dq_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-12: category line counts add up to the total."""
    c = cubes(spark, sf_dir)
    return dq.check_additive(c.clean().filter(F.col("unit") == "NR"), "cat", ["A", "N", "R"], "TOTAL",
                             ["year", "geo"])


def dq_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-13: is_total agrees with cat = 'TOTAL'."""
    return dq.check_flag(flagged_slice(spark, sf_dir), "is_total", F.col("cat") == "TOTAL")


def dq_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-14: no orphan codes in the clean table."""
    return dq.check_labels(cubes(spark, sf_dir).clean(), ["freq", "unit", "cat", "geo"])


def dq_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-15: NUTS3 series with data per year and the year-on-year change."""
    c = cubes(spark, sf_dir)
    rows = c.clean().filter((F.col("nuts_level") == "NUTS3") & (F.col("unit") == "NR")
                            & (F.col("cat") == "TOTAL"))
    return dq.coverage_by_year(rows, ["geo"])


def dq_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-16: country series moving more than 15 % year on year."""
    c = cubes(spark, sf_dir)
    rows = c.clean().filter((F.col("nuts_level") == "country") & (F.col("unit") == "EUR_HAB")
                            & (F.col("cat") == "TOTAL"))
    return dq.series_breaks(rows, ["geo"], 0.15)


def dq_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-17: the clean table holds a single frequency."""
    return dq.check_constant(cubes(spark, sf_dir).clean(), "freq")


def dq_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-17: at most 5 % of region series move more than 50 % end to end."""
    return dq.check_stable(trend(spark, sf_dir), "delta_pct", 50.0, 0.05)


# ------------------------------------------------------- consumer queries
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-2: the first ten rows of the clean table in key order."""
    c = cubes(spark, sf_dir)
    return cq.preview(c.clean(), ["freq", "unit", "cat", "geo", "year"], 10)


def top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-1: per year, the 10 NUTS3 regions of the focus country with the
    highest amount per order (ties broken by code)."""
    c = cubes(spark, sf_dir)
    rows = c.clean().filter(F.col("geo").startswith(c.focus) & (F.col("nuts_level") == "NUTS3")
                            & (F.col("unit") == "EUR_HAB") & (F.col("cat") == "TOTAL")
                            & F.col("value").isNotNull()).select("year", "geo", "geo_label_en", "value")
    return cq.top_k(rows, ["year"], [F.col("value").desc(), F.col("geo").asc()], 10)


def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-1: a published vintage as views, asked in SQL: the focus country's ten
    highest regions of one year (only that year's folder is read)."""
    from regiocube.plans.runner import register_views, run_dataset

    c, run = cubes(spark, sf_dir), _scratch_run(spark, "views")
    run_dataset(spark, _annual_spec("star-annual"), c.obs(), c.geo(), _codelists(spark), run, 2026)
    register_views(spark, run, "star-annual", 2026)
    return spark.sql(f"""
        SELECT geo, geo_label_en, value FROM star_annual_clean
        WHERE geo LIKE '{c.focus}%' AND year = 1995 AND nuts_level = 'NUTS3' AND unit = 'EUR_HAB' AND cat = 'TOTAL'
              AND value IS NOT NULL
        ORDER BY value DESC, geo LIMIT 10""")


def rows_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-3: clean rows per NUTS level."""
    return cq.count_by(cubes(spark, sf_dir).clean(), "nuts_level")


def category_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-4: mean line count of category A vs R per year and level, and the
    gap. (Counts are integer-valued: the means are exact in any summation
    order, which a mean of 1-decimal shares is not across engines.)"""
    c = cubes(spark, sf_dir)
    rows = c.clean().filter((F.col("unit") == "NR") & F.col("country").isNotNull())
    return cq.group_gap(rows, ["year", "nuts_level"], "cat", "A", "R")


def growth_vs_decline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-4: growing vs declining regions per level (trend mart)."""
    return cq.sign_counts(trend(spark, sf_dir), ["nuts_level"], "delta_pct")


def cross_mart_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QRY-5: two synthesis marts joined on (year, country): lines of
    category A vs lines of category R."""
    c = cubes(spark, sf_dir)
    a = sy.country_direct(c.clean(), {"unit": "NR", "cat": "A"}, "lines_a", ref_group=c.ref)
    b = sy.country_direct(c.clean(), {"unit": "NR", "cat": "R"}, "lines_r", ref_group=c.ref)
    return cq.compare_marts(a, b, ["year", "country"], "lines_a", "lines_r")


QUERIES: dict[str, Query] = {
    "geo_benchmark": geo_benchmark,
    "geo_benchmark_country": geo_benchmark_country,
    "geo_benchmark_published": geo_benchmark_published,
    "geo_benchmark_joined": geo_benchmark_joined,
    "geo_benchmark_ranged": geo_benchmark_ranged,
    "geo_benchmark_country_ranged": geo_benchmark_country_ranged,
    "geo_benchmark_published_ranged": geo_benchmark_published_ranged,
    "geo_benchmark_joined_ranged": geo_benchmark_joined_ranged,
    "synthesis_ungated_ranged": synthesis_ungated_ranged,
    "failed_gate_keeps_vintage": failed_gate_keeps_vintage,
    "landed_partitions": landed_partitions,
    "landed_csv_options": landed_csv_options,
    "adhoc_sql": adhoc_sql,
    "trend": trend,
    "trend_duplicates": trend_duplicates,
    "trend_by_category": trend_by_category,
    "trend_by_month": trend_by_month,
    "trend_guarded": trend_guarded,
    "synthesis_pivot": synthesis_pivot,
    "synthesis_pivot_by_category": synthesis_pivot_by_category,
    "synthesis_pivot_labelled": synthesis_pivot_labelled,
    "synthesis_rollup_sum": synthesis_rollup_sum,
    "synthesis_rollup_avg": synthesis_rollup_avg,
    "synthesis_direct": synthesis_direct,
    "synthesis_covered": synthesis_covered,
    "synthesis_reconciled": synthesis_reconciled,
    "synthesis_published": synthesis_published,
    "synthesis_ungated": synthesis_ungated,
    "position_published": position_published,
    "position_computed": position_computed,
    "position_fallback": position_fallback,
    "recognition_rate": recognition_rate,
    "recognition_rate_by": recognition_rate_by,
    "composition_gap": composition_gap,
    "mode_gap_left": mode_gap_left,
    "mode_gap_inner": mode_gap_inner,
    "share_pivot": share_pivot,
    "share_pivot_residual": share_pivot_residual,
    "flagged_slice": flagged_slice,
    "citizenship_slice": citizenship_slice,
    "complement_share": complement_share,
    "item_pivot": item_pivot,
    "quarterly_extract": quarterly_extract,
    "quarterly_focus": quarterly_focus,
    "quarterly_peers": quarterly_peers,
    "unit_join": unit_join,
    "unit_extract": unit_extract,
    "stock_extract": stock_extract,
    "stock_per_unit": stock_per_unit,
    "enrich_labels": enrich_labels,
    "derive_country": derive_country,
    "split_period": split_period,
    "map_labels": map_labels,
    "build_geo": build_geo,
    "melt_wide": melt_wide,
    "source_filter": source_filter,
    "drop_incomplete": drop_incomplete,
    "landing_stream": landing_stream,
    "sdmx_tsv_roundtrip": sdmx_tsv_roundtrip,
    "sdmx_folder": sdmx_folder,
    "support_csv": support_csv,
    "cast_obs": cast_obs,
    "map_labels_fallback": map_labels_fallback,
    "map_labels_null": map_labels_null,
    "map_labels_code": map_labels_code,
    "clean_monthly_run": clean_monthly_run,
    "dq_columns": dq_columns,
    "dq_gates": dq_gates,
    "batch_run": batch_run,
    "clean_parquet_roundtrip": clean_parquet_roundtrip,
    "geo_csv_roundtrip": geo_csv_roundtrip,
    "latest_vintage": latest_vintage,
    "typed_csv_read": typed_csv_read,
    "codelist_scan": codelist_scan,
    "mart_publish": mart_publish,
    "dq_not_null": dq_not_null,
    "dq_key": dq_key,
    "dq_min_rows": dq_min_rows,
    "dq_slice_gating": dq_slice_gating,
    "dq_rank_top": dq_rank_top,
    "dq_complete": dq_complete,
    "dq_non_ref_null": dq_non_ref_null,
    "dq_trend": dq_trend,
    "dq_reconcile": dq_reconcile,
    "dq_additive": dq_additive,
    "dq_flag": dq_flag,
    "dq_labels": dq_labels,
    "dq_coverage": dq_coverage,
    "dq_breaks": dq_breaks,
    "dq_constant": dq_constant,
    "dq_stable": dq_stable,
    "preview": preview,
    "top_regions": top_regions,
    "rows_by_level": rows_by_level,
    "category_gap": category_gap,
    "growth_vs_decline": growth_vs_decline,
    "cross_mart_compare": cross_mart_compare,
}
