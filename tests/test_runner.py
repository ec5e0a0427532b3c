"""Dataset catalogue + runner end to end: wide TSV -> clean -> marts -> gates."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
import pytest

from regiocube.plans.catalog import CATALOG, build_mart
from regiocube.plans.runner import run_dataset
from tests.conftest import GOLDEN_GEO, GOLDEN_ROWS


def test_catalog_covers_published_dataflows():
    assert len(CATALOG) == 51
    assert all(spec.marts for spec in CATALOG.values())
    assert sum(len(s.marts) for s in CATALOG.values()) >= 130


def by_missing_codelist_stops(spark, spec, path, geo, units, out):
    from regiocube.operators.quality import GateFailure

    with pytest.raises(GateFailure, match="required_columns"):
        run_dataset(spark, spec, path, geo, {"unit": units}, out + "-missing", 2026, fail_on_error=False)
    return True


def test_run_dataset_from_tsv(spark, tmpdir_fresh):
    years = [2020, 2023]
    series = {}
    for _, unit, geo, year, value in GOLDEN_ROWS:
        series.setdefault(f"A,{unit},{geo}", {})[year] = value
    lines = ["freq,unit,geo\\TIME_PERIOD\t" + "\t".join(f"{y} " for y in years)]
    for key, vals in series.items():
        cells = [(": " if vals.get(y) is None else f"{vals[y]} ") for y in years]
        lines.append(key + "\t" + "\t".join(cells))
    path = os.path.join(tmpdir_fresh, "poverty.tsv")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    units = spark.createDataFrame([("PC", "Percentage"), ("NR", "Number")], "code string, label_en string")
    freq = spark.createDataFrame([("A", "Annual")], "code string, label_en string")
    out = os.path.join(tmpdir_fresh, "out")
    spec = CATALOG["poverty-risk-nuts2"]
    rows = run_dataset(spark, spec, path, geo, {"unit": units, "freq": freq}, out, 2026, fail_on_error=False)
    assert by_missing_codelist_stops(spark, spec, path, geo, units, out)
    by = {(r["check_name"], r["subject"]): r for r in rows}
    assert by[("required_columns", "poverty-risk-nuts2/clean")]["n_bad"] == 0
    assert by[("not_null", "geo")]["n_bad"] == 0
    assert all(r["n_bad"] == 0 for r in rows if r["check_name"] == "primary_key")
    # min-row gates of the published flow fail on a 16-row cube: reported, not raised.
    assert any(r["check_name"] == "min_rows" and r["n_bad"] for r in rows)
    bench = spark.read.parquet(f"{out}/poverty-risk-nuts2/2026/mart_geo_benchmark.parquet")
    got = {(r.year, r.geo, r.unit): r.percentile_eu for r in bench.collect()}
    assert got[(2020, "DE11", "PC")] == 0.6667 and got[(2023, "ITC2", "PC")] == 0.5
    clean = spark.read.parquet(f"{out}/poverty-risk-nuts2/2026/clean.parquet")
    syn = {r.country: r.rischio_poverta_pct for r in build_mart("poverty-risk-nuts2", "mart_sintesi", clean)
           .filter("year = 2020").collect()}
    assert syn == {"CH": 5.0, "DE": 30.0, "IT": 15.0, "FR": None}


def _raw_for(spark, spec):
    """Long observations with a dataflow's dims: dims of a mart's slice take
    their slice value, other dims 'TOTAL'."""
    slice_vals = {}
    for m in spec.marts:
        kw = getattr(m.build, "keywords", {}) or {}
        for key in ("slice_", "fixed"):
            slice_vals.update({k: v for k, v in (kw.get(key) or {}).items() if isinstance(v, str)})
    slice_vals.update({k: v for k, v in spec.source_filter.items() if isinstance(v, str)})
    rows = []
    for _, unit, geo, year, value in GOLDEN_ROWS:
        if unit == "PC":
            dims = ["A" if d == "freq" else geo if d == "geo" else slice_vals.get(d, "TOTAL") for d in spec.dims]
            time = {"year": (year,), "month": (year, 1), "quarter": (f"{year}-Q1",)}[spec.period]
            rows.append((*dims, *time, value, None))
    return spark.createDataFrame(rows, spec.raw_schema)


def _lists_for(spark, spec, raw):
    out = {d: spark.createDataFrame([(r[0], f"{d} label") for r in raw.select(d).distinct().collect()],
                                    "code string, label_en string")
           for d in ("freq", "unit", *spec.codelist_dims) if d in spec.dims}
    return out | {"flag": spark.createDataFrame([("p", "provisional")], "code string, label_en string")}


def _sort_value(v, descending):
    if v is None:
        return (1, 0)
    if isinstance(v, str):
        return (0, v)
    return (0, -v if descending else v)


def _run_all_datasets(spark, root, slugs):
    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    failures = []
    for slug in slugs:
        spec = CATALOG[slug]
        raw = _raw_for(spark, spec)
        try:
            rows = run_dataset(spark, spec, raw, geo, _lists_for(spark, spec, raw), root, 2026, fail_on_error=False)
            bad = [r for r in rows if r["n_bad"] and r["check_name"] != "min_rows"]
            assert not bad, bad
            clean = spark.read.parquet(f"{root}/{slug}/2026/clean.parquet")
            assert set(spec.required_columns) <= set(clean.columns)
            assert len(set(clean.columns)) == len(clean.columns)
            for mart in spec.marts:
                files = sorted(f for f in os.listdir(f"{root}/{slug}/2026/{mart.name}.parquet") if f.startswith("part-"))
                written = [r for f in files for r in pq.read_table(f"{root}/{slug}/2026/{mart.name}.parquet/{f}").to_pylist()]
                keys = [tuple(_sort_value(r[k.lstrip("-")], k[0] == "-") for k in mart.order_by) for r in written]
                assert mart.order_by and keys == sorted(keys), f"{mart.name} is not in its published order"
        except Exception as e:  # noqa: BLE001
            failures.append(f"{slug}: {type(e).__name__}: {str(e)[:300]}")
    return failures


@pytest.mark.parametrize("part", range(6))
def test_every_catalogue_dataset_runs(spark, tmpdir_fresh, part):
    """Every dataset through the real clean build, written and read back, all
    its gates but the row minima, and every mart written in its published order."""
    failures = _run_all_datasets(spark, tmpdir_fresh, sorted(CATALOG)[part::6])
    assert not failures, "\n".join(failures)


def test_published_values_of_the_catalogue():
    gates = {(s, m.name): m.min_rows for s, spec in CATALOG.items() for m in spec.marts}
    assert gates["crime-nuts3", "mart_sintesi"] == 100 and gates["crime-nuts3", "mart_trend"] == 1000
    assert gates["gdp-nuts3", "mart_trend"] == 1000 and gates["ltc-beds", "mart_trend"] == 30
    assert "age" in CATALOG["early-school-leavers-nuts2"].label_maps
    assert "month" not in CATALOG["heating-degree-days-monthly-nuts3"].dims


def test_cli_and_views(spark, tmpdir_fresh):
    from regiocube.plans.cli import main
    from regiocube.plans.runner import register_views

    tsv = os.path.join(tmpdir_fresh, "in.tsv")
    with open(tsv, "w") as fh:
        fh.write("freq,unit,geo\\TIME_PERIOD\t2020 \t2023 \n")
        for key, a, b in [("A,PC,ITC1", "10 ", "12.5 "), ("A,PC,ITC2", "20 ", "20 "),
                          ("A,PC,DE11", "30 ", "33 p"), ("A,PC,IT", "15 ", ": ")]:
            fh.write(f"{key}\t{a}\t{b}\n")
    cl = os.path.join(tmpdir_fresh, "codelists")
    os.makedirs(cl)
    with open(os.path.join(cl, "unit.csv"), "w") as fh:
        fh.write("code,label_en\nPC,Percentage\n")
    with open(os.path.join(cl, "freq.csv"), "w") as fh:
        fh.write("freq,label_en\nA,Annual\n")
    with open(os.path.join(cl, "flags.csv"), "w") as fh:
        fh.write("flag,description_en\np,provisional\n")
    geo = os.path.join(tmpdir_fresh, "geo.csv")
    with open(geo, "w") as fh:
        fh.write("code,label_en,nuts_level,parent_code\n" + "\n".join(
            ",".join(r) for r in GOLDEN_GEO) + "\n")
    out = os.path.join(tmpdir_fresh, "out")
    rc = main(["--out", out, "--vintage", "2026", "--geo", geo, "--codelists", cl, "--no-fail",
               f"poverty-risk-nuts2={tsv}"])
    assert rc == 0
    # By default a failing gate (here: too few rows) fails the run.
    assert main(["--out", out + "-strict", "--vintage", "2026", "--geo", geo, "--codelists", cl,
                 f"poverty-risk-nuts2={tsv}"]) == 1
    names = register_views(spark, out, "poverty-risk-nuts2", 2026)
    assert "poverty_risk_nuts2_mart_trend" in names
    top = spark.sql("SELECT geo, value FROM poverty_risk_nuts2_clean WHERE geo LIKE 'IT%' AND year = 2020 "
                    "ORDER BY value DESC LIMIT 1").collect()
    assert top[0].geo == "ITC2"
    flags = {r.geo: r.flag_desc_en for r in spark.sql(
        "SELECT geo, flag_desc_en FROM poverty_risk_nuts2_clean WHERE year = 2023").collect()}
    assert flags["DE11"] == "provisional"


def test_duplicate_observations_stop_before_marts(spark, tmpdir_fresh):
    from regiocube.operators.quality import GateFailure

    rows = [("A", "PC", "IT", 2020, 1.0, None), ("A", "PC", "IT", 2020, 2.0, None)]
    raw = spark.createDataFrame(rows, "freq string, unit string, geo string, year int, value double, flag string")
    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    with pytest.raises(GateFailure):
        run_dataset(spark, CATALOG["poverty-risk-nuts2"], raw, geo, _lists_for(spark, CATALOG["poverty-risk-nuts2"], raw),
                    os.path.join(tmpdir_fresh, "o"), 1, fail_on_error=False)
    assert not os.path.exists(os.path.join(tmpdir_fresh, "o", "poverty-risk-nuts2", "1", "mart_trend.parquet"))


def test_landed_kinds_and_newest_vintage(spark, tmpdir_fresh):
    """Parquet, CSV and TSV land with the declared types; of vintages the newest counts."""
    from regiocube.plans.runner import land

    spec = CATALOG["poverty-risk-nuts2"]
    rows = [("A", "PC", "IT", 2020, 1.5, None), ("A", "PC", "DE", 2021, 2.5, "p")]
    raw = spark.createDataFrame(rows, spec.raw_schema)
    root = os.path.join(tmpdir_fresh, "landed")
    raw.limit(1).write.parquet(f"{root}/2025")
    raw.select("value", "geo", "unit", "freq", "year", "flag").write.parquet(f"{root}/2026")
    assert sorted(map(tuple, land(spark, spec, root).collect())) == sorted(rows)
    raw.select("value", "geo", "unit", "freq", "year", "flag").write.option("header", "true").csv(f"{root}-csv")
    got = land(spark, spec, f"{root}-csv")
    assert dict(got.dtypes)["year"] == "int" and sorted(map(tuple, got.collect())) == sorted(rows)


def test_batch_goes_on_after_a_failed_dataset(spark, tmpdir_fresh):
    from regiocube.plans.runner import run_all

    spec = CATALOG["poverty-risk-nuts2"]
    raw = _raw_for(spark, spec)
    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    specs = {"a-broken": spec, "poverty-risk-nuts2": spec}
    rows = run_all(spark, specs, {"a-broken": os.path.join(tmpdir_fresh, "absent"), "poverty-risk-nuts2": raw}, geo,
                   _lists_for(spark, spec, raw), os.path.join(tmpdir_fresh, "out"), 1, fail_on_error=False)
    ended = {r["dataset"]: r["n_bad"] for r in rows if r["check_name"] == "dataset_run"}
    assert ended == {"a-broken": 1, "poverty-risk-nuts2": 0}
