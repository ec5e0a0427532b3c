"""Two-phase publishing of a vintage, gates counted in the write, batches side by side."""

from __future__ import annotations

import dataclasses
import os

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from regiocube.operators import quality as dq
from regiocube.operators.trend import trend
from regiocube.plans import vintage as vt
from regiocube.plans.runner import register_views, run_all, run_dataset
from regiocube.plans.spec import DatasetSpec, MartSpec
from regiocube.sources.sinks import write_clean, write_table
from tests.conftest import GOLDEN_GEO, GOLDEN_ROWS

SLICE = {"unit": "PC"}


def _spec(min_rows=1, slug="demo"):
    mart = MartSpec("mart_trend", lambda clean: trend(clean, SLICE), ("geo",), min_rows, ("nuts_level", "geo"), ("cagr_pct",),
                    SLICE, ("geo", "year"))
    return DatasetSpec(slug=slug, dataflow="D", dims=("freq", "unit", "geo"), min_rows=1, flag_described=False, marts=(mart,))


@pytest.fixture()
def given(spark):
    obs = spark.createDataFrame([(*r, None) for r in GOLDEN_ROWS], "freq string, unit string, geo string, year int, value double, flag string")
    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    lists = {d: spark.createDataFrame(rows, "code string, label_en string")
             for d, rows in {"freq": [("A", "Annual")], "unit": [("PC", "Percentage"), ("NR", "Number")]}.items()}
    return obs, geo, lists


def _values(spark, out, vintage=2026, slug="demo"):
    return {r["geo"]: r["last_value"] for r in spark.read.parquet(f"{out}/{slug}/{vintage}/mart_trend.parquet").collect()}


def test_failed_gate_keeps_the_old_vintage(spark, given, tmpdir_fresh):
    obs, geo, lists = given
    run_dataset(spark, _spec(), obs, geo, lists, tmpdir_fresh, 2026)
    old = _values(spark, tmpdir_fresh)
    assert old["DE11"] == 33.0
    worse = obs.withColumn("value", F.col("value") * 10)
    with pytest.raises(dq.GateFailure, match="min_rows"):
        run_dataset(spark, _spec(min_rows=1000), worse, geo, lists, tmpdir_fresh, 2026)
    assert _values(spark, tmpdir_fresh) == old
    rejected = vt.rejected_folder(tmpdir_fresh, "demo", 2026)
    assert vt.read_manifest(spark, rejected)["state"] == "rejected"
    assert {r["geo"]: r["last_value"] for r in spark.read.parquet(f"{rejected}/mart_trend.parquet").collect()}["DE11"] == 330.0
    # A vintage that passes replaces the old one; nothing else is left.
    run_dataset(spark, _spec(), worse, geo, lists, tmpdir_fresh, 2026)
    assert _values(spark, tmpdir_fresh)["DE11"] == 330.0
    assert sorted(os.listdir(f"{tmpdir_fresh}/demo")) == ["2026", "_rejected-2026"]


def test_failed_first_vintage_publishes_nothing(spark, given, tmpdir_fresh):
    obs, geo, lists = given
    with pytest.raises(dq.GateFailure):
        run_dataset(spark, _spec(), obs.unionByName(obs), geo, lists, tmpdir_fresh, 2026)
    assert not os.path.exists(f"{tmpdir_fresh}/demo/2026")
    with pytest.raises(FileNotFoundError):
        register_views(spark, tmpdir_fresh, "demo", 2026)


def test_error_in_a_mart_leaves_nothing_behind(spark, given, tmpdir_fresh):
    obs, geo, lists = given
    spec = _spec()
    broken = dataclasses.replace(spec, marts=(*spec.marts, dataclasses.replace(spec.marts[0], name="mart_x", build=lambda c: c.select("nowhere"))))
    run_dataset(spark, spec, obs, geo, lists, tmpdir_fresh, 2026)
    with pytest.raises(Exception, match="nowhere"):
        run_dataset(spark, broken, obs, geo, lists, tmpdir_fresh, 2026)
    assert os.listdir(f"{tmpdir_fresh}/demo") == ["2026"] and _values(spark, tmpdir_fresh)


@pytest.mark.parametrize("complete", [True, False])
def test_commit_cut_off_between_its_renames(spark, given, tmpdir_fresh, monkeypatch, complete):
    obs, geo, lists = given
    run_dataset(spark, _spec(), obs, geo, lists, tmpdir_fresh, 2026)
    staged = vt.StagedVintage(spark, tmpdir_fresh, "demo", 2026)
    write_table(spark.createDataFrame([("IT", 7.0)], "geo string, last_value double"), staged.path("mart_trend"))
    staged.tables["mart_trend"] = 1
    if complete:
        staged._write_manifest([], "published")
    # The driver is lost after the first rename.
    os.rename(f"{tmpdir_fresh}/demo/2026", f"{tmpdir_fresh}/demo/_old-2026-{staged.run}")
    vt.recover(spark, tmpdir_fresh, "demo", 2026)
    assert (_values(spark, tmpdir_fresh) == {"IT": 7.0}) == complete
    assert "mart_trend" in vt.read_manifest(spark, f"{tmpdir_fresh}/demo/2026")["tables"]
    assert not [n for n in os.listdir(f"{tmpdir_fresh}/demo") if n.startswith("_old")]


def test_rename_that_fails_brings_the_old_vintage_back(spark, given, tmpdir_fresh, monkeypatch):
    obs, geo, lists = given
    run_dataset(spark, _spec(), obs, geo, lists, tmpdir_fresh, 2026)
    real, calls = vt._rename, []

    def rename(spark_, old, new):
        calls.append(old)
        if len(calls) == 2:
            raise OSError("lost")
        real(spark_, old, new)

    monkeypatch.setattr(vt, "_rename", rename)
    with pytest.raises(OSError, match="lost"):
        run_dataset(spark, _spec(), obs.withColumn("value", F.lit(1.0)), geo, lists, tmpdir_fresh, 2026)
    assert _values(spark, tmpdir_fresh)["DE11"] == 33.0


def test_marts_are_not_read_again(spark, given, tmpdir_fresh, monkeypatch):
    """Gates come from the write itself: only the clean table is scanned."""
    obs, geo, lists = given
    read, real = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *p, **k: read.append(p) or real(self, *p, **k))
    rows = run_dataset(spark, _spec(), obs, geo, lists, tmpdir_fresh, 2026)
    assert {p[0].rsplit("/", 1)[1] for p in read} == {"clean.parquet"}
    by = {(r["check_name"], r["subject"]): (r["n_checked"], r["n_bad"]) for r in rows}
    n = spark.read.parquet(f"{tmpdir_fresh}/demo/2026/mart_trend.parquet").count()
    assert by["primary_key", "geo"] == (n, 0) and by["required_columns", "demo/mart_trend"] == (2, 0)
    manifest = vt.read_manifest(spark, f"{tmpdir_fresh}/demo/2026")
    assert manifest["tables"]["mart_trend"] == n and manifest["gates"]


def test_metrics_of_a_write_equal_the_gates_of_the_table(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 2.0), ("a", 1, 3.0), ("b", 1, 4.0), (None, 2, None), (None, 2, 1.0)],
                               "k string, y int, v double")
    m = dq.TableMetrics("t", ("k", "v", "absent"), ("v", "absent"), 7, ("k", "y"))
    path = f"{tmpdir_fresh}/t.parquet"
    write_table(df, path, ["-y", "k"], m)
    written = spark.read.parquet(path)
    assert written.columns == ["k", "y", "v"]
    want = dq.run_gates([dq.table_gates(written, ("k", "v", "absent"), ("v", "absent"), 7, "t"), dq.check_key(written, ["k", "y"])], False)
    key = lambda r: (r["check_name"], r["subject"])
    assert sorted(m.rows(), key=key) == sorted(want, key=key) and m.n_rows == 6
    # One scan and one place for the counts, above the sort.
    plan = m.placed(df)._jdf.queryExecution().toString()
    assert plan.count("Window") >= 1
    for rows in (df.limit(0), df.filter("y > 5")):
        empty = dq.TableMetrics("t", (), ("v",), 1, ("k",))
        write_table(rows, path, ["k"], empty)
        assert {r["check_name"]: r["n_bad"] for r in empty.rows()} == {"required_columns": 0, "min_rows": 1, "not_null": 0, "primary_key": 0}
    clean = dq.TableMetrics("c", (), ("v",), 1)
    write_clean(df, f"{tmpdir_fresh}/c.parquet", ("y",), clean)
    assert clean.n_rows == 6 and {r["subject"]: r["n_bad"] for r in clean.rows()}["v"] == 2


def test_batch_runs_side_by_side_and_isolates_failures(spark, given, tmpdir_fresh):
    import threading
    import time

    obs, geo, lists = given
    at_once, most, lock = [0], [0], threading.Lock()

    def slow(clean):
        with lock:
            at_once[0] += 1
            most[0] = max(most[0], at_once[0])
        time.sleep(1.0)
        with lock:
            at_once[0] -= 1
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        return trend(clean, SLICE)

    pools: list = []
    specs = {f"d{k}": dataclasses.replace(_spec(slug=f"d{k}"), marts=(dataclasses.replace(_spec().marts[0], build=slow),)) for k in range(3)}
    raws = {slug: obs for slug in specs} | {"d1": obs.unionByName(obs)}
    rows = run_all(spark, specs, raws, geo, lists, tmpdir_fresh, 1, workers=3)
    ended = [(r["dataset"], r["n_bad"]) for r in rows if r["check_name"] == "dataset_run"]
    assert ended == [("d0", 0), ("d1", 1), ("d2", 0)]
    assert most[0] == 2 and sorted(pools) == ["dataset-d0", "dataset-d2"]
    alone = run_all(spark, {"d0": specs["d0"]}, raws, geo, lists, f"{tmpdir_fresh}/alone", 1, workers=1)
    assert [r for r in rows if r["dataset"] == "d0"] == alone
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
