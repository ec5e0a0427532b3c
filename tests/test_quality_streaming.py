"""Data-quality gates and the streaming landing job."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from regiocube.operators import quality as dq
from regiocube.operators.benchmark import geo_benchmark


def test_key_and_gates(spark, golden_clean):
    ok = dq.check_key(golden_clean, ["unit", "geo", "year"]).collect()[0]
    assert (ok.n_bad, ok.n_checked) == (0, 16)
    dup = golden_clean.unionByName(golden_clean.limit(1))
    bad = dq.check_key(dup, ["unit", "geo", "year"])
    with pytest.raises(dq.GateFailure):
        dq.run_gates([bad, dq.check_min_rows(golden_clean, 10)])
    rows = dq.run_gates([dq.check_min_rows(golden_clean, 10)])
    assert rows[0]["n_bad"] == 0


def test_benchmark_invariants(golden_clean):
    bench = geo_benchmark(golden_clean, {"unit": "PC"}, ["unit"])
    reports = [
        dq.check_slice_gating(bench, {"unit": "PC"}),
        dq.check_rank_top(bench, {"unit": "PC"}, ["year", "country", "nuts_level", "unit"]),
        dq.check_complete(bench, {"unit": "PC"}),
        dq.check_non_ref_null(bench),
        dq.check_not_null(bench, ["geo", "year"]),
    ]
    assert all(r["n_bad"] == 0 for r in dq.run_gates(reports))


def test_additive_flag_labels_coverage_breaks(spark):
    df = spark.createDataFrame(
        [("IT", 2020, "A", 1.0), ("IT", 2020, "B", 2.0), ("IT", 2020, "T", 3.0),
         ("DE", 2020, "A", 1.0), ("DE", 2020, "B", 2.0), ("DE", 2020, "T", 4.0),
         ("IT", 2021, "T", 3.6), ("DE", 2021, "T", 4.1)],
        "geo string, year int, cat string, value double")
    add = dq.check_additive(df, "cat", ["A", "B"], "T", ["geo", "year"]).collect()[0]
    assert (add.n_checked, add.n_bad) == (2, 1)
    flagged = df.withColumn("is_total", F.col("cat") == "T")
    assert dq.check_flag(flagged, "is_total", F.col("cat") == "T").collect()[0].n_bad == 0
    cov = {r.year: (r.n_series, r.n_prev) for r in dq.coverage_by_year(df).collect()}
    assert cov == {2020: (2, None), 2021: (2, 2)}
    brk = dq.series_breaks(df.filter("cat = 'T'"), ["geo"], 0.15).collect()
    assert [(r.geo, r.year) for r in brk] == [("IT", 2021)]
    lab = df.withColumn("cat_label_en", F.when(F.col("cat") != "B", F.lit("x")))
    assert dq.check_labels(lab, ["cat"]).collect()[0].n_bad == 2


def test_streaming_landing_matches_batch(spark, golden_clean, tmpdir_fresh):
    from regiocube.operators.enrich import clean_observations
    from regiocube.streaming.landing import clean_stream
    from tests.conftest import GOLDEN_GEO, GOLDEN_ROWS

    landing = os.path.join(tmpdir_fresh, "landing")
    obs = spark.createDataFrame([(f, u, g, y, v, None) for f, u, g, y, v in GOLDEN_ROWS],
                                "freq string, unit string, geo string, year int, value double, flag string")
    obs.limit(8).write.parquet(os.path.join(landing, "batch1"))
    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    out = os.path.join(tmpdir_fresh, "clean")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    q = clean_stream(spark, landing + "/*", ["freq", "unit", "geo"], geo, out, "landing_test",
                     checkpoint_dir=ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(out).count()
    assert first == 8
    # A second landed file is picked up once; the first is not re-read.
    obs.subtract(obs.limit(8)).write.parquet(os.path.join(landing, "batch2"))
    q = clean_stream(spark, landing + "/*", ["freq", "unit", "geo"], geo, out, "landing_test",
                     checkpoint_dir=ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    batch = clean_observations(obs, ["freq", "unit", "geo"], geo)
    assert got.count() == 16
    cols = ["geo", "year", "unit", "value", "country", "nuts_parent_label_en"]
    assert got.select(*cols).exceptAll(batch.select(*cols)).count() == 0
