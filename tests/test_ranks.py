"""Ranks by value ranges, counted trend endpoints, landed partitions, headers read by a job, SQL on views."""

from __future__ import annotations

import gzip
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from regiocube.operators import benchmark as bm
from regiocube.operators import enrich as en
from regiocube.operators import shares as sh
from regiocube.operators.ranks import STEP, value_ranks, with_ranks
from regiocube.operators.trend import trend
from regiocube.plans.spec import DatasetSpec, MartSpec
from regiocube.sources.files import files_by_header, partition_columns
from regiocube.sources.readers import list_vintages, read_obs

NAN = float("nan")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("range_rows", [None, 3])
def test_ranks_equal_the_window_form(spark, descending, range_rows):
    rng = random.Random(2)
    values = [None, NAN, 0.0, -0.0, float("inf"), -float("inf"), 1.5, 2.5, *[rng.gauss(0, 100) for _ in range(900)]]
    rows = [(rng.choice([2020, 2021, None]), rng.choice(["a", "b", None]), rng.choice(values) if rng.random() < 0.7 else 7.0) for _ in range(5000)]
    df = spark.createDataFrame(rows, "year int, level string, value double")
    order = F.col("value").desc_nulls_last() if descending else F.col("value").asc_nulls_last()
    w = Window.partitionBy("year", "level")
    want = df.select("*", F.rank().over(w.orderBy(order)).cast("long").alias("rank"), F.count(F.lit(1)).over(w).alias("n"))
    ranks = value_ranks(df, ["year", "level"], "value", descending, range_rows)
    assert ranks.groupBy("year", "level", "value").count().filter("count > 1").count() == 0
    got = with_ranks(df, ["year", "level"], "value", "rank", "n", descending, range_rows=range_rows)
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got.select(*want.columns).collect())) == sorted(map(key, want.collect()))


def test_ranks_of_some_rows_only(spark):
    df = spark.createDataFrame([(1, 1.0, True), (1, 2.0, False), (1, 2.0, True), (1, 3.0, None), (1, None, True)], "g int, value double, m boolean")
    got = {(r["value"], r["m"]): (r["place"], r["n"]) for r in with_ranks(df, ["g"], "value", "place", "n", where=F.col("m")).collect()}
    assert got == {(1.0, True): (1, 3), (2.0, True): (2, 3), (None, True): (3, 3), (2.0, False): (None, None), (3.0, None): (None, None)}
    assert with_ranks(df.limit(0), ["g"], "value", "place").collect() == []


def test_large_group_is_dealt_to_ranges(spark):
    """A million places in one level and year, a third of them with one value: no window holds them all."""
    n = 1_000_000
    rows = spark.range(n).select(F.lit(2020).alias("year"), F.when(F.col("id") % 3 == 0, -1.0).otherwise(
        F.hash("id") % 700_001).cast("double").alias("value"))
    ranks = value_ranks(rows, ["year"], "value", range_rows=10_000)
    top = ranks.agg(F.max("rank"), F.min("rank"), F.sum(F.lit(1)), F.max("n")).first()
    assert top[1] == 1 and top[3] == n and top[0] <= n
    # The window is partitioned by the range too.
    assert "Window" in _plan(ranks) and "__range" in _plan(ranks)
    sample = ranks.orderBy("value").limit(50).collect()
    values = [r["value"] for r in sample]
    below = rows.agg(*[F.count_if(F.col("value") < v).alias(f"c{i}") for i, v in enumerate(values)]).first()
    assert [r["rank"] for r in sample] == [c + 1 for c in below]
    assert STEP * STEP >= 1000


def test_benchmarks_without_bounded_windows(spark, golden_clean):
    args = (golden_clean, {"unit": "PC"}, ["unit"], ["IT", "DE", "FR"])
    for level in (True, False):
        want = bm.geo_benchmark(*args, level_in_partition=level)
        got = bm.geo_benchmark(*args, level_in_partition=level, bounded=False)
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert "Window [percent_rank" not in _plan(got)


def _series(spark, rows):
    return spark.createDataFrame([(g, g, "NUTS2", g[:2], "PC", y, v) for g, y, v in rows],
                                 "geo string, geo_label_en string, nuts_level string, country string, unit string, year int, value double")


def test_doubled_endpoint_fails_in_the_plan(spark):
    good = [("IT1", 2000, 1.0), ("IT1", 2001, 2.0), ("IT1", 2001, 3.0), ("IT1", 2002, 4.0), ("DE1", 2001, 5.0)]
    rows = {r["geo"]: r for r in trend(_series(spark, good), {"unit": "PC"}).collect()}
    assert rows["IT1"]["delta_abs"] == 3.0 and rows["DE1"]["cagr_pct"] is None
    for twice in (("IT1", 2000, 1.0), ("IT1", 2002, 9.0), ("DE1", 2001, 5.0)):
        with pytest.raises(Exception, match="two observations at the (first|last) year of series " + twice[0]):
            trend(_series(spark, [*good, twice]), {"unit": "PC"}).collect()
    # Rows without a value are no observations; other slices neither.
    extra = _series(spark, [*good, ("IT1", 2000, None)]).unionByName(_series(spark, [("IT1", 2000, 1.0)]).withColumn("unit", F.lit("NR")))
    assert trend(extra, {"unit": "PC"}).count() == 2
    plan = _plan(trend(_series(spark, good), {"unit": "PC"}))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_unit_join_is_one_aggregation(spark):
    rows = [(2020, "IT", "KM", 1.0), (2020, "IT", "KM_1000", 2.0), (2021, "IT", "KM", 3.0), (2022, "IT", "KM_1000", 4.0), (2023, "IT", "KM", None)]
    df = spark.createDataFrame([(*r[:2], "Italy", "country", *r[2:]) for r in rows],
                               "year int, geo string, geo_label_en string, nuts_level string, unit string, value double")
    got = sh.unit_join(df, "KM", "KM_1000", ["year", "geo"], F.lit(True))
    assert sorted((r["year"], r["km"], r["per_1000_km2"]) for r in got.collect()) == [(2020, 1.0, 2.0), (2021, 3.0, None)]
    assert "Join" not in _plan(got)


def test_first_listed_annotation_counts(spark):
    labels = spark.createDataFrame([("IT1", "x"), ("IT2", "y")], "code string, label_en string")
    notes = [("IT1", "LEVEL", "2", 0), ("IT1", "LEVEL", "1", 1), ("IT2", "LEVEL", "1", 5), ("IT2", "LEVEL", "3", 2), ("IT2", "OTHER", "0", 0)]
    listed = spark.createDataFrame(notes, "code string, type string, title string, position int")
    want = {"IT1": "NUTS2", "IT2": "NUTS3"}
    assert {r["code"]: r["nuts_level"] for r in en.build_geo(labels, listed).collect()} == want
    as_read = spark.createDataFrame([n[:3] for n in notes], "code string, type string, title string").coalesce(1)
    assert {r["code"]: r["nuts_level"] for r in en.build_geo(labels, as_read).collect()} == {"IT1": "NUTS2", "IT2": "NUTS1"}


SPEC = DatasetSpec(slug="demo", dataflow="D", dims=("freq", "unit", "geo"), min_rows=1, flag_described=False,
                   marts=(MartSpec("mart_trend", lambda clean: trend(clean, {"unit": "01"}), ("geo",)),))


def test_partition_folders_are_one_table(spark, tmpdir_fresh):
    from regiocube.plans.runner import land

    rows = [("A", "01", "IT", 2020, 1.0, None), ("A", "2", "DE", 2021, 2.0, "p"), ("A", "01", "DE", 2021, 3.0, None), ("A", None, "FR", 2020, 4.0, None)]
    obs = spark.createDataFrame(rows, SPEC.raw_schema)
    for kind in ("parquet", "csv"):
        root = os.path.join(tmpdir_fresh, kind)
        obs.limit(1).write.format(kind).option("header", "true").save(f"{root}/2025")
        obs.write.partitionBy("unit", "year").format(kind).option("header", "true").save(f"{root}/2026")
        assert list_vintages(spark, root) == ["2025", "2026"] and partition_columns(spark, f"{root}/2026") == ["unit", "year"]
        for path in (root, f"{root}/2026"):
            got = land(spark, SPEC, path)
            assert dict(got.dtypes) == {f.name: f.dataType.simpleString() for f in obs.schema.fields}
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)


def test_declared_delimiter_and_encoding(spark, tmpdir_fresh):
    import dataclasses

    from regiocube.plans.runner import land

    spec = dataclasses.replace(SPEC, read_options={"delimiter": ";", "encoding": "ISO-8859-1"})
    folder = os.path.join(tmpdir_fresh, "csv")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "wb") as fh:
        fh.write("value;geo;unit;freq;year;flag\n1.5;Århus;m²;A;2020;\n".encode("latin-1"))
    assert [tuple(r) for r in land(spark, spec, folder).collect()] == [("A", "m²", "Århus", 2020, 1.5, None)]
    with open(f"{tmpdir_fresh}/b.tsv", "wb") as fh:
        fh.write("freq,unit,geo\\TIME_PERIOD;2020 ;2021 \nA,m²,IT;1 ;2 p\n".encode("latin-1"))
    got = land(spark, spec, f"{tmpdir_fresh}/b.tsv").orderBy("year").collect()
    assert [(r["unit"], r["year"], r["value"], r["flag"]) for r in got] == [("m²", 2020, 1.0, None), ("m²", 2021, 2.0, "p")]
    with pytest.raises(ValueError, match="unknown read options"):
        read_obs(spark, folder, spec.raw_schema, "csv", {"quote": "'"})


def test_headers_come_from_one_job(spark, tmpdir_fresh, monkeypatch):
    import regiocube.sources.files as files
    from regiocube.sources.sdmx import read_sdmx_tsv

    folder = os.path.join(tmpdir_fresh, "wide")
    os.makedirs(folder)
    for k in range(30):
        years = [2000 + k % 3, 2010]
        text = "freq,geo\\TIME_PERIOD\t" + "\t".join(f"{y} " for y in years) + f"\nA,G{k}\t{k} \t: \n"
        name = f"{folder}/part {k}%20.tsv" if k < 10 else f"{folder}/part-{k}.tsv"
        if k % 5 == 4:
            with gzip.open(name + ".gz", "wt") as fh:
                fh.write(text)
        else:
            with open(name, "w") as fh:
                fh.write(text)
    open(f"{folder}/_hidden.tsv", "w").close()
    monkeypatch.setattr(files, "first_line", None)  # no file is opened by the driver
    found = files_by_header(spark, files.data_files(spark, folder))
    assert sorted(len(f) for f in found.values()) == [10, 10, 10]
    rows = read_sdmx_tsv(spark, folder).filter("value is not null").collect()
    assert {(r["geo"], r["year"], r["value"]) for r in rows} == {(f"G{k}", 2000 + k % 3, float(k)) for k in range(30)}


def test_header_of_a_file_of_many_pieces(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/long.tsv"
    with open(path, "w") as fh:
        fh.write("freq,geo\\TIME_PERIOD\t2000 \n")
        for k in range(200_000):
            fh.write(f"A,G{k}\t{k} \n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        assert list(files_by_header(spark, [path]).values())[0][0].endswith("long.tsv")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sql_on_a_published_vintage_prunes_years(spark, tmpdir_fresh):
    from regiocube.plans.runner import register_views, run_dataset
    from tests.conftest import GOLDEN_GEO

    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    rows = [("A", "01", g, y, float(y), None) for g in ("IT", "DE") for y in (2020, 2021, 2022)]
    lists = {d: spark.createDataFrame([(c, c)], "code string, label_en string") for d, c in (("freq", "A"), ("unit", "01"))}
    run_dataset(spark, SPEC, spark.createDataFrame(rows, SPEC.raw_schema), geo, lists, tmpdir_fresh, 2026)
    assert register_views(spark, tmpdir_fresh, "demo", 2026) == ["demo_clean", "demo_mart_trend"]
    asked = spark.sql("SELECT geo, value FROM demo_clean WHERE geo LIKE 'I%' AND year = 2021 ORDER BY value DESC LIMIT 10")
    assert [tuple(r) for r in asked.collect()] == [("IT", 2021.0)]
    plan = _plan(asked)
    assert "PartitionFilters: [isnotnull(year" in plan and "StringStartsWith(geo,I)" in plan
    assert len(asked.inputFiles()) and all("year=2021" in f for f in
                                           spark.sql("SELECT DISTINCT input_file_name() f FROM demo_clean WHERE year = 2021").toPandas()["f"])
    assert spark.sql("SELECT count(*) n FROM demo_mart_trend").first()["n"] == 2
