"""Wide SDMX TSV round trip, geo hierarchy builder, typed reads, sinks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from regiocube.operators.enrich import build_geo
from regiocube.sources.readers import read_codelist, read_geo, read_latest, read_obs
from regiocube.sources.sdmx import read_sdmx_tsv
from regiocube.sources.sinks import write_geo, write_mart

YEARS = list(range(2000, 2025))


def _tsv(path, header_dims, periods, rows):
    lines = ["\t".join([f"{header_dims}\\TIME_PERIOD"] + [f"{p} " for p in periods])]
    for key, cells in rows:
        lines.append("\t".join([key] + cells))
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _series(values_by_year):
    return [f"{values_by_year[y]} " if y in values_by_year else ": " for y in YEARS]


def test_sdmx_fixture_shape(spark, tmpdir_fresh):
    geos = ["AL", "AL0", "AL01", "AL011", "AL012", "AL013", "AL014", "AL015", "AL02"]
    rows = []
    for i, g in enumerate(geos):
        vals = {y: 1000 + 100 * i + (y - 2008) * 10 for y in range(2008, 2023)}
        if g == "AL":
            vals[2008] = 3100
        if g == "AL011":
            vals[2013] = 2200
        if g == "AL02":
            vals[2022] = 7700
        rows.append((f"A,EUR_HAB,{g}", _series(vals)))
    path = os.path.join(tmpdir_fresh, "sample.tsv")
    _tsv(path, "freq,unit,geo", YEARS, rows)
    obs = read_sdmx_tsv(spark, path)
    assert obs.columns == ["freq", "unit", "geo", "year", "value", "flag"]
    assert dict(obs.dtypes)["year"] == "int" and dict(obs.dtypes)["value"] == "double"
    assert obs.count() == 225
    assert obs.filter(F.col("value").isNotNull()).count() == 135
    got = {(r.geo, r.year): r.value for r in obs.filter("value is not null").collect()}
    assert got[("AL", 2008)] == 3100 and got[("AL011", 2013)] == 2200 and got[("AL02", 2022)] == 7700


def test_sdmx_flags_quarters_months_and_filter(spark, tmpdir_fresh):
    p1 = os.path.join(tmpdir_fresh, "flags.tsv")
    _tsv(p1, "freq,unit,sex,geo", [2000, 2001],
         [("A,NR,T,IT", ["12.5 b", ": c"]), ("A,NR,M,IT", ["7 ", "8p"]), ("A,NR,T,DE", ["NaN ", "x1 "])])
    obs = read_sdmx_tsv(spark, p1, source_filter={"sex": "T"})
    got = {(r.geo, r.year): (r.value, r.flag) for r in obs.collect()}
    assert got == {("IT", 2000): (12.5, "b"), ("IT", 2001): (None, "c"),
                   ("DE", 2000): (None, None), ("DE", 2001): (None, None)}
    assert {(r.year, r.value, r.flag) for r in read_sdmx_tsv(spark, p1).filter("sex = 'M'").collect()} == {
        (2000, 7.0, None), (2001, 8.0, "p")}
    p2 = os.path.join(tmpdir_fresh, "q.tsv")
    _tsv(p2, "freq,unit,geo", ["2001-Q1", "2001-Q2"], [("Q,NR,IT", ["1 ", "2 "])])
    q = read_sdmx_tsv(spark, p2)
    assert q.columns == ["freq", "unit", "geo", "year", "quarter", "value", "flag"]
    assert sorted((r.year, r.quarter, r.value) for r in q.collect()) == [(2001, "Q1", 1.0), (2001, "Q2", 2.0)]
    p3 = os.path.join(tmpdir_fresh, "m.tsv")
    _tsv(p3, "freq,unit,geo", ["2001-01", "2001-12"], [("M,NR,IT", ["1 ", "2 "])])
    m = read_sdmx_tsv(spark, p3)
    assert sorted((r.year, r.month) for r in m.collect()) == [(2001, 1), (2001, 12)]


def test_build_geo_rules(spark):
    labels = spark.createDataFrame(
        [("IT", "Italy"), ("ITC", "Nord-Ovest"), ("ITC1", "Piemonte"), ("ITC11", "Torino"),
         ("EU27_2020", "EU"), ("ITD", "old"), ("XX9", "odd")], "code string, label_en string")
    ann = spark.createDataFrame(
        [("IT", "LEVEL", "0"), ("ITC", "LEVEL", "1"), ("ITC1", "LEVEL", "2"), ("ITC11", "LEVEL", "3"),
         ("ITD", "LEVEL", "1"), ("ITD", "IS_STANDARD_CODE", "O"), ("XX9", "LEVEL", "7")],
        "code string, type string, title string")
    got = {r.code: (r.nuts_level, r.parent_code) for r in build_geo(labels, ann).collect()}
    assert got == {"IT": ("country", ""), "ITC": ("NUTS1", "IT"), "ITC1": ("NUTS2", "ITC"),
                   "ITC11": ("NUTS3", "ITC1"), "EU27_2020": ("", ""), "ITD": ("", ""), "XX9": ("", "")}


def test_readers_and_sinks(spark, tmpdir_fresh):
    cl = os.path.join(tmpdir_fresh, "flags.csv")
    with open(cl, "w") as fh:
        fh.write('flag,description_en\nb,break in time series\nbd,"break, definition differs"\n')
    got = {r.code: r.label_en for r in read_codelist(spark, cl).collect()}
    assert got == {"b": "break in time series", "bd": "break, definition differs"}
    geo = spark.createDataFrame([("IT", "Italy", "country", ""), ("EU27_2020", "EU", "", "")],
                                "code string, label_en string, nuts_level string, parent_code string")
    gpath = os.path.join(tmpdir_fresh, "geo")
    write_geo(geo, gpath)
    back = {r.code: (r.nuts_level, r.parent_code) for r in read_geo(spark, gpath).collect()}
    assert back == {"IT": ("country", None), "EU27_2020": (None, None)}
    # typed read binds by name and keeps 'T' a string
    raw = os.path.join(tmpdir_fresh, "raw.csv")
    with open(raw, "w") as fh:
        fh.write("geo,sex,year,value\nIT,T,2020,1.5\nDE,T,x,2\n")
    typed = read_obs(spark, raw, "sex string, geo string, year int, value double", fmt="csv")
    assert [tuple(r) for r in typed.collect()] == [("T", "IT", 2020, 1.5), ("T", "DE", None, 2.0)]
    # newest vintage only
    for v in ("2025", "2026"):
        spark.createDataFrame([(v,)], "v string").write.parquet(os.path.join(tmpdir_fresh, "landed", v))
    assert [r.v for r in read_latest(spark, os.path.join(tmpdir_fresh, "landed")).collect()] == ["2026"]
    p = write_mart(geo, os.path.join(tmpdir_fresh, "marts"), "demo", 2026, "geo", sort_keys=["code"])
    assert spark.read.parquet(p).count() == 2
