"""Property-based checks against brute force (hypothesis).

Each example is evaluated in one Spark job over a whole generated batch, so
the properties stay cheap while covering many values.
"""

from __future__ import annotations

import math

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regiocube.functions import round_half_away, to_bigint
from regiocube.operators.trend import trend

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=8, deadline=None)
@given(st.lists(finite, min_size=1, max_size=300), st.integers(min_value=0, max_value=4))
def test_rounding_matches_published_engine(spark, values, digits):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    mine = [r[0] for r in df.orderBy("i").select(round_half_away("v", digits)).collect()]
    ref = [r[0] for r in duckdb.sql(
        f"SELECT ROUND(v, {digits}) FROM (SELECT UNNEST(?::DOUBLE[]) AS v)", params=[values]).fetchall()]
    assert mine == ref


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=1, max_size=300))
def test_bigint_cast_matches_published_engine(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    mine = [r[0] for r in df.orderBy("i").select(to_bigint("v")).collect()]
    ref = [r[0] for r in duckdb.sql("SELECT CAST(v AS BIGINT) FROM (SELECT UNNEST(?::DOUBLE[]) AS v)",
                                     params=[values]).fetchall()]
    assert mine == ref


series = st.dictionaries(
    keys=st.sampled_from(["ITC1", "ITC2", "DE11", "DE12", "CH01"]),
    values=st.dictionaries(st.integers(min_value=2000, max_value=2010),
                           st.one_of(st.none(), st.integers(min_value=-50, max_value=500).map(float)),
                           min_size=1, max_size=6),
    min_size=1, max_size=5)


def _brute_trend(data):
    out = {}
    for geo, by_year in data.items():
        pts = sorted((y, v) for y, v in by_year.items() if v is not None)
        if not pts:
            continue
        (fy, fv), (ly, lv) = pts[0], pts[-1]
        cagr = None
        if ly > fy and fv > 0:
            ratio = lv / fv
            cagr = float("nan") if ratio < 0 else (ratio ** (1.0 / (ly - fy)) - 1) * 100
        dpct = None if fv == 0 else (lv / fv - 1) * 100
        out[geo] = (fy, ly, ly - fy, fv, lv, lv - fv, dpct, cagr)
    return out


@settings(max_examples=10, deadline=None)
@given(series)
def test_trend_matches_brute_force(spark, data):
    rows = [("PC", geo, geo[:2], "NUTS2", y, v) for geo, by_year in data.items() for y, v in by_year.items()]
    clean = spark.createDataFrame(rows, "unit string, geo string, country string, nuts_level string, "
                                        "year int, value double").withColumn("geo_label_en", F.col("geo"))
    got = {r.geo: r for r in trend(clean, {"unit": "PC"}, round_abs=6, round_pct=6, round_cagr=6).collect()}
    exp = _brute_trend(data)
    assert set(got) == set(exp)
    for geo, (fy, ly, yrs, fv, lv, dabs, dpct, cagr) in exp.items():
        r = got[geo]
        assert (r.first_year, r.last_year, r.years_observed, r.first_value, r.last_value) == (fy, ly, yrs, fv, lv)
        assert math.isclose(r.delta_abs, dabs, abs_tol=1e-6)
        assert (r.delta_pct is None) == (dpct is None)
        if dpct is not None:
            assert math.isclose(r.delta_pct, dpct, rel_tol=1e-9, abs_tol=1e-5)
        if cagr is None:
            assert r.cagr_pct is None
        elif math.isnan(cagr):
            assert math.isnan(r.cagr_pct)
        else:
            assert math.isclose(r.cagr_pct, cagr, rel_tol=1e-9, abs_tol=1e-5)
