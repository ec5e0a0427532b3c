"""Operators on the hand-made golden cube with literal expected output
(ties, NULL values, a non-member country, aggregates, a single-year window,
negative values)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from regiocube.operators import benchmark, synthesis, trend


def _rows(df, *cols):
    return {tuple(r[c] for c in cols[:3]): tuple(r[c] for c in cols[3:]) for r in df.collect()}


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and math.isnan(a):
        return isinstance(b, float) and math.isnan(b)
    return abs(a - b) < 1e-9


@pytest.mark.parametrize("slice_first", [True, False])
def test_geo_benchmark_golden(golden_clean, slice_first):
    out = benchmark.geo_benchmark(golden_clean, {"unit": "PC"}, ["unit"], slice_first=slice_first)
    assert out.count() == 14
    got = _rows(out, "year", "geo", "unit", "media_eu_value", "media_paese_value", "percentile_eu",
                "rank_nazionale", "distanza_media_eu_pct")
    expected = {
        (2020, "CH01", "PC"): (22.5, 5.0, None, 1, -77.8),
        (2020, "DE11", "PC"): (22.5, 30.0, 0.6667, 1, 33.3),
        (2020, "DE12", "PC"): (22.5, 30.0, 0.6667, 1, 33.3),
        (2020, "ITC1", "NR"): (None, None, None, None, None),
        (2020, "ITC1", "PC"): (22.5, 15.0, 0.0, 2, -55.6),
        (2020, "ITC2", "PC"): (22.5, 15.0, 0.3333, 1, -11.1),
        (2020, "CH", "PC"): (22.5, 5.0, None, 1, -77.8),
        (2020, "DE", "PC"): (22.5, 30.0, 1.0, 1, 33.3),
        (2020, "IT", "PC"): (22.5, 15.0, 0.0, 1, -33.3),
        (2020, "FR", "NR"): (None, None, None, None, None),
        (2023, "CH01", "PC"): (21.83, -5.5, None, 1, -125.2),
        (2023, "DE11", "PC"): (21.83, 33.0, 1.0, 1, 51.1),
        (2023, "ITC1", "PC"): (21.83, 16.25, 0.0, 2, -42.7),
        (2023, "ITC2", "PC"): (21.83, 16.25, 0.5, 1, -8.4),
    }
    assert set(got) == set(expected)
    for k, exp in expected.items():
        assert all(_close(a, b) for a, b in zip(got[k], exp)), (k, got[k], exp)


def test_geo_benchmark_requires_slice_dims_in_partition(golden_clean):
    with pytest.raises(ValueError):
        benchmark.geo_benchmark(golden_clean, {"unit": "PC"}, [])


def test_trend_golden(golden_clean):
    out = trend.trend(golden_clean, {"unit": "PC"}).filter(F.col("nuts_level") == "NUTS2")
    got = _rows(out, "geo", "first_year", "last_year", "years_observed", "first_value", "last_value",
                "delta_abs", "delta_pct", "cagr_pct")
    expected = {
        ("CH01", 2020, 2023): (3, 5.0, -5.5, -10.5, -210.0, float("nan")),
        ("DE11", 2020, 2023): (3, 30.0, 33.0, 3.0, 10.0, 3.228),
        ("DE12", 2020, 2020): (0, 30.0, 30.0, 0.0, 0.0, None),
        ("ITC1", 2020, 2023): (3, 10.0, 12.5, 2.5, 25.0, 7.722),
        ("ITC2", 2020, 2023): (3, 20.0, 20.0, 0.0, 0.0, 0.0),
    }
    assert set(got) == set(expected)
    for k, exp in expected.items():
        assert all(_close(a, b) for a, b in zip(got[k], exp)), (k, got[k], exp)


def test_trend_guard_nulls_negative_ratio(golden_clean):
    out = trend.trend(golden_clean, {"unit": "PC"}, guard_last_nonneg=True)
    row = out.filter(F.col("geo") == "CH01").collect()[0]
    assert row["cagr_pct"] is None


def test_country_synthesis_golden(golden_clean):
    out = synthesis.country_synthesis(golden_clean, {"metric": {"unit": "PC"}}).filter("year = 2020")
    got = {r["country"]: (r["metric"], r["rank_procapite_eu"], r["distanza_media_eu_pct"])
           for r in out.collect()}
    assert got == {
        "CH": (5.0, None, -77.8),
        "DE": (30.0, 1, 33.3),
        "IT": (15.0, 2, -33.3),
        "FR": (None, 3, None),  # NULL metric still takes the last rank
    }


def test_country_rollup_sum_and_avg(golden_clean):
    s = synthesis.country_rollup(golden_clean, {"unit": "PC"}, "m", level="NUTS2", agg="sum")
    got = {(r["year"], r["country"]): r["m"] for r in s.collect()}
    assert got[(2020, "IT")] == 30.0 and got[(2020, "DE")] == 60.0 and got[(2023, "DE")] == 33.0
    a = synthesis.country_rollup(golden_clean, {"unit": "PC"}, "m", level="NUTS2", agg="avg",
                                 round_metric=1)
    got = {(r["year"], r["country"]): r["m"] for r in a.collect()}
    assert got[(2023, "IT")] == 16.3  # (12.5 + 20) / 2 = 16.25 -> half away from zero
