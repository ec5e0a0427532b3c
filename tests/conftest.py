from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from regiocube.session import build_session

    s = build_session(app="regiocube-tests", master="local[4]", shuffle_partitions=8,
                      checkpoint_dir=tempfile.mkdtemp(prefix="regiocube-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="regiocube-test-")


# FIXTURES.md §5: hand-made golden cube (EU members IT, DE, FR; CH outside).
GOLDEN_ROWS = [
    ("A", "PC", "ITC1", 2020, 10.0), ("A", "PC", "ITC1", 2023, 12.5),
    ("A", "PC", "ITC2", 2020, 20.0), ("A", "PC", "ITC2", 2023, 20.0),
    ("A", "PC", "DE11", 2020, 30.0), ("A", "PC", "DE11", 2023, 33.0),
    ("A", "PC", "DE12", 2020, 30.0), ("A", "PC", "DE12", 2023, None),
    ("A", "PC", "CH01", 2020, 5.0), ("A", "PC", "CH01", 2023, -5.5),
    ("A", "NR", "ITC1", 2020, 1000.0), ("A", "PC", "IT", 2020, 15.0),
    ("A", "PC", "DE", 2020, 30.0), ("A", "PC", "CH", 2020, 5.0),
    ("A", "NR", "FR", 2020, 7.0), ("A", "PC", "EU27_2020", 2020, 22.0),
]

GOLDEN_GEO = [
    ("IT", "Italy", "country", ""), ("DE", "Germany", "country", ""),
    ("FR", "France", "country", ""), ("CH", "Switzerland", "country", ""),
    ("ITC", "Nord-Ovest", "NUTS1", "IT"), ("DE1", "Baden-Wuerttemberg", "NUTS1", "DE"),
    ("CH0", "Schweiz", "NUTS1", "CH"),
    ("ITC1", "Piemonte", "NUTS2", "ITC"), ("ITC2", "Valle d'Aosta", "NUTS2", "ITC"),
    ("DE11", "Stuttgart", "NUTS2", "DE1"), ("DE12", "Karlsruhe", "NUTS2", "DE1"),
    ("CH01", "Region lemanique", "NUTS2", "CH0"),
    ("EU27_2020", "European Union - 27 countries (from 2020)", "", ""),
]


@pytest.fixture(scope="session")
def golden_clean(spark):
    from regiocube.operators.enrich import clean_observations

    obs = spark.createDataFrame(
        [(f, u, g, y, v, None) for f, u, g, y, v in GOLDEN_ROWS],
        "freq string, unit string, geo string, year int, value double, flag string")
    geo = spark.createDataFrame(GOLDEN_GEO, "code string, label_en string, nuts_level string, parent_code string")
    units = spark.createDataFrame([("PC", "Percentage"), ("NR", "Number")], "code string, label_en string")
    return clean_observations(obs, ["freq", "unit", "geo"], geo, codelists={"unit": units})
