"""Queries that SQL can express, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from regiocube.llm.oracle import ORACLE_SQL
from regiocube.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(want.columns)
    rows = want.fetchall()
    order = [want.columns.index(c) for c in columns]
    got = QUERIES[name](spark, SF_SMALL).select(columns)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(r[i] for i in order) for r in rows), key=key)


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
