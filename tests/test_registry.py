"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from check import TABLES, rows_of
from starloom.registry import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    cur = duck.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names, key=str.lower) == sorted(df.columns, key=str.lower)
    assert got == rows_of(names, cur.fetchall())
