"""Every registered query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(data):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return v


def test_every_sql_has_a_query():
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, db, data, name):
    df = QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = db.sql(SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
