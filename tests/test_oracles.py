"""Every registered query against its SQL on the driver's smallest tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from catalogue import plans
from catalogue.plans import registry
from catalogue.plans.bindings import TABLES

plans.load()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES
SPARK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


def bag(rows):
    return sorted((tuple((v is None, type(v).__name__, str(v)) for v in r) for r in rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == cols
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: SPARK_TYPES[t] for c, t in df.dtypes} == types
    at = [want.columns.index(c) for c in cols]
    assert bag(rows) == bag([tuple(plain(r[i]) for i in at) for r in want.fetchall()])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1
