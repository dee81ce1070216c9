"""Every registered query against its SQL twin on the smallest data set."""

import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from conftest import SMALL
from dockside.registry import QUERIES
from oracles import ORACLES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return "" if v is None else repr(v)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    have = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    assert have == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_point.queries()) >= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
