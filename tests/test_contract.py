"""Driver queries against their reference SQL on the smallest tables."""

from __future__ import annotations

import decimal
from datetime import datetime

import pytest

import __spark_entry__ as contract
from tidemark.plans import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return value.isoformat() if isinstance(value, datetime) else repr(value)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_reference_sql():
    assert registry.registered().keys() == oracle.SQL.keys()


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    where = [names.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in where) for r in cursor.fetchall())
    assert got == want
