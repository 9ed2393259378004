"""Every registered query against its SQL, on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from newsloom.plans.oracle import SQL
from newsloom.plans.queries import REGISTRY

FOLDER = os.environ.get("NEWSLOOM_TESTDATA", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not found")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_a_check():
    """Those of the optional subpackage are checked in its own tests."""
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    got = entry_point.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in got.collect()]
    want = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows, "the query gave nothing to compare"
    assert ordered(got.columns, rows) == ordered(want.columns, want.fetchall())
