"""Every registered query against its SQL, over the smallest folder of test tables."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as contract
from stagedoor.catalog import oracles
from stagedoor.catalog.queries import queries as catalog

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    return "~" if value is None else repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted([plain(row[i]) for i in order] for row in rows)


@pytest.mark.parametrize("name", sorted(catalog()))
def test_query_equals_its_sql(spark, engine, name):
    result = catalog()[name](spark, FOLDER)
    cursor = engine.execute(oracles.statements()[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(result.columns, [tuple(r) for r in result.collect()]) == expected
    assert expected[1], "the query has no rows to compare"


def test_contract():
    assert set(catalog()) == set(oracles.statements())
    assert set(catalog()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 27
