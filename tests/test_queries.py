"""Every registered query against its SQL in another engine, on the smallest tables."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ordermill.plans.queries import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def order(row):
    return tuple((v is None, str(v)) for v in row)


def test_every_query_has_its_sql():
    assert set(REGISTRY) <= set(entry.queries()) and set(REGISTRY) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, other, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=order)
    result = other.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    position = [list(types).index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in position) for r in result.fetchall()), key=order)
    assert sorted(types) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert len(found) == len(expected) and found == expected
    assert found or name == "dim_date_extension"
