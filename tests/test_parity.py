"""Every registered query gives the rows its SQL gives."""

import decimal
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from parity import ORACLES, QUERIES

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: [(v is not None, str(v)) for v in row],
    )


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "DECIMAL(18,2)": "decimal(18,2)",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(expected.columns)
    kinds = {column: KINDS[str(kind)] for column, kind in zip(expected.columns, expected.types)}
    assert dict(result.dtypes) == kinds
    got = _rows(result.columns, [tuple(row) for row in result.collect()])
    want = _rows(expected.columns, expected.fetchall())
    assert len(got) == len(want) > 0
    assert got == want


def test_entry_has_rows(spark):
    assert entry(spark).count() == 2
