"""Every registered query against its SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from sparsemat import plans

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_matches_sql(spark, db, name):
    ours = contract.queries()[name](spark, SF_DIR)
    cursor = db.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(ours.columns) == sorted(columns)

    def key(row):
        return tuple((v is not None, v) for v in row)

    theirs = sorted(cursor.fetchall(), key=key)
    rows = sorted((tuple(r) for r in ours.select(*columns).collect()), key=key)
    assert rows == theirs
    assert rows
