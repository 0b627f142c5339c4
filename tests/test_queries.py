"""Every query against the SQL it is checked with, value by value."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

QUERIES = entry_points.catalogue.queries()
STATEMENTS = entry_points.oracle.statements()

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is not None, v if v is not None else 0) for v in row])


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = _sorted(tuple(r) for r in df.select(columns).collect())
    cursor = duck.execute(STATEMENTS[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(types) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [list(types).index(c) for c in columns]
    expected = _sorted(tuple(r[i] for i in order) for r in cursor.fetchall())
    assert got == expected


def test_entry_points_have_all_queries():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(STATEMENTS) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 1 and len(df.columns) == 9
