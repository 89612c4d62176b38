"""Every registered query against its SQL, over the smallest verification tables."""

from pathlib import Path

import pytest
from helpers import planned

import __spark_entry__ as registry
from arrivals.catalog import all_queries, all_sql

duckdb = pytest.importorskip("duckdb")

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="verification tables are absent")

SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(columns, data):
    """Rows with their columns in the order of the names, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, sql, name):
    found = all_queries()[name](spark, str(TABLES))
    expected = sql.execute(all_sql()[name])
    columns = [c[0] for c in expected.description]
    types = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in found.schema}
    assert types == {c[0]: str(c[1]) for c in expected.description}
    data = ordered(columns, expected.fetchall())
    assert data
    assert ordered(found.columns, found.collect()) == data
    plan = planned(found)
    for slow in ("Python", "CartesianProduct", "NestedLoopJoin", "Window"):
        assert slow not in plan


def test_entry(spark):
    assert registry.entry(spark).limit(1).count() == 1
