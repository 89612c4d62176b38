"""The registered queries that SQL can express, over the smallest verification tables."""

from pathlib import Path

import pytest

from arrivals.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="verification tables are absent")


@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = connection.execute(SQL[name])
    columns = sorted(c[0] for c in expected.description)
    data = [dict(zip([c[0] for c in expected.description], row, strict=True)) for row in expected.fetchall()]
    found = QUERIES[name](spark, str(TABLES))
    assert sorted(found.columns) == columns
    by_name = lambda rows: sorted(repr([r[c] for c in columns]) for r in rows)
    assert by_name(found.collect()) == by_name(data)
