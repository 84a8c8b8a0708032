"""Registered queries against their SQL in DuckDB."""

import duckdb
import pytest

from twinloom.llm import registry

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found, expected = registry.QUERIES[name](spark, SF_DIR), connection.execute(registry.ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(expected.fetchall(), key=repr)
