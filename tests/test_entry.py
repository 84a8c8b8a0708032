"""Every registered query against its SQL in DuckDB, on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL = {name: sql for group in contract._GROUPS if "llm" not in group.__name__ for name, sql in group.ORACLES.items()}
QUERIES = {name: run for name, run in contract.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    own = [group for group in contract._GROUPS if "llm" not in group.__name__]
    assert {name for group in own for name in group.QUERIES} == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert bag(frame.columns, frame.collect()) == bag(columns, result.fetchall())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [row.status for row in rows] == ["MATCH"]
