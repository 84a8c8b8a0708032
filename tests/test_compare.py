from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from twinloom.errors import CompareError
from twinloom.operators.compare import (
    compare,
    comparison_columns,
    difference_metrics,
    exclusive_rows,
    normalize,
    report_frame,
    row_balance,
    with_verdict,
)


def fails(code):
    return pytest.raises(CompareError, check=lambda error: error.code == code)


def metrics(left, right):
    return tuple(difference_metrics(left, right).first())


CELLS = hs.tuples(
    hs.sampled_from([None, 1, 2]),
    hs.sampled_from([None, 0.0, -0.0, 0.1, 1e-19, 2e-19, float("nan")]),
    hs.sampled_from([None, "a", "b"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(CELLS, max_size=12), hs.lists(CELLS, max_size=12))
def test_one_pass_equals_except_all_of_normalised_rows(spark, left, right):
    spark.conf.set("spark.sql.ansi.enabled", "false")  # NaN has no decimal under ANSI
    try:
        a, b = (spark.createDataFrame(side, "i int, x double, s string") for side in (left, right))
        na, nb = normalize(a, a.columns), normalize(b, b.columns)
        expected = (len(left), len(right), na.exceptAll(nb).count(), nb.exceptAll(na).count())
        assert metrics(a, b) == expected
        assert sorted(map(str, exclusive_rows(a, b, 2).collect())) == sorted(map(str, na.exceptAll(nb).collect()))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_bag_semantics(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (3, "y")], "a int, b string")
    assert metrics(left, right) == (3, 2, 2, 1)
    balance = {tuple(r)[:2]: tuple(r)[2:] for r in row_balance(left, right).collect()}
    assert balance == {(1, None): (2, 1), (2, "x"): (1, 0), (3, "y"): (0, 1)}
    assert Counter(tuple(r) for r in exclusive_rows(left, right).collect()) == {(1, None): 1, (2, "x"): 1}


def test_a_row_with_many_copies_is_split(spark):
    left = spark.range(1000).selectExpr("1 AS a").unionAll(spark.range(5).selectExpr("int(id) AS a"))
    right = spark.range(90).selectExpr("1 AS a")
    found = exclusive_rows(left, right, copies_per_task=100)
    assert Counter(r.a for r in found.collect()) == {0: 1, 1: 911, 2: 1, 3: 1, 4: 1}
    assert exclusive_rows(right, left).isEmpty()


def test_one_shuffle_per_combination(spark):
    left = spark.range(10).selectExpr("id AS a", "cast(id AS string) AS b")
    plan = difference_metrics(left, left)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert metrics(left, left) == (10, 10, 0, 0)


def test_mixed_types_are_normalised(spark):
    left = spark.createDataFrame([(1, True, Decimal("0.10"), 7)], "a tinyint, b boolean, c decimal(4,2), d int")
    right = left.selectExpr("cast(a AS bigint) AS a", "string(b) AS b", "cast(c AS double) AS c", "d")
    assert metrics(left, right) == (1, 1, 0, 0)
    single = left.selectExpr("a", "b", "cast(c AS float) AS c", "d")
    assert metrics(right, single.selectExpr("a", "b", "c", "d")) == (1, 1, 1, 1)  # float 0.1 is not double 0.1


def test_column_choice(spark):
    left = spark.createDataFrame([], "id int, Load_Part int, day date, seen string, note string")
    right = spark.createDataFrame([], "seen timestamp_ntz, id bigint, day string, job_insert_id int, NOTE2 string")
    chosen = comparison_columns(left.schema, right.schema, ("load_part", "Note"), ("JOB_INSERT_ID", "note2"))
    assert chosen.compared == ("id",)
    assert chosen.left_excluded == ("Load_Part", "note") and chosen.right_excluded == ("job_insert_id", "NOTE2")
    assert chosen.temporal_excluded == ("day", "seen")
    opted = comparison_columns(left.schema, left.schema, (), (), compare_temporal=True)
    assert "day" in opted.compared and not opted.temporal_excluded


def test_errors(spark):
    ints = spark.createDataFrame([], "a int, b int")
    with fails("COMPARISON_COLUMN_NAMES_MISMATCH"):
        compare(ints, ints.withColumnRenamed("a", "c"))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with fails("COMPARISON_COLUMN_NAMES_MISMATCH"):
            compare(ints, ints.withColumnRenamed("a", "A"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    with fails("COMPARISON_DUPLICATE_COLUMNS"):
        compare(ints.select("a", F.col("b").alias("a")), ints)
    with fails("COMPARISON_SCHEMA_MISMATCH"):
        compare(ints, ints.withColumn("a", F.col("a").cast("double")))
    nested = ints.withColumn("a", F.array("a"))
    with fails("COMPARISON_UNSUPPORTED_TYPE"):
        compare(nested, nested)
    compare(nested, nested, ["a"], ["a"])  # an excluded nested column is fine


def test_report(spark):
    left = spark.range(4).selectExpr("id AS a", "1 AS load_part", "current_date() AS d")
    right = spark.range(1, 7).selectExpr("id AS a", "current_timestamp() AS d")
    columns, verdict = compare(left, right)
    report = report_frame(columns, verdict, "r", "now", "l", "i").first().asDict(recursive=True)
    assert report["status"] == "MISMATCH"
    assert report["summary"] == {
        "row_count": {"hive": 4, "iceberg": 6},
        "row_count_delta": 2,
        "exclusive_row_count": {"hive": 1, "iceberg": 3},
        "exclusive_row_ratio": {"hive": 0.25, "iceberg": 0.5},
    }
    assert report["excluded_columns"] == {"hive": ["load_part"], "iceberg": [], "temporal": ["d"]}
    assert report["compared_columns"] == ["a"]


def test_empty_sides_and_no_comparable_column(spark):
    empty = spark.createDataFrame([], "a int")
    row = with_verdict(difference_metrics(empty, empty)).first()
    assert (row.left_ratio, row.right_ratio, row.status) == (0.0, 0.0, "MATCH")
    days = spark.range(3).selectExpr("current_date() AS d")
    columns, verdict = compare(days, days.limit(2))
    assert columns.compared == ()
    row = verdict.first()
    assert (row.left_count, row.right_count, row.left_exclusive, row.right_exclusive) == (3, 2, 1, 0)


def test_odd_column_names(spark):
    frame = spark.createDataFrame([(1, 0.5)], "`a.b` int, `c``d` double")
    assert metrics(frame, frame) == (1, 1, 0, 0)
    _, verdict = compare(frame, frame)
    assert verdict.first().status == "MATCH"
