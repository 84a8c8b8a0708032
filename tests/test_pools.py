"""Value pools, lists of values as tables, and dense positions."""

import os
from collections import Counter

import pytest

from tests.helpers import build, col, ref, specs, table
from twinloom.errors import SpecError, UnsatisfiableError
from twinloom.functions.draws import stream_key
from twinloom.operators import indexing
from twinloom.operators.checks import repeating_columns
from twinloom.operators.generate import Generator, tables_in_turn
from twinloom.operators.indexing import dense_index
from twinloom.session import shared_folder

PARENT = table("p", 400, col("code", "INT", min_value=1, max_value=900, null_ratio=0.2))


def numbers(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(3)


@pytest.mark.parametrize("weighted", [False, True])
def test_positions_are_dense_and_follow_the_values(spark, monkeypatch, weighted):
    monkeypatch.setattr(indexing, "ROWS_PER_BUCKET", 7)
    monkeypatch.setattr(indexing, "BUCKETS_PER_GROUP", 3)
    values = [v for v in range(120) for _ in range(1 + v % 4)] + [7] * 200 + [None] * 9

    def found(rows):
        index = dense_index(rows, 120, 5, shared_folder(spark, "test"), weighted)
        rows = sorted((r.position, r.value) for r in index.rows.collect())
        assert [position for position, _ in rows] == list(range(index.count))
        return [value for _, value in rows]

    order = found(numbers(spark, values))
    expected = Counter(v for v in values if v is not None) if weighted else Counter(range(120))
    assert Counter(order) == expected
    assert order == found(numbers(spark, values[::-1]).repartition(11))
    assert [v for i, v in enumerate(order) if i == 0 or order[i - 1] != v] == list(dict.fromkeys(order))


def test_positions_of_nothing(spark):
    index = dense_index(numbers(spark, [None, None]), 0, 5, shared_folder(spark, "test"))
    assert index.count == 0 and index.rows.collect() == []


def test_values_travel_once_and_no_window_spans_all_of_them(spark):
    values = numbers(spark, range(50))
    index = dense_index(values, 50, 5, shared_folder(spark, "test"))
    plan = index.rows._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "ExistingRDD" not in plan


def test_children_share_a_pool_that_goes_after_the_last(spark):
    child = [ref("v", "p", "code", "ONE_TO_ONE", null_ratio=0.5)]
    tables = specs(PARENT, table("a", 100, *child), table("b", 120, *child), table("c", 50, col("x", "INT")))
    generator = Generator(spark, tables, 1, None)
    folders = []
    for spec in generator.ordered:
        generator.checked_frame(spec, True).collect()
        folders.append(list(generator.pools.folders))
        generator.finish(spec)
    built = {folder for group in folders for folder in group}
    assert len(built) == 1 and [group for group in folders if group] == [list(built)] * 2
    assert not generator.pools.folders and not os.path.exists(built.pop())


def test_pools_of_chains(spark):
    tables = specs(
        PARENT,
        table("a", 100, ref("v", "p", "code", "ONE_TO_ONE")),
        table("b", 300, ref("v", "a", "v")),
        table("c", 90, ref("v", "a", "v", "ONE_TO_ONE", null_ratio=0.1)),
    )
    seen, left = {}, set()
    generator = Generator(spark, tables, 1, None)
    for spec in generator.ordered:
        seen[spec.name] = [r.v if spec.name != "p" else r.code for r in generator.checked_frame(spec, True).collect()]
        left |= set(generator.pools.folders)
        generator.finish(spec)
    assert set(seen["b"]) <= set(seen["a"]) <= set(seen["p"])
    present = [v for v in seen["c"] if v is not None]
    assert len(present) == len(set(present)) == 81 and set(present) <= set(seen["a"])
    assert not generator.pools.folders and not any(os.path.exists(folder) for folder in left)
    in_turn = {name: [r[0] for r in frame.collect()] for name, frame in tables_in_turn(spark, tables, 1)}
    assert in_turn == seen


def test_a_consumer_that_stops_leaves_no_pool(spark):
    tables = specs(PARENT, table("a", 100, ref("v", "p", "code", "ONE_TO_ONE")))
    turns = tables_in_turn(spark, tables, 1)
    for name, _ in turns:
        if name == "a":
            break
    held = turns.gi_frame.f_locals["generator"].pools.folders
    assert held and all(os.path.exists(folder) for folder in held)
    turns.close()
    assert not any(os.path.exists(folder) for folder in held)


def test_lists_as_tables(spark):
    lists = {"words": numbers(spark, ["a", "b", "b", None, "c"], "string"), "many": numbers(spark, [1] * 900 + [2] * 100)}
    spec = table(
        "t", 3000,
        col("w", "STRING", allowed_from="words"),
        col("n", "INT", allowed_from="many", null_ratio=0.1),
        col("s", "INT", "STRING", allowed_from="many"),
    )
    rows = build(spark, spec, lists=lists)["t"].collect()
    words, counts = Counter(r.w for r in rows), Counter(r.n for r in rows)
    assert set(words) == {"a", "b", "c"} and all(850 < n < 1150 for n in words.values())
    assert counts[None] == 300 and 2350 < counts[1] < 2510
    assert {r.s for r in rows} == {"1", "2"}


def test_unique_values_of_a_list(spark):
    lists = {"keys": numbers(spark, [v // 2 for v in range(200)])}
    found = [r.v for r in build(spark, table("t", 110, col("v", "INT", unique=True, allowed_from="keys", null_ratio=0.1)), lists=lists)["t"].collect()]
    assert sorted(v for v in found if v is not None) == sorted(set(v for v in found if v is not None)) and found.count(None) == 11
    with pytest.raises(UnsatisfiableError):
        build(spark, table("t", 101, col("v", "INT", unique=True, allowed_from="keys")), lists=lists)
    with pytest.raises(UnsatisfiableError):
        build(spark, table("t", 4, col("v", "INT", allowed_from="none")), lists={"none": numbers(spark, [None])})


def test_children_of_listed_columns(spark):
    lists = {"keys": numbers(spark, range(1000, 1400))}
    tables = [table("p", 300, col("v", "INT", unique=True, allowed_from="keys")), table("c", 200, ref("v", "p", "v", "ONE_TO_ONE")), table("d", 500, ref("v", "p", "v"))]
    frames = {name: [r.v for r in frame.collect()] for name, frame in build(spark, *tables, lists=lists).items()}
    assert len(set(frames["p"])) == 300 and len(set(frames["c"])) == 200
    assert set(frames["c"]) <= set(frames["p"]) and set(frames["d"]) <= set(frames["p"])


def test_faults_of_lists(spark):
    with pytest.raises(SpecError, match="no list"):
        build(spark, table("t", 5, col("v", "INT", allowed_from="x")))
    with pytest.raises(SpecError, match="one column"):
        build(spark, table("t", 5, col("v", "INT", allowed_from="x")), lists={"x": spark.range(3).selectExpr("id", "id AS b")})
    with pytest.raises(SpecError, match="combined"):
        build(spark, table("t", 5, col("v", "INT", allowed_from="x", allowed_values=[1])), lists={"x": numbers(spark, [1])})


def test_a_list_is_no_part_of_the_plan(spark):
    lists = {"x": spark.range(100_000).selectExpr("id * 3 AS v")}
    frame = build(spark, table("t", 50_000, col("v", "INT", unique=True, allowed_from="x")), lists=lists)["t"]
    assert len(frame._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert frame.distinct().count() == 50_000


def test_repeating_columns_in_one_pass(spark):
    frame = spark.createDataFrame([(1, "a", 1.5, None), (2, "a", 2.5, None), (3, "b", 1.5, None)], "i long, s string, d double, n string")
    assert repeating_columns(frame, ["i", "s", "d", "n"]) == ["s", "d"]
    assert repeating_columns(frame, ["i", "n"]) == [] and repeating_columns(frame, []) == []


def test_stream_of_a_list_is_its_own():
    assert stream_key(1, "list", "a") != stream_key(1, "list", "b")


def test_positions_of_frequent_values_are_never_written_out(spark, monkeypatch):
    """One value with nearly all positions, few and many tiles, long spans cut into pieces."""
    monkeypatch.setattr(indexing, "TILES_PER_PIECE", 3)
    values = [1] * 5_000 + [2] * 300 + [v for v in range(3, 40) for _ in range(v % 5)]
    for tiles in (1, 20, 7_000):
        monkeypatch.setattr(indexing, "TILES", tiles)
        index = dense_index(numbers(spark, values), len(values), 5, shared_folder(spark, "test"), True)
        asked = spark.range(-4, len(values) + 4).withColumnRenamed("id", "k")
        found = {r.k: r.v for r in index.look_up(asked.select("k", asked.k.alias("at")), "at", "v").collect()}
        held = dict(index.rows.select("position", "value").collect())
        assert found == {k: held.get(k) for k in range(-4, len(values) + 4)}
        assert index._tiles().count() <= index.spans.count() + max(tiles, index.spans.count())


def test_a_list_of_few_values_is_looked_up_by_few_rows(spark):
    lists = {"few": spark.range(3_000_000).selectExpr("id % 7 AS v")}
    frame = build(spark, table("t", 2_000, col("v", "INT", allowed_from="few")), lists=lists)["t"]
    assert frame.distinct().count() == 7

    def rows_out(node):
        own = [node.metrics().apply("numOutputRows").value()] if node.metrics().contains("numOutputRows") else []
        inner = [node.finalPhysicalPlan()] if hasattr(node, "finalPhysicalPlan") and "AdaptiveSparkPlan" in node.nodeName() else []
        inner += [node.plan()] if "QueryStage" in node.nodeName() else []
        below = [node.children().apply(i) for i in range(node.children().size())]
        return own + [n for child in inner + below for n in rows_out(child)]

    frame.collect()
    counted = rows_out(frame._jdf.queryExecution().executedPlan())
    assert counted and max(counted) < 10_000
