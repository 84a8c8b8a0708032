import pytest
from pyspark.sql import functions as F

from entry_queries.duck import hash_long
from twinloom.functions.draws import draw, draw_below, stream_key
from twinloom.functions.ordering import Permutation, multiplier, spread_index
from twinloom.functions.stages import Stages, Term


def positions(spark, size, ids, direction="forward"):
    stages = Stages()
    frame = spark.createDataFrame([(i,) for i in ids], "id bigint")
    permutation = Permutation(size, 7, "t", "c")
    result = getattr(permutation, direction)(stages, Term(F.col("id"), 0))
    rows = stages.apply(frame).select("id", result.column.alias("p")).collect()
    return {row.id: row.p for row in rows}


def expected_position(size, row):
    """The permutation in plain integers."""
    x = (row * multiplier(stream_key(7, "t", "c", "affine"), size) + stream_key(7, "t", "c", "offset")) % size
    for number in range(4):
        key = stream_key(7, "t", "c", "round", number)
        y = (key % size - x) % size
        if hash_long(min(x, y), hash_long(key)) >> 63:
            x = y
    return x


def test_draw_is_xxh64(spark):
    rows = spark.range(50).select("id", draw(123456789, F.col("id")).alias("d")).collect()
    assert all(row.d % (1 << 64) == hash_long(row.id, hash_long(123456789)) for row in rows)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4096])
def test_permutation_is_a_bijection(spark, size):
    forward = positions(spark, size, range(size))
    assert sorted(forward.values()) == list(range(size))
    backward = positions(spark, size, range(size), "backward")
    assert all(backward[p] == i for i, p in forward.items())


@pytest.mark.parametrize("size", [(1 << 31) - 1, (1 << 31) + 11, 10**12 + 1, (1 << 41) + 9, 10**15 + 3])
def test_large_permutations_stay_exact(spark, size):
    ids = [0, 1, 2, size // 3, size // 2, size - 2, size - 1]
    forward = positions(spark, size, ids)
    assert forward == {i: expected_position(size, i) for i in ids}
    backward = positions(spark, size, list(forward.values()), "backward")
    assert all(backward[p] == i for i, p in forward.items())


def test_null_positions_are_spread_evenly(spark):
    size, nulls = 20_000, 2_000
    chosen = [i for i, p in positions(spark, size, range(size)).items() if p < nulls]
    per_block = [sum(start <= i < start + 2_000 for i in chosen) for start in range(0, size, 2_000)]
    assert len(chosen) == nulls and min(per_block) > 140 and max(per_block) < 260
    gaps = {b - a for a, b in zip(sorted(chosen), sorted(chosen)[1:])}
    assert len(gaps) > 15  # not a regular lattice


@pytest.mark.parametrize("count, space", [(5, 5), (5, 7), (100, 130), (100, 10**6), (1000, 1001), (1, 50), (7, (1 << 62) - 1)])
def test_spread_index_is_distinct_and_in_range(spark, count, space):
    index = spread_index(F.col("id"), count, space, 99, F.col("id"))
    found = [row.i for row in spark.range(count).select(index.alias("i")).collect()]
    assert len(set(found)) == count and min(found) >= 0 and max(found) < space


def test_every_value_of_the_space_can_be_drawn(spark):
    seen = set()
    for key in range(200):
        index = spread_index(F.col("id"), 3, 10, key, F.col("id"))
        seen |= {row.i for row in spark.range(3).select(index.alias("i")).collect()} if key % 10 == 0 else set()
    assert len(seen) >= 9


@pytest.mark.parametrize("bound", [1, 2, 1000, 1 << 50, (1 << 50) + 1, 1 << 63, 1 << 64])
def test_draws_stay_below_their_bound(spark, bound):
    found = [int(r.d) for r in spark.range(200).select(draw_below(bound, 5, F.col("id")).alias("d")).collect()]
    assert min(found) >= 0 and max(found) < bound
    if bound > 1000:
        assert max(found) > bound * 0.9
