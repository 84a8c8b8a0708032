import string
from collections import Counter
from datetime import date, datetime
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import build, col, ref, specs, table, values
from twinloom.errors import SpecError, UnsatisfiableError
from twinloom.functions.doubles import GridDoubles
from twinloom.operators.checks import orphan_values
from twinloom.operators.generate import dependency_order, generate_table, generate_tables
from twinloom.plans.spec import ReferenceColumn, Table
from twinloom.plans.types import Cardinality
from twinloom.plans.types import LogicalType as T


def test_ranges_are_closed(spark):
    assert set(values(spark, 500, "INT", min_value=3, max_value=6)) == {3, 4, 5, 6}
    days = set(values(spark, 500, "DATE", min_value="2024-02-28", max_value="2024-03-01"))
    assert days == {date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)}
    times = set(values(spark, 300, "TIMESTAMP", min_timestamp="2024-01-01 23:59:59", max_timestamp="2024-01-02 00:00:00.9"))
    assert times == {datetime(2024, 1, 1, 23, 59, 59), datetime(2024, 1, 2)}
    assert set(values(spark, 300, "FLOAT", min_value=-0.1, max_value=0.1, precision=1)) == {-0.1, 0.0, 0.1}
    assert set(values(spark, 300, "FLOAT", min_value=1, max_value=2, precision=0)) == {1.0, 2.0}
    assert set(values(spark, 100, "BOOLEAN")) == {True, False}


def test_float_ends_have_half_weight(spark):
    counts = Counter(values(spark, 20_000, "FLOAT", min_value=0, max_value=4, precision=0))
    assert 2_200 < counts[0.0] < 2_800 and 2_200 < counts[4.0] < 2_800 and 4_600 < counts[2.0] < 5_400


def test_float_ranges_beyond_the_64_bit_grid(spark):
    found = values(spark, 500, "FLOAT", min_value=-1e300, max_value=1e300)
    assert min(found) < -5e299 and max(found) > 5e299 and len(set(found)) == 500
    found = values(spark, 500, "FLOAT", min_value=0, max_value=1e15, precision=2)
    assert all(0 <= v <= 1e15 and v == round(v, 2) for v in found)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 22), st.data())
def test_doubles_of_a_grid_are_numbered_in_order(precision, data):
    doubles = GridDoubles(precision)
    middle = data.draw(st.sampled_from([0, doubles.points, -doubles.points, doubles.points + 2**52, 10**15, -(10**18)]))
    ranks = range(middle - 4, middle + 5)
    found = [doubles.value(rank) for rank in ranks]
    assert all(a < b for a, b in zip(found, found[1:]))
    assert [doubles.rank(value) for value in found] == list(ranks)
    assert all(float(round(Fraction(value) * 10**precision) / Fraction(10**precision)) == value for value in found)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 12), st.floats(0, 1e25))
def test_every_grid_point_becomes_a_numbered_double(precision, value):
    point = round(Fraction(value) * 10**precision)
    near = float(Fraction(point, 10**precision))
    doubles = GridDoubles(precision)
    assert doubles.value(doubles.rank(near)) == near


@pytest.mark.parametrize("low, high, precision", [(0, 1e18, 2), (-1e300, 1e300, 2), (2**46 - 1, 2**46 + 1, 2), (-5e15, 1e15, 0)])
def test_unique_floats_beyond_the_exact_grid(spark, low, high, precision):
    found = values(spark, 150, "FLOAT", min_value=low, max_value=high, precision=precision, unique=True)
    assert len(set(found)) == 150 and all(low <= v <= high for v in found)
    doubles = GridDoubles(precision)
    assert all(doubles.value(doubles.rank(v)) == v for v in found)


def test_all_doubles_of_a_small_dense_range_are_used(spark):
    low, high = 2.0**46 - 0.03, 2.0**46 + 0.0625
    doubles = GridDoubles(2)
    expected = [doubles.value(r) for r in range(doubles.rank(low), doubles.rank(high) + 1)]
    assert sorted(values(spark, len(expected), "FLOAT", min_value=low, max_value=high, unique=True)) == expected
    with pytest.raises(UnsatisfiableError):
        values(spark, len(expected) + 1, "FLOAT", min_value=low, max_value=high, unique=True)


@pytest.mark.parametrize("extra", [{"lowercase": True, "length": 20}, {"lowercase": True, "length": 33}])
def test_long_unique_strings_share_beginnings_like_a_random_sample(spark, extra):
    found = values(spark, 2_000, "STRING", unique=True, **extra)
    assert len(set(found)) == 2_000
    for part in (slice(0, 3), slice(10, 13), slice(-3, None)):
        counts = Counter(text[part] for text in found)
        pairs = sum(n * (n - 1) // 2 for n in counts.values())
        assert 70 < pairs < 160  # 113.7 expected


def test_long_unique_digits(spark):
    found = values(spark, 1_000, "STRING", unique=True, length=25, character_set="digits")
    assert len(set(found)) == 1_000 and all(len(v) == 25 and v[0] != "0" for v in found)
    assert len({v[1:4] for v in found}) < 700  # not all different: 632 expected


def test_int64_extremes(spark):
    found = values(spark, 2_000, "INT", min_value=-(2**63), max_value=2**63 - 1)
    assert min(found) < -(2**62) and max(found) > 2**62
    unique = values(spark, 1_000, "INT", unique=True, min_value=-(2**63), max_value=2**63 - 1)
    assert len(set(unique)) == 1_000


@pytest.mark.parametrize(
    "kind, constraints",
    [
        ("INT", {"min_value": 5, "max_value": 1004}),
        ("INT", {"digits_count": 4}),
        ("FLOAT", {"min_value": 0, "max_value": 9.99}),
        ("DATE", {}),
        ("TIMESTAMP", {}),
        ("STRING", {"length": 2}),
        ("STRING", {"length": 3, "digits_only": True}),
        ("STRING", {"length": 30, "character_set": "alphanumeric"}),
        ("STRING", {"length": 25, "character_set": "digits"}),
    ],
)
def test_unique_columns(spark, kind, constraints):
    rows = 900
    found = values(spark, rows, kind, unique=True, **constraints)
    assert len(found) == len(set(found)) == rows


def test_unique_space_may_be_used_up(spark):
    assert sorted(values(spark, 90, "INT", unique=True, digits_count=2)) == list(range(10, 100))
    assert sorted(values(spark, 26, "STRING", unique=True, length=1, lowercase=True)) == list(string.ascii_lowercase)
    assert sorted(values(spark, 3, "INT", unique=True, allowed_values=[7, 7, 8, 9])) == [7, 8, 9]
    assert sorted(values(spark, 2, "BOOLEAN", unique=True)) == [False, True]


@pytest.mark.parametrize(
    "rows, kind, constraints",
    [
        (91, "INT", {"digits_count": 2}),
        (12, "FLOAT", {"min_value": 0, "max_value": 1, "precision": 1}),
        (367, "DATE", {"min_value": "2024-01-01", "max_value": "2024-12-31"}),
        (62, "TIMESTAMP", {"min_timestamp": "2024-01-01", "max_timestamp": "2024-01-01 00:01:00"}),
        (53, "STRING", {"length": 1}),
        (3, "BOOLEAN", {}),
        (3, "STRING", {"allowed_values": ["a", "b", "a"]}),
    ],
)
def test_unique_space_too_small(spark, rows, kind, constraints):
    with pytest.raises(UnsatisfiableError):
        values(spark, rows, kind, unique=True, **constraints)


@pytest.mark.parametrize("ratio, nulls", [(0, 0), (0.1, 10), (0.29, 28), (0.999, 99), (1.0, 100)])
def test_exact_null_counts(spark, ratio, nulls):
    for extra in ({}, {"unique": True}):
        found = values(spark, 100, "INT", null_ratio=ratio, **extra)
        assert found.count(None) == nulls
        if extra:
            assert len({v for v in found if v is not None}) == 100 - nulls


def test_uniqueness_counts_non_null_rows_only(spark):
    found = values(spark, 100, "INT", unique=True, null_ratio=0.9, min_value=1, max_value=10)
    assert sorted(v for v in found if v is not None) == list(range(1, 11))


def test_allowed_values_weights(spark):
    ints = Counter(values(spark, 9_000, "INT", allowed_values=[1, 1, 2]))
    assert 5_700 < ints[1] < 6_300
    texts = Counter(values(spark, 9_000, "STRING", allowed_values=["a", "a", "b"]))
    assert 4_200 < texts["a"] < 4_800
    assert set(values(spark, 50, "INT", allowed_values=[])) - {0, 1}  # an empty list means none


def test_strings(spark):
    assert all(set(v) <= set(string.ascii_letters) and len(v) == 10 for v in values(spark, 100, "STRING"))
    upper = values(spark, 200, "STRING", length=40, uppercase=True, character_set="alphanumeric")
    assert set("".join(upper)) == set(string.ascii_uppercase + string.digits)
    digits = values(spark, 300, "STRING", length=3, digits_only=True)
    assert all(len(v) == 3 and v[0] != "0" for v in digits)
    assert set(values(spark, 300, "STRING", length=1, digits_only=True)) == set(string.digits)
    long = values(spark, 50, "STRING", length=30, digits_only=True)
    assert all(len(v) == 30 and v.isdigit() and v[0] != "0" for v in long)
    fixed = values(spark, 50, "STRING", regular_expr="^[a-z0-9]{5}$", length=9, case_mode="upper")
    assert all(len(v) == 5 and v == v.lower() for v in fixed)


def test_same_values_for_any_partitioning_and_seed(spark):
    spec = specs(
        table("t", 500, col("a", "INT", unique=True, null_ratio=0.1), col("s", "STRING"), col("d", "DATE", null_ratio=0.3))
    )[0]
    ids = spark.range(500).withColumnRenamed("id", "row_id")
    frames = [generate_table(spark, spec, 5, ids.repartition(n, "row_id")) for n in (1, 7)]
    first, second = (sorted(map(str, f.collect())) for f in frames)
    assert first == second == sorted(map(str, generate_table(spark, spec, 5).collect()))
    assert first != sorted(map(str, generate_table(spark, spec, 6).collect()))


def test_generation_moves_no_data(spark):
    frames = build(
        spark,
        table("p", 100, col("k", "INT", unique=True), col("g", "INT", null_ratio=0.2)),
        table("c", 100, ref("k", "p", "k", "ONE_TO_ONE"), ref("g", "p", "g", null_ratio=0.5)),
    )
    plan = frames["c"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_filter_on_a_permuted_column_stays_small(spark):
    frame = build(spark, table("t", 1000, col("k", "INT", unique=True, min_value=0, max_value=999)))["t"]
    found = frame.where("k % 10 = 3")
    assert found.count() == 100
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_derived_columns_follow_the_source(spark):
    frame = build(
        spark,
        table(
            "t",
            200,
            col("d", "DATE", "STRING", date_format="%d/%m/%Y", null_ratio=0.25),
            {"name": "ymd", "output_data_type": "INT", "derive": {"source_column": "D", "rule": "YYYYMMDD"}},
            {"name": "mm", "output_data_type": "STRING", "derive": {"source_column": "d", "rule": "MM"}},
            {"name": "mi", "output_data_type": "INT", "derive": {"source_column": "d", "rule": "MM"}},
        ),
    )["t"]
    rows = frame.collect()
    assert sum(r.d is None for r in rows) == 50
    for r in rows:
        if r.d is None:
            assert r.ymd is None and r.mm is None and r.mi is None
        else:
            day, month, year = r.d.split("/")
            assert r.ymd == int(year + month + day) and r.mm == month and r.mi == int(month)


def test_references(spark):
    frames = build(
        spark,
        table("p", 300, col("u", "INT", digits_count=8, unique=True), col("w", "INT", min_value=1, max_value=60, null_ratio=0.4)),
        table(
            "c",
            200,
            ref("many", "p", "U", null_ratio=0.1),
            ref("one", "p", "u", "ONE_TO_ONE", null_ratio=0.05),
            ref("weighted", "p", "w"),
            ref("few", "p", "w", "ONE_TO_ONE", null_ratio=0.8),
        ),
        table("g", 40, ref("again", "c", "few", null_ratio=0.5), ref("once", "c", "few", "ONE_TO_ONE"), ref("chain", "c", "one", "ONE_TO_ONE")),
    )
    parent, child, grand = (frames[n].toPandas() for n in ("p", "c", "g"))
    assert child.many.isna().sum() == 20 and set(child.many.dropna()) <= set(parent.u)
    assert child.one.dropna().is_unique and len(child.one.dropna()) == 190 and set(child.one.dropna()) <= set(parent.u)
    assert set(child.weighted) <= set(parent.w.dropna())
    assert child.few.isna().sum() == 160 and child.few.dropna().is_unique and set(child.few.dropna()) <= set(parent.w.dropna())
    assert grand.again.isna().sum() == 20 and set(grand.again.dropna()) <= set(child.few.dropna())
    assert sorted(grand.once) == sorted(child.few.dropna())
    assert grand.chain.is_unique and set(grand.chain) <= set(child.one.dropna())
    for name in ("many", "one"):
        assert orphan_values(frames["c"], name, frames["p"], "u").isEmpty()


def test_references_keep_the_weight_of_duplicates(spark):
    frames = build(
        spark,
        table("p", 1000, col("v", "INT", allowed_values=[1, 1, 1, 2], null_ratio=0.3)),
        table("c", 8000, ref("v", "p", "v")),
    )
    share = frames["p"].where("v = 1").count() / frames["p"].where("v is not null").count()
    got = frames["c"].where("v = 1").count() / 8000
    assert abs(share - got) < 0.03


def test_one_to_one_needs_enough_distinct_values(spark):
    with pytest.raises(UnsatisfiableError):
        build(spark, table("p", 50, col("v", "INT", allowed_values=[1, 2])), table("c", 3, ref("v", "p", "v", "ONE_TO_ONE")))
    with pytest.raises(UnsatisfiableError):
        build(spark, table("p", 5, col("v", "INT")), table("c", 6, ref("v", "p", "v", "ONE_TO_ONE")))


def test_parent_without_values(spark):
    tables = (table("p", 5, col("v", "INT", null_ratio=1.0)), table("c", 4, ref("v", "p", "v")))
    with pytest.raises(UnsatisfiableError):
        build(spark, *tables)
    frames = build(spark, tables[0], table("c", 4, ref("v", "p", "v", null_ratio=1)))
    assert [r.v for r in frames["c"].collect()] == [None] * 4


def test_order_and_cycles():
    ordered = dependency_order(specs(table("b", 1, ref("x", "a", "y")), table("a", 1, col("y", "INT"))))
    assert [t.name for t in ordered] == ["a", "b"]
    with pytest.raises(SpecError, match="cycle"):
        dependency_order(
            specs(
                table("a", 1, col("y", "INT"), ref("z", "b", "w")),
                table("b", 1, col("w", "INT"), ref("x", "a", "y")),
            )
        )
    with pytest.raises(SpecError, match="cycle"):
        dependency_order(specs(table("a", 1, col("y", "INT"), ref("z", "a", "y"))))


def test_unique_values_merged_by_the_output_format(spark):
    with pytest.raises(UnsatisfiableError):
        values(spark, 50, "DATE", "STRING", unique=True, date_format="%Y")
    with pytest.raises(UnsatisfiableError):
        values(spark, 2, "STRING", "INT", unique=True, allowed_values=["7", "07"])
    assert len(set(values(spark, 50, "DATE", "INT", unique=True, date_format="%Y%m%d"))) == 50


def test_supplied_rows_keep_their_columns(spark):
    spec = specs(table("t", 10, col("v", "INT")))[0]
    rows = spark.range(10).select(F.col("id").alias("row_id"), (F.col("id") * 2).alias("twice"))
    frame = generate_table(spark, spec, 1, rows)
    assert frame.columns == ["twice", "v"] and frame.count() == 10


def test_timestamps_need_utc(spark):
    spec = specs(table("t", 10, col("v", "TIMESTAMP")))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Moscow")
    try:
        with pytest.raises(SpecError, match="UTC"):
            generate_tables(spark, spec)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_text_fails_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            values(spark, 5, "STRING", "INT", allowed_values=["4x"])
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_hand_made_specs_are_checked(spark):
    link = lambda parent, name, output: ReferenceColumn("r", output, parent, name, Cardinality.ONE_TO_MANY)
    parent = specs(table("p", 5, col("v", "INT")))[0]
    for broken in (link("q", "v", T.INT), link("p", "w", T.INT), link("p", "v", T.STRING)):
        with pytest.raises(SpecError, match="c.r needs"):
            generate_tables(spark, [parent, Table("c", 5, (broken,))])
    with pytest.raises(SpecError, match="repeats"):
        Table("t", 5, parent.columns * 2)


def test_schema(spark):
    spec = specs(table("t", 5, col("a", "INT"), col("b", "DATE", "STRING", null_ratio=0.5)))[0]
    assert spec.schema.simpleString() == "struct<a:bigint,b:string>"
    assert [field.nullable for field in spec.schema] == [False, True]
    assert generate_table(spark, spec).dtypes == [("a", "bigint"), ("b", "string")]


@pytest.mark.parametrize("ids", [[0, 2, 4], [0, 1, 1], [1, 2, 3], [0, 1]])
def test_supplied_rows_must_be_numbered_densely(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "row_id long")
    with pytest.raises(SpecError, match="0..2"):
        generate_table(spark, specs(table("t", 3, col("v", "INT")))[0], 1, rows)


def test_generation_leaves_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    values(spark, 5, "INT")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def test_a_class_repeated_no_times_is_empty(spark):
    assert values(spark, 3, "STRING", regular_expr="^[A-Z]{0}$") == ["", "", ""]


def test_unique_integers_reach_the_whole_64_bit_range(spark):
    low, high = -(2**63), 2**63 - 1
    found = values(spark, 2000, "INT", unique=True, min_value=low, max_value=high)
    assert len(set(found)) == 2000 and min(found) < low * 0.99 and max(found) > high * 0.99
    upper = values(spark, 1000, "INT", unique=True, min_value=0, max_value=high)
    assert len(set(upper)) == 1000 and sum(v > high // 2 for v in upper) in range(450, 550)


@pytest.mark.parametrize("most", [1, 7, 250])
def test_open_repeats_stop_where_the_column_says(spark, most):
    lengths = {len(v) - 1 for v in values(spark, 400, "STRING", regular_expr="^x[ab]+$", max_repeat=most)}
    assert min(lengths) == 1 and max(lengths) > 0.9 * most and max(lengths) <= most


def test_all_faulty_references_are_named():
    child = Table("c", 1, (ReferenceColumn("u", T.INT, "p", "k", Cardinality.ONE_TO_MANY), ReferenceColumn("v", T.INT, "q", "k", Cardinality.ONE_TO_MANY)))
    parent = specs(table("p", 1, col("k", "STRING")))[0]
    with pytest.raises(SpecError, match=r"c\.u needs INT at p\.k, which is STRING; c\.v needs INT at q\.k, which is missing"):
        dependency_order([child, parent])
