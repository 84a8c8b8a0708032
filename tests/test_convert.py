import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import build, col, table
from twinloom.errors import SpecError
from twinloom.functions.convert import OUTPUT_TYPES, convert, float_text
from twinloom.functions.formats import spark_pattern
from twinloom.plans.types import LogicalType as T


def test_float_text_prints_like_python(spark):
    rng = random.Random(3)
    numbers = [0.0, -0.0, 1.0, 0.1, 1e7, 1e16, 9999999999999998.0, 123456789012345.6, 1e-4, 1e-5, 2e-3, 2e23, 1.5e300, 9.5e-5]
    numbers += [round(rng.uniform(-10**e, 10**e), p) for e in range(-3, 18) for p in (0, 1, 2, 4) for _ in range(40)]
    numbers += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(500)]
    frame = spark.createDataFrame([(n,) for n in numbers], "x double")
    wrong = [(r.x, r.t) for r in frame.select("x", float_text(F.col("x")).alias("t")).collect() if repr(r.x) != r.t]
    assert not wrong


@pytest.mark.parametrize("fmt", ["%Y-%m-%d", "%d.%m.%y", "%j %b %B %a %A", "it's %Y%%", "%H:%M:%S.%f %I %p", "T%Y[x]{y}#'"])
def test_formats_print_like_python(spark, fmt):
    moments = [datetime(2024, 2, 29, 0, 0, 0) + timedelta(hours=7 * n, seconds=n) for n in range(60)]
    frame = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz").select(F.col("t").cast("timestamp").alias("t"))
    texts = [r.t for r in frame.select(F.date_format("t", spark_pattern(fmt)).alias("t")).collect()]
    assert texts == [m.strftime(fmt) for m in moments]


def test_conversion_matrix(spark):
    for source in T:
        for target in T:
            if target not in OUTPUT_TYPES[source]:
                with pytest.raises(SpecError):
                    convert(F.lit(1), source, target)


def test_simple_conversions(spark):
    row = spark.range(1).select(
        convert(F.lit(-2.9), T.FLOAT, T.INT).alias("cut"),
        convert(F.lit(True), T.BOOLEAN, T.STRING).alias("yes"),
        convert(F.lit(False), T.BOOLEAN, T.INT).alias("zero"),
        convert(F.lit(-3), T.INT, T.BOOLEAN).alias("nonzero"),
        convert(F.lit(" 0042 "), T.STRING, T.INT).alias("number"),
        convert(F.lit(date(2024, 5, 6)), T.DATE, T.TIMESTAMP).alias("midnight"),
        convert(F.lit(7).cast("bigint"), T.INT, T.FLOAT).alias("real"),
    ).first()
    assert row.asDict() == {
        "cut": -2, "yes": "True", "zero": 0, "nonzero": True, "number": 42, "midnight": datetime(2024, 5, 6), "real": 7.0,
    }


def test_bad_text_fails_fast(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("4x",)], "s string").select(convert(F.col("s"), T.STRING, T.INT)).collect()


def test_every_legal_conversion_generates(spark):
    columns = []
    for source, targets in OUTPUT_TYPES.items():
        for target in targets:
            limits = {"null_ratio": 0.2}
            if source is T.STRING and target is T.INT:
                limits |= {"digits_only": True, "length": 4}
            if target is T.INT and source in (T.DATE, T.TIMESTAMP):
                limits |= {"date_format" if source is T.DATE else "timestamp_format": "%Y%m%d"}
            columns.append(col(f"{source.value}_{target.value}", source.value, target.value, **limits))
    frame = build(spark, table("t", 50, *columns))["t"]
    expected = {T.STRING: "string", T.INT: "bigint", T.FLOAT: "double", T.BOOLEAN: "boolean", T.DATE: "date", T.TIMESTAMP: "timestamp"}
    assert [kind for _, kind in frame.dtypes] == [expected[t] for targets in OUTPUT_TYPES.values() for t in targets]
    assert all(sum(row[i] is None for row in frame.collect()) == 10 for i in range(len(columns)))
