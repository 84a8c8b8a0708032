"""Reconcile two results as bags of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from twinloom.errors import CompareError

# Columns a loader adds on its own, never compared.
TECHNICAL_COLUMNS = {
    "hive": ("date_part", "month_part", "year_part", "load_part"),
    "iceberg": ("sys_insert_stamp", "sys_update_stamp", "src_modified_stamp", "job_insert_id"),
}

_INTEGERS = (st.ByteType, st.ShortType, st.IntegerType, st.LongType)
_FRACTIONS = (st.FloatType, st.DoubleType, st.DecimalType)
_TEMPORAL = (st.DateType, st.TimestampType, st.TimestampNTZType)
_NESTED = (st.ArrayType, st.MapType, st.StructType)


@dataclass(frozen=True)
class ComparisonColumns:
    compared: tuple[str, ...]
    left_excluded: tuple[str, ...]
    right_excluded: tuple[str, ...]
    temporal_excluded: tuple[str, ...]


def comparison_columns(
    left: st.StructType,
    right: st.StructType,
    left_excludes: Iterable[str] = TECHNICAL_COLUMNS["hive"],
    right_excludes: Iterable[str] = TECHNICAL_COLUMNS["iceberg"],
    compare_temporal: bool = False,
) -> ComparisonColumns:
    """Decide from the schemas alone what is compared. Excludes ignore case, names do not."""
    sides = []
    for side, schema, excludes in (("left", left, left_excludes), ("right", right, right_excludes)):
        dropped = {name.lower() for name in excludes}
        kept = [name for name in schema.fieldNames() if name.lower() not in dropped]
        repeated = sorted({name for name in kept if kept.count(name) > 1})
        if repeated:
            raise CompareError("COMPARISON_DUPLICATE_COLUMNS", f"The {side} result repeats columns {repeated}")
        sides.append((set(kept), tuple(n for n in schema.fieldNames() if n.lower() in dropped)))
    (left_kept, left_out), (right_kept, right_out) = sides
    if left_kept != right_kept:
        raise CompareError(
            "COMPARISON_COLUMN_NAMES_MISMATCH",
            f"Missing on the left: {sorted(right_kept - left_kept)}, "
            f"missing on the right: {sorted(left_kept - right_kept)}",
        )
    temporal = set()
    if not compare_temporal:
        temporal = {n for n in left_kept for s in (left, right) if isinstance(s[n].dataType, _TEMPORAL)}
    return ComparisonColumns(
        tuple(sorted(left_kept - temporal)), left_out, right_out, tuple(sorted(temporal))
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _exact(data_type: str) -> Callable[[Column], Column]:
    return lambda column: column.cast(data_type)


#: What a value of a type is compared as; types not listed are compared as they are.
_COMPARED_AS: dict[type[st.DataType], Callable[[Column], Column]] = {
    **dict.fromkeys(_INTEGERS, _exact("bigint")),
    **dict.fromkeys(_FRACTIONS, _exact("decimal(38,18)")),
    st.BooleanType: lambda column: F.lower(column.cast("string")),
}


def normalized(field: st.StructField) -> Column:
    """The column in the type both engines are compared in."""
    kind = type(field.dataType)
    if kind in _NESTED:
        raise CompareError("COMPARISON_UNSUPPORTED_TYPE", f"{field.name}: values of type {field.dataType.simpleString()} are not compared")
    return _COMPARED_AS.get(kind, lambda column: column)(F.col(_quoted(field.name))).alias(field.name)


def normalize(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.select(*(normalized(frame.schema[name]) for name in columns))


def check_same_types(left: DataFrame, right: DataFrame) -> None:
    types = {name: (kind, dict(right.dtypes).get(name)) for name, kind in left.dtypes}
    different = {name: pair for name, pair in types.items() if pair[0] != pair[1]}
    if different:
        raise CompareError("COMPARISON_SCHEMA_MISMATCH", f"Types differ after normalisation: {different}")


def row_balance(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per distinct row, how often it occurs on each side (``left_rows``, ``right_rows``).

    One union and one aggregation replace two EXCEPT ALL passes. Equal rows are combined
    before the shuffle, so a row that fills a third of a side still moves once per task.
    """
    columns = list(map(_quoted, left.columns))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = left.select("*", one.alias("left_rows"), none.alias("right_rows")).unionByName(
        right.select(*columns, none.alias("left_rows"), one.alias("right_rows"))
    )
    return tagged.groupBy(*columns).agg(
        F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")
    )


def normalized_balance(left: DataFrame, right: DataFrame) -> DataFrame:
    """The row balance in the normalised types; rows balanced as they are may be merged.

    Where both sides have the same type, rows that balance as they are also balance after
    normalisation, so only the rest is converted and combined again: usually a small
    remainder. Unbalanced rows can still meet there, since normalisation may map
    different values to one. ``even`` marks what balanced before.
    """
    columns = left.columns
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)

    def keys(frame: DataFrame) -> list[Column]:
        same = {name for name in columns if left_types[name] == right_types[name]}
        return [F.col(_quoted(n)) if n in same else normalized(frame.schema[n]) for n in columns]

    plain_left, plain_right = left.select(*keys(left)), right.select(*keys(right))
    even = F.col("left_rows") == F.col("right_rows")
    converted = [F.when(~even, normalized(field)).alias(field.name) for field in plain_left.schema]
    balance = row_balance(plain_left, plain_right).select(
        *converted, even.alias("__even"), "left_rows", "right_rows"
    )
    if any(_merges_values(field.dataType) for field in plain_left.schema):
        balance = balance.groupBy(*map(_quoted, columns), "__even").agg(
            F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")
        )
    return balance


def _merges_values(data_type: st.DataType) -> bool:
    """Whether normalisation may map two different values of the type to one."""
    if isinstance(data_type, st.DecimalType):
        return data_type.scale > 18 or data_type.precision - data_type.scale > 20
    return isinstance(data_type, (st.FloatType, st.DoubleType))


def unbalanced_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct normalised row that one side has more often, with both counts."""
    uneven = ~F.col("__even") & (F.col("left_rows") != F.col("right_rows"))
    return normalized_balance(left, right).where(uneven).drop("__even")


def exclusive_rows(left: DataFrame, right: DataFrame, copies_per_task: int = 100_000) -> DataFrame:
    """The normalised rows of ``left`` that ``right`` does not match, as often as they are unmatched.

    The result of EXCEPT ALL, which writes all copies of a row from one task. Here a row
    with very many unmatched copies is first split into parts that are spread over tasks.
    """
    columns = list(map(_quoted, left.columns))
    surplus = F.col("left_rows") - F.col("right_rows")
    unmatched = unbalanced_rows(left, right).select(*columns, surplus.alias("__copies"))
    copies, limit, one = F.col("__copies"), F.lit(copies_per_task).cast("bigint"), F.lit(1).cast("bigint")
    few = unmatched.where((copies > 0) & (copies <= limit))
    parts = F.explode(F.sequence(one, F.ceil(copies / limit))).alias("__part")
    many = unmatched.where(copies > limit).select(*columns, "__copies", parts).repartition("__part", *columns)
    many = many.select(*columns, F.least(limit, copies - (F.col("__part") - 1) * limit).alias("__copies"))
    repeated = few.unionByName(many).select(*columns, F.explode(F.sequence(one, copies)).alias("__copy"))
    return repeated.select(*columns)


def difference_metrics(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: counts per side and rows exclusive to each side, in a single job."""
    surplus = F.col("left_rows") - F.col("right_rows")
    zero = F.lit(0).cast("bigint")

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), zero)

    return normalized_balance(left, right).agg(
        total(F.col("left_rows")).alias("left_count"),
        total(F.col("right_rows")).alias("right_count"),
        total(F.greatest(surplus, zero)).alias("left_exclusive"),
        total(F.greatest(-surplus, zero)).alias("right_exclusive"),
    )


def with_verdict(metrics: DataFrame) -> DataFrame:
    """Add the count delta, the exclusive ratios and the status."""

    def ratio(part: str, whole: str) -> Column:
        share = F.col(part) / F.nullif(F.col(whole), F.lit(0).cast("bigint"))
        return F.coalesce(F.round(share, 6), F.lit(0.0))

    same = (F.col("left_exclusive") == 0) & (F.col("right_exclusive") == 0)
    return metrics.select(
        "*",
        F.abs(F.col("left_count") - F.col("right_count")).alias("count_delta"),
        ratio("left_exclusive", "left_count").alias("left_ratio"),
        ratio("right_exclusive", "right_count").alias("right_ratio"),
        F.when(same, "MATCH").otherwise("MISMATCH").alias("status"),
    )


def compare(
    left: DataFrame,
    right: DataFrame,
    left_excludes: Iterable[str] = (),
    right_excludes: Iterable[str] = (),
    technical: dict[str, Sequence[str]] = TECHNICAL_COLUMNS,
    compare_temporal: bool = False,
) -> tuple[ComparisonColumns, DataFrame]:
    """What is compared, and the one-row verdict (lazy)."""
    columns = comparison_columns(
        left.schema,
        right.schema,
        (*technical["hive"], *left_excludes),
        (*technical["iceberg"], *right_excludes),
        compare_temporal,
    )
    check_same_types(normalize(left, columns.compared), normalize(right, columns.compared))
    kept = list(map(_quoted, columns.compared))
    return columns, with_verdict(difference_metrics(left.select(*kept), right.select(*kept)))


def report_frame(
    columns: ComparisonColumns,
    verdict: DataFrame,
    run_id: str,
    checked_at: str,
    left_uri: str,
    right_uri: str,
) -> DataFrame:
    """The verdict as the nested one-row report."""

    def pair(left: str | Column, right: str | Column) -> Column:
        return F.struct(
            (F.col(left) if isinstance(left, str) else left).alias("hive"),
            (F.col(right) if isinstance(right, str) else right).alias("iceberg"),
        )

    def names(values: Sequence[str]) -> Column:
        return F.array(*map(F.lit, values)).cast("array<string>")

    return verdict.select(
        F.lit(run_id).alias("run_id"),
        F.lit(checked_at).alias("checked_at"),
        "status",
        F.struct(
            pair("left_count", "right_count").alias("row_count"),
            F.col("count_delta").alias("row_count_delta"),
            pair("left_exclusive", "right_exclusive").alias("exclusive_row_count"),
            pair("left_ratio", "right_ratio").alias("exclusive_row_ratio"),
        ).alias("summary"),
        F.struct(
            F.lit(left_uri).alias("hive_result_uri"), F.lit(right_uri).alias("iceberg_result_uri")
        ).alias("artifacts"),
        F.struct(
            names(columns.left_excluded).alias("hive"),
            names(columns.right_excluded).alias("iceberg"),
            names(columns.temporal_excluded).alias("temporal"),
        ).alias("excluded_columns"),
        # With no comparable column only the row counts are compared; the empty list shows it.
        names(columns.compared).alias("compared_columns"),
    )
