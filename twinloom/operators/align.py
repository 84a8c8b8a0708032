"""Fit a staged table to the schema of an existing target."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as st

from twinloom.errors import LoadError
from twinloom.session import session_conf

# What a missing NOT NULL target column is filled with, by type.
TECHNICAL_FILLERS = {
    st.ByteType: 1,
    st.ShortType: 1,
    st.IntegerType: 1,
    st.LongType: 1,
    st.FloatType: 0.1,
    st.DoubleType: 0.1,
    st.DecimalType: "0.1",
    st.StringType: "N/A",
    st.BooleanType: False,
    st.DateType: "2040-01-01",
    st.TimestampType: "2040-01-01 23:59:59",
    st.TimestampNTZType: "2040-01-01 23:59:59",
}


def strict_casts(spark: SparkSession):
    """Casts analysed inside this block fail on bad values instead of giving NULL."""
    return session_conf(
        spark, {"spark.sql.ansi.enabled": "true", "spark.sql.storeAssignmentPolicy": "ANSI"}
    )


@dataclass(frozen=True)
class ColumnMatch:
    """How requested names meet given ones when case is ignored; decided from names alone."""

    found: dict[str, str]  # requested name -> given name
    missing: tuple[str, ...]
    unused: tuple[str, ...]


def match_columns(given: Sequence[str], requested: Sequence[str]) -> ColumnMatch:
    for names in (given, requested):
        times = Counter(map(str.lower, names))
        clashing = [name for name in names if times[name.lower()] > 1]
        if clashing:
            raise LoadError("LOAD_COLUMNS_AMBIGUOUS_BY_CASE", f"Equal up to case: {', '.join(clashing)}")
    spelled = {name.lower(): name for name in given}
    found = {name: spelled[name.lower()] for name in requested if name.lower() in spelled}
    used = set(found.values())
    return ColumnMatch(
        found,
        tuple(name for name in requested if name not in found),
        tuple(name for name in given if name not in used),
    )


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def select_load_columns(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The requested columns, in the requested order and spelling; case is ignored."""
    match = match_columns(source.columns, columns)
    if match.missing:
        raise LoadError("LOAD_COLUMNS_MISSING_IN_PARQUET", f"The staged table has no {list(match.missing)}")
    return source.select(*(quoted(match.found[name]).alias(name) for name in columns))


def align_to_schema(source: DataFrame, target: st.StructType) -> DataFrame:
    """Cast to the target's types, names and order in one select; fill what is missing."""
    match = match_columns(source.columns, target.fieldNames())
    if match.unused:
        raise LoadError("LOAD_COLUMNS_ABSENT_IN_TARGET", f"The target has no {sorted(match.unused)}")
    cells = {name: quoted(given) for name, given in match.found.items()}
    cells |= {name: _filler(target[name]) for name in match.missing}
    return source.select(*(cells[f.name].cast(f.dataType).alias(f.name) for f in target.fields))


def _filler(field: st.StructField) -> Column:
    """NULL, or for a column that forbids it the fixed value of its type."""
    value = None if field.nullable else TECHNICAL_FILLERS.get(type(field.dataType))
    if value is None and not field.nullable:
        raise LoadError(
            "LOAD_NON_NULLABLE_TARGET_COLUMN_MISSING",
            f"Nothing to put into {field.name}: {field.dataType.simpleString()} NOT NULL",
        )
    return F.lit(value)
