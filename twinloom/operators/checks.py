"""Checks over generated or existing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_values(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Every non-null key that occurs more than once, with its number of rows.

    Counts are combined before the shuffle, so one frequent key stays cheap.
    """
    present = frame.select(*columns).dropna(subset=columns)
    return present.groupBy(*columns).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def has_duplicates(frame: DataFrame, columns: list[str]) -> bool:
    return not duplicate_values(frame, columns).isEmpty()


def repeating_columns(frame: DataFrame, columns: list[str]) -> list[str]:
    """Those of the columns in which a non-null value occurs more than once, from one pass over the rows.

    All columns are folded into counts of (column, 128-bit hash). Only if a hash is met twice are
    the values behind such hashes compared themselves.
    """
    if not columns:
        return []
    cells = [
        F.when(
            F.col(name).isNotNull(),
            F.struct(F.lit(place).alias("place"), F.xxhash64(name).alias("a"), F.xxhash64(F.lit(place + 1), name).alias("b")),
        )
        for place, name in enumerate(columns)
    ]
    hashes = frame.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).groupBy("cell").count()
    met = hashes.where("count > 1").select("cell.*")
    suspects = sorted(row.place for row in met.select("place").distinct().collect())
    found = []
    for place in suspects:
        name = columns[place]
        twice = met.where(F.col("place") == place).select("a")
        values = frame.select(F.col(name).alias("value")).where("value IS NOT NULL").withColumn("a", F.xxhash64("value"))
        if has_duplicates(values.join(twice, "a", "left_semi"), ["value"]):
            found.append(name)
    return found


def orphan_values(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Non-null child keys without a parent, with their number of rows.

    Both sides are reduced to distinct keys first: a key that fills a third of the child
    joins as one row.
    """
    keys = (
        child.where(F.col(child_column).isNotNull())
        .groupBy(F.col(child_column).alias("orphan"))
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).alias("orphan")).distinct()
    return keys.join(known, "orphan", "left_anti")


def null_counts(frame: DataFrame) -> DataFrame:
    """The number of rows and, per column, of NULLs, in one pass."""
    return frame.agg(
        F.count("*").alias("n_rows"),
        *(F.count_if(F.col(name).isNull()).alias(name) for name in frame.columns),
    )
