from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entry_queries.duck import SEED
from twinloom.operators.generate import generate_tables
from twinloom.plans.spec import read_tables
from twinloom.session import compile_small_methods

AS_OF = date(2025, 6, 30)
KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def synthetic(
    spark: SparkSession, sf_dir: str, lists: dict[str, DataFrame] | None = None, **tables: tuple[str, list[dict]]
) -> dict[str, DataFrame]:
    """Tables generated over the rows of given ones: ``name=(given table, columns)``.

    The given table's dense key is the row id; its row count is the table size. ``lists`` are lists of values.
    """
    use_utc(spark)
    compile_small_methods(spark)
    raw, rows = [], {}
    for name, (given, columns) in tables.items():
        key = KEYS[given]
        rows[name] = read(spark, sf_dir, given).select(F.col(key).alias("row_id"), key)
        raw.append({"table_name": name, "total_rows": rows[name].count(), "columns": columns})
    frames = generate_tables(spark, read_tables(raw, AS_OF), SEED, rows, lists=lists)
    return {name: local_times(frame) for name, frame in frames.items()}


def local_times(frame: DataFrame) -> DataFrame:
    """UTC timestamps as zone-less ones, which is what the SQL side has."""
    return frame.select(
        *(F.col(n).cast("timestamp_ntz").alias(n) if kind == "timestamp" else F.col(n) for n, kind in frame.dtypes)
    )


def column(name: str, kind: str, output: str | None = None, **constraints) -> dict:
    spec = {"name": name, "generator_data_type": kind, "constraints": constraints}
    return spec | ({"output_data_type": output} if output else {})


def reference(name: str, table: str, parent: str, cardinality: str = "ONE_TO_MANY", **constraints) -> dict:
    link = {"table_name": table, "column_name": parent, "cardinality": cardinality}
    return {"name": name, "reference": link, "constraints": constraints}


def derived(name: str, source: str, rule: str, output: str) -> dict:
    return {"name": name, "output_data_type": output, "derive": {"source_column": source, "rule": rule}}
