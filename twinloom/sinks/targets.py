"""Load aligned rows into existing tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinloom.errors import LoadError
from twinloom.operators.align import align_to_schema, quoted, select_load_columns, strict_casts
from twinloom.plans.types import WriteMode
from twinloom.session import session_conf, shared_folder
from twinloom.sources.tables import (
    is_partitioned,
    partition_columns,
    read_staged,
    require_table,
    table_provider,
    target_schema,
    uses_v2_writer,
)


@dataclass(frozen=True)
class TableLoad:
    source_uri: str
    target: str
    mode: str
    columns: tuple[str, ...]


def write_target(rows: DataFrame, target: str, mode: str | WriteMode) -> None:
    """Write rows that already have the target's schema, in one of the three modes."""
    spark = rows.sparkSession
    try:
        mode = WriteMode(mode)
    except ValueError as error:
        raise LoadError("UNSUPPORTED_WRITE_MODE", f"Unsupported write mode {mode} for {target}") from error
    if mode is WriteMode.OVERWRITE_PARTITIONS and not is_partitioned(spark, target):
        raise LoadError("PARTITIONED_TARGET_REQUIRED", f"{mode.value} needs a partitioned target: {target}")
    provider = table_provider(spark, target)
    if uses_v2_writer(provider):
        _write_v2(rows, target, mode)
    else:
        _write_v1(rows, target, mode, provider)


def _write_v2(rows: DataFrame, target: str, mode: WriteMode) -> None:
    """Catalog tables such as Iceberg; each mode is one atomic commit there."""
    writer = rows.writeTo(target)
    if mode is WriteMode.APPEND:
        writer.append()
    elif mode is WriteMode.OVERWRITE_TABLE:
        writer.overwrite(F.lit(True))
    else:
        writer.overwritePartitions()


def _write_v1(rows: DataFrame, target: str, mode: WriteMode, provider: str) -> None:
    spark = rows.sparkSession
    keys = partition_columns(spark, target)
    if keys:
        # Bring the rows of a partition together so each task does not open every partition;
        # unlike repartition, rebalance also splits a partition that holds most of the rows.
        # Like the insert, this goes by position: the partition columns come last.
        rows = rows.hint("rebalance", *map(quoted, rows.columns[-len(keys):]))
    overwrite = mode is not WriteMode.APPEND
    if mode is WriteMode.OVERWRITE_TABLE and keys and provider == "hive":
        # A static overwrite of a Hive-format table keeps partitions the input lacks.
        # Emptying it first gives the right content. All casts run before that, into a shared
        # folder, so that a bad value or a source that reads the target cannot lose the table;
        # emptying and inserting are still two steps.
        rows = _computed(rows)
        spark.sql(f"TRUNCATE TABLE {target}")
        overwrite = False
    dynamic = mode is WriteMode.OVERWRITE_PARTITIONS
    settings = {"spark.sql.sources.partitionOverwriteMode": "dynamic" if dynamic else "static"}
    if provider == "hive":
        settings["hive.exec.dynamic.partition.mode"] = "nonstrict"
    with session_conf(spark, settings):
        rows.write.insertInto(target, overwrite=overwrite)


def _computed(rows: DataFrame) -> DataFrame:
    folder = shared_folder(rows.sparkSession, "aligned")
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def load_table(spark: SparkSession, load: TableLoad) -> None:
    """Check the target, read, select, align under strict casts, write."""
    require_table(spark, load.target)
    source = select_load_columns(read_staged(spark, load.source_uri), load.columns)
    schema = target_schema(spark, load.target)
    with strict_casts(spark):
        write_target(align_to_schema(source, schema), load.target, load.mode)


def load_tables(spark: SparkSession, loads: Iterable[TableLoad]) -> None:
    """One table after another; a failure leaves earlier tables loaded."""
    for load in loads:
        load_table(spark, load)
