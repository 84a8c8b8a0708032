from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as st

from twinloom.errors import LoadError

# The headings that announce partitioning.
_PARTITION_MARKS = {"# Partitioning", "# Partition Information"}
_V1_PROVIDERS = {"hive", "parquet", "orc", "csv", "json", "text", "avro"}


def read_staged(spark: SparkSession, uri: str) -> DataFrame:
    """A staged table; columns and filters reach the Parquet scan."""
    return spark.read.parquet(uri)


def require_table(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        raise LoadError("TARGET_TABLE_NOT_FOUND", f"Target table does not exist: {table}")


def target_schema(spark: SparkSession, table: str) -> st.StructType:
    require_table(spark, table)
    return spark.table(table).schema


def _described(spark: SparkSession, table: str) -> dict[str, list[tuple[str, str]]]:
    """DESCRIBE EXTENDED by section: columns under "", then what follows each heading.

    A heading begins with a number sign and has no type, which tells it from a column so named.
    """
    sections: dict[str, list[tuple[str, str]]] = {"": []}
    rows = sections[""]
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row.col_name.startswith("# ") and not row.data_type:
            rows = sections.setdefault(row.col_name, [])
        else:
            rows.append((row.col_name, row.data_type))
    return sections


def is_partitioned(spark: SparkSession, table: str) -> bool:
    return not _PARTITION_MARKS.isdisjoint(_described(spark, table))


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def table_provider(spark: SparkSession, table: str) -> str:
    """The table's format; a column of the name Provider is no answer."""
    details = [row for name, rows in _described(spark, table).items() if name.startswith("# Detailed") for row in rows]
    return next((value.lower() for name, value in details if name == "Provider"), "")


def uses_v2_writer(provider: str) -> bool:
    return provider not in _V1_PROVIDERS
