from __future__ import annotations

from enum import Enum

from pyspark.sql import types as st


class LogicalType(Enum):
    STRING = "STRING"
    INT = "INT"
    FLOAT = "FLOAT"
    BOOLEAN = "BOOLEAN"
    DATE = "DATE"
    TIMESTAMP = "TIMESTAMP"

    @property
    def spark_type(self) -> st.DataType:
        return _SPARK_TYPES[self]


_SPARK_TYPES = {
    LogicalType.STRING: st.StringType(),
    LogicalType.INT: st.LongType(),
    LogicalType.FLOAT: st.DoubleType(),
    LogicalType.BOOLEAN: st.BooleanType(),
    LogicalType.DATE: st.DateType(),
    LogicalType.TIMESTAMP: st.TimestampType(),
}


class Cardinality(Enum):
    ONE_TO_ONE = "ONE_TO_ONE"
    ONE_TO_MANY = "ONE_TO_MANY"


class WriteMode(Enum):
    APPEND = "APPEND"
    OVERWRITE_TABLE = "OVERWRITE_TABLE"
    OVERWRITE_PARTITIONS = "OVERWRITE_PARTITIONS"


class EngineScope(Enum):
    ALL = "ALL"
    HIVE_ONLY = "HIVE_ONLY"
    ICEBERG_ONLY = "ICEBERG_ONLY"
