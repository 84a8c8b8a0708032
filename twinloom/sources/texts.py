from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinloom.operators.audit import parse_diagnostics, parse_reports

_RUN_IN_PATH = r"/runs/([^/]+)/"


def read_text(spark: SparkSession, uri: str) -> str:
    """One small text object, such as a query."""
    return spark.read.text(uri, wholetext=True).first()[0]


def query_from_text(spark: SparkSession, uri: str) -> DataFrame:
    """The user's own SQL, stored as text, run by Spark."""
    return spark.sql(read_text(spark, uri))


def _payloads(spark: SparkSession, uri: str) -> DataFrame:
    lines = spark.read.text(uri).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("path"))
    return lines.select("payload", F.regexp_extract("path", _RUN_IN_PATH, 1).alias("expected_run"))


def read_reports(spark: SparkSession, uri: str) -> DataFrame:
    """All reports under a path or glob, one JSON object per line, each checked against its run folder."""
    return parse_reports(_payloads(spark, uri), expected_run="expected_run")


def read_diagnostics(spark: SparkSession, uri: str) -> DataFrame:
    """All usable diagnostics under a path or glob, one JSON object per line."""
    return parse_diagnostics(_payloads(spark, uri))
