"""The whole run: specification -> a chain of tables -> two targets each -> two queries -> one report."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entry_queries.base import AS_OF, KEYS, read, use_utc
from entry_queries.duck import SEED
from entry_queries.references import CHAIN, ORACLES as REFERENCE_ORACLES
from twinloom.plans.pipeline import run_pipeline
from twinloom.session import shared_folder
from twinloom.sources.tables import read_staged

QUERIES, ORACLES = {}, {}

FIELDS = {
    "stations": "altitude double, opened date, opened_year string, station string",
    "sensors": "in_use boolean, station string, model string",
    "readings": "station string, taken timestamp, month bigint, celsius double",
}
REPORT_SQL = """
    SELECT s.model, r.month, count(*) AS n_readings, count(r.celsius) AS n_measured, max(r.celsius) AS hottest,
           min(t.opened_year) AS since, max(t.altitude) AS highest
    FROM {readings} r JOIN {sensors} s ON r.station = s.station JOIN {stations} t ON s.station = t.station
    WHERE s.in_use GROUP BY s.model, r.month"""


def create_target(spark: SparkSession, fields: str) -> str:
    name = f"twinloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({fields}) USING PARQUET LOCATION '{shared_folder(spark, 'target')}'")
    return name


def run(spark: SparkSession, sf_dir: str):
    use_utc(spark)
    rows, tables, targets = {}, [], {}
    for name, (given, columns) in CHAIN.items():
        ids = read(spark, sf_dir, given).select(F.col(KEYS[given]).alias("row_id"))
        rows[name] = ids
        targets[name] = {engine: create_target(spark, FIELDS[name]) for engine in ("hive", "iceberg")}
        tables.append(
            {
                "table_name": name,
                "total_rows": ids.count(),
                "columns": columns,
                "write_mode": "OVERWRITE_TABLE",
                "hive_target_table": targets[name]["hive"],
                "iceberg_target_table": targets[name]["iceberg"],
            }
        )
    queries = {
        f"{engine}_sql": REPORT_SQL.format(**{name: targets[name][engine] for name in targets})
        for engine in ("hive", "iceberg")
    }
    base = shared_folder(spark, "base")
    try:
        return run_pipeline(spark, {"tables": tables, "queries": queries}, base, AS_OF, SEED, rows=rows)
    finally:  # results and reports are files of their own
        for engines in targets.values():
            for name in engines.values():
                spark.sql(f"DROP TABLE {name}")


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).report


def _flat_report(spark, sf_dir):
    return pipeline_report(spark, sf_dir).select(
        "status",
        F.col("summary.row_count.hive").alias("hive_rows"),
        F.col("summary.row_count.iceberg").alias("iceberg_rows"),
        F.col("summary.exclusive_row_count.hive").alias("hive_only"),
        F.col("summary.exclusive_row_count.iceberg").alias("iceberg_only"),
    )


_GROUPED = (
    "SELECT model, month, count(*) AS n_readings, count(celsius) AS n_measured, max(celsius) AS hottest, "
    f"min(opened_year) AS since, max(altitude) AS highest FROM ({REFERENCE_ORACLES['gen_two_tables']}) t WHERE in_use GROUP BY ALL"
)

QUERIES["pipeline_report"] = _flat_report
ORACLES["pipeline_report"] = (
    f"SELECT 'MATCH' AS status, count(*) AS hive_rows, count(*) AS iceberg_rows, 0::BIGINT AS hive_only, "
    f"0::BIGINT AS iceberg_only FROM ({_GROUPED}) g"
)


def _saved_result(spark, sf_dir):
    layout = run(spark, sf_dir).layout
    return read_staged(spark, layout.query_result("hive"))


QUERIES["pipeline_result"] = _saved_result
ORACLES["pipeline_result"] = _GROUPED
