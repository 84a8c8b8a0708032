"""Read and audit comparison reports as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("MATCH", "MISMATCH")
RATIO_TOLERANCE = 1e-6

REPORT_SCHEMA = """
    run_id string, checked_at string, status string,
    summary struct<
        row_count: struct<hive: bigint, iceberg: bigint>,
        row_count_delta: bigint,
        exclusive_row_count: struct<hive: bigint, iceberg: bigint>,
        exclusive_row_ratio: struct<hive: double, iceberg: double>>,
    artifacts struct<hive_result_uri: string, iceberg_result_uri: string>,
    excluded_columns string, compared_columns array<string>
"""
EXCLUDED_SCHEMA = "hive array<string>, iceberg array<string>, temporal array<string>"

_NUMBERS = (
    "row_count.hive",
    "row_count.iceberg",
    "row_count_delta",
    "exclusive_row_count.hive",
    "exclusive_row_count.iceberg",
    "exclusive_row_ratio.hive",
    "exclusive_row_ratio.iceberg",
)


def first_problem(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that is broken, or NULL. An undecided rule is broken."""
    return F.coalesce(
        *(F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules),
        F.lit(None).cast("string"),
    )


def parse_reports(payloads: DataFrame, payload: str = "payload", expected_run: str | None = None) -> DataFrame:
    """Typed reports from JSON text, with a ``problem`` column naming a structural fault.

    A missing ``excluded_columns`` means empty lists. ``expected_run`` names a column
    that the report's run id must equal.
    """
    report = F.from_json(F.col(payload), REPORT_SCHEMA, {"mode": "PERMISSIVE"})
    parsed = payloads.withColumn("report", report)
    empty = F.array().cast("array<string>")
    sections = ("hive", "iceberg", "temporal")
    given = F.col("report.excluded_columns")  # still JSON text, so absence and bad content differ
    excluded = F.from_json(given, EXCLUDED_SCHEMA)
    lists = F.struct(*(F.when(given.isNull(), empty).otherwise(excluded[name]).alias(name) for name in sections))
    texts = ("run_id", "checked_at", "status", "artifacts.hive_result_uri", "artifacts.iceberg_result_uri")
    rules = [(name, F.length(f"report.{name}") > 0) for name in texts]
    if expected_run is not None:
        rules.insert(1, ("run_id mismatch", F.col("report.run_id") == F.col(expected_run)))
    rules.append(("unsupported status", F.col("report.status").isin(*STATUSES)))
    rules += [(name, F.col(f"report.summary.{name}").isNotNull()) for name in _NUMBERS]
    rules += [
        (
            f"excluded_columns.{name}",
            F.col(f"excluded_columns.{name}").isNotNull()
            & ~F.exists(F.col(f"excluded_columns.{name}"), lambda item: item.isNull()),
        )
        for name in sections
    ]
    kept = [F.col(name) for name in payloads.columns if name != payload]
    typed = parsed.withColumn("excluded_columns", lists).withColumn("problem", first_problem(rules))
    return typed.select(
        *kept,
        *(F.col(f"report.{n}").alias(n) for n in ("run_id", "checked_at", "status", "summary", "artifacts")),
        "excluded_columns",
        F.col("report.compared_columns").alias("compared_columns"),
        "problem",
    )


def audit_reports(reports: DataFrame) -> DataFrame:
    """Add ``inconsistency``: the first rule the report's own numbers break, or NULL.

    ``counts_only`` warns that no column was comparable, so MATCH says no more than equal counts.
    """

    def number(name: str) -> Column:
        return F.col(f"summary.{name}")

    def share(side: str) -> Column:
        whole = F.nullif(number(f"row_count.{side}"), F.lit(0).cast("bigint"))
        return F.coalesce(F.round(number(f"exclusive_row_count.{side}") / whole, 6), F.lit(0.0))

    sides = ("hive", "iceberg")
    rules = []
    for name in ("row_count", "exclusive_row_count"):
        rules += [(f"{name}.{s} negative", number(f"{name}.{s}") >= 0) for s in sides]
    for s in sides:
        rules.append((f"exclusive_row_ratio.{s} outside 0..1", number(f"exclusive_row_ratio.{s}").between(0, 1)))
    for s in sides:
        fits = number(f"exclusive_row_count.{s}") <= number(f"row_count.{s}")
        rules.append((f"exclusive_row_count.{s} above row_count", fits))
    delta = F.abs(number("row_count.hive") - number("row_count.iceberg"))
    rules.append(("row_count_delta", number("row_count_delta") == delta))
    for s in sides:
        close = F.abs(number(f"exclusive_row_ratio.{s}") - share(s)) <= RATIO_TOLERANCE
        rules.append((f"exclusive_row_ratio.{s} does not match", close))
    nothing = reduce(lambda a, b: a & b, (number(f"exclusive_row_count.{s}") == 0 for s in sides))
    rules.append(("status", F.col("status") == F.when(nothing, "MATCH").otherwise("MISMATCH")))
    counts_only = F.coalesce(F.size("compared_columns") == 0, F.lit(False))
    return reports.withColumn("inconsistency", first_problem(rules)).withColumn("counts_only", counts_only)


def parse_diagnostics(payloads: DataFrame, payload: str = "payload", expected_run: str = "expected_run") -> DataFrame:
    """Diagnostics from JSON text; malformed ones and those of another run are left out."""
    fields = ("run_id", "task_id", "code", "message")
    schema = ", ".join(f"{name} string" for name in fields)
    parsed = payloads.select(F.col(expected_run).alias("__run"), F.from_json(payload, schema).alias("d"))
    whole = reduce(lambda a, b: a & b, (F.length(f"d.{name}") > 0 for name in fields))
    return parsed.where(whole & (F.col("d.run_id") == F.col("__run"))).select("d.*")
