"""Files of a run: staged tables, query texts and results, reports, diagnostics, catalogue rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as st

from twinloom.errors import CodedError, LoadError, SpecError
from twinloom.operators.align import quoted
from twinloom.operators.runs import latest_pointers, next_pointers
from twinloom.plans.layout import RunLayout
from twinloom.sinks.folders import create_file, delete_folder, exists, names
from twinloom.sources.texts import query_from_text

TECHNICAL_FAILURE = "TECHNICAL_FAILURE"
POINTER_SCHEMA = "table_name string, run_id string, previous_run_id string, updated_at timestamp"
#: Entries after which the pointers in force are written as one file.
ENTRIES_PER_SNAPSHOT = 20
RUN_SCHEMA = "run_id string, event string"


#: Two different values of each type, for expressions that are evaluated but never yield.
_NEVER = {
    st.StringType: ("", "-"),
    st.LongType: (0, 1),
    st.DoubleType: (0.0, 1.0),
    st.BooleanType: (False, True),
    st.DateType: (date(1970, 1, 1), date(1970, 1, 2)),
    st.TimestampType: (datetime(1970, 1, 1), datetime(1970, 1, 2)),
}


def _required(name: str, kind: st.DataType) -> Column:
    """The column as one without NULLs; evaluating it at a NULL fails."""
    one, other = (F.lit(value).cast(kind) for value in _NEVER[type(kind)])
    fault = F.raise_error(F.lit(f"NULL in column {name}, which is declared without"))
    return F.coalesce(quoted(name), F.when(fault.isNull(), one).otherwise(other)).alias(name)


def declared(rows: DataFrame, schema: st.StructType) -> DataFrame:
    """The rows in declared order and types; columns declared without NULLs are so in the frame's schema."""
    found = {field.name: field.dataType for field in rows.schema.fields}
    different = {f.name: (f.dataType.simpleString(), str(found.get(f.name))) for f in schema.fields if found.get(f.name) != f.dataType}
    if different or len(found) != len(schema.fields):
        raise SpecError(f"The rows do not have the declared columns: {different or sorted(set(found) - set(schema.names))}")
    return rows.select(*(quoted(f.name) if f.nullable else _required(f.name, f.dataType) for f in schema.fields))


def stage_table(
    rows: DataFrame, uri: str, rows_per_file: int = 10_000_000, schema: st.StructType | None = None
) -> None:
    """Write a generated table as a Parquet directory, one or more files per task.

    With a ``schema`` the files declare its types and which columns hold no NULL.
    """
    if schema is not None:
        rows = declared(rows, schema)
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(uri)


def one_row(spark: SparkSession, **values) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(*(F.lit(value).alias(name) for name, value in values.items()))


def stage_query(spark: SparkSession, sql: str, uri: str) -> None:
    one_row(spark, value=sql.strip()).write.mode("overwrite").text(uri)


def materialize_query(spark: SparkSession, query_uri: str, result_uri: str) -> None:
    """Run a stored query and save its result unfiltered."""
    try:
        query_from_text(spark, query_uri).write.mode("overwrite").parquet(result_uri)
    except Exception as error:
        raise LoadError(
            "COMPARISON_RESULT_MATERIALIZATION_FAILED", f"Query {query_uri} could not be saved to {result_uri}: {error}"
        ) from error


def write_report(report: DataFrame, uri: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(uri)


def write_diagnostic(spark: SparkSession, uri: str, run_id: str, task_id: str, code: str, message: str) -> None:
    row = one_row(spark, run_id=run_id, task_id=task_id, code=code, message=message)
    row.write.mode("overwrite").json(uri)


@contextmanager
def failures_recorded(
    spark: SparkSession, layout: RunLayout, task_id: str, cancelled: Callable[[], bool] = lambda: False
) -> Iterator[None]:
    """Leave a diagnostic of what fails inside unless it was cancelled; the error itself goes on unchanged.

    Only errors of this library say more than their kind, since others may quote data.
    """
    try:
        yield
    except Exception as error:
        if cancelled():
            raise
        known = isinstance(error, CodedError)
        code = error.code if known else TECHNICAL_FAILURE
        text = str(error) if known else f"{type(error).__name__} in step {task_id}"
        with _noted(error):
            write_diagnostic(spark, layout.diagnostic(task_id), layout.run_id, task_id, code, text)
        raise


@contextmanager
def _noted(error: Exception) -> Iterator[None]:
    """A second failure becomes a note of the first one."""
    try:
        yield
    except Exception as second:
        error.add_note(f"No diagnostic was stored: {second}")


def record_run(spark: SparkSession, layout: RunLayout, event: str) -> None:
    one_row(spark, run_id=layout.run_id, event=event).write.mode("append").json(layout.runs_table)


def commit_pointers(
    spark: SparkSession, layout: RunLayout, tables: Iterable[str], updated_at: datetime
) -> None:
    """Publish a run: one pointer per table, in one numbered entry of the catalogue.

    An entry is created only if its number is free. Whoever comes second reads what the first
    one has published and tries the next number, so no commit loses sight of the one before.
    Moments of entries rise with their numbers, whatever the clocks say.
    """
    tables = list(tables)
    while True:
        number = _last_entry(spark, layout) + 1
        current = current_pointers(spark, layout)
        newest = current.agg(F.unix_millis(F.max("updated_at"))).first()[0]
        at = F.lit(updated_at) if newest is None else F.greatest(F.lit(updated_at), F.timestamp_millis(F.lit(newest + 1)))
        commits = one_row(spark, tables=tables, run_id=layout.run_id).select(
            F.explode("tables").alias("table_name"), "run_id", at.alias("updated_at")
        )
        lines = next_pointers(current, commits).select(F.to_json(F.struct("*"))).collect()  # one for each table of the run
        content = "\n".join(sorted(line[0] for line in lines)) + "\n"
        if create_file(spark, f"{layout.pointers_table}/{number:012d}.json", content.encode()):
            break
    if number % ENTRIES_PER_SNAPSHOT == 0:
        _compact(spark, layout, number)


def _entries(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name[:12]) for name in names(spark, folder) if re.fullmatch(r"\d{12}\.json", name))


def _last_entry(spark: SparkSession, layout: RunLayout) -> int:
    return max(_entries(spark, layout.pointers_table), default=0)


def _compact(spark: SparkSession, layout: RunLayout, number: int) -> None:
    """The pointers in force after an entry, as one file; the entries stay as the history."""
    rows = current_pointers(spark, layout, number).select(F.to_json(F.struct("*"))).collect()  # one for each table
    content = "\n".join(sorted(row[0] for row in rows)) + "\n"
    create_file(spark, f"{layout.pointers_table}/snapshots/{number:012d}.json", content.encode())


def current_pointers(spark: SparkSession, layout: RunLayout, up_to: int | None = None) -> DataFrame:
    """The pointer in force of each table, from the newest snapshot and the entries after it."""
    folder = layout.pointers_table
    entries = [n for n in _entries(spark, folder) if up_to is None or n <= up_to]
    snapshot = max((n for n in _entries(spark, f"{folder}/snapshots") if up_to is None or n <= up_to), default=0)
    files = [f"{folder}/{n:012d}.json" for n in entries if n > snapshot]
    files += [f"{folder}/snapshots/{snapshot:012d}.json"] if snapshot else []
    if not files:
        return spark.createDataFrame([], POINTER_SCHEMA)
    return latest_pointers(spark.read.schema(POINTER_SCHEMA).json(files)).select("table_name", "run_id", "previous_run_id", "updated_at")


def read_pointers(spark: SparkSession, layout: RunLayout) -> DataFrame:
    """The whole history of pointers."""
    if not _last_entry(spark, layout):
        return spark.createDataFrame([], POINTER_SCHEMA)
    return spark.read.schema(POINTER_SCHEMA).json(f"{layout.pointers_table}/*.json")


def read_runs(spark: SparkSession, layout: RunLayout) -> DataFrame:
    """Runs recorded as started and not yet removed."""
    events = spark.read.schema(RUN_SCHEMA).json(layout.runs_table)
    started = events.where("event = 'started'").select("run_id")
    return started.join(events.where("event = 'removed'"), "run_id", "left_anti").distinct()


def delete_run(spark: SparkSession, layout: RunLayout) -> None:
    """Remove the files of one run and record that it is gone."""
    if not layout.run_id.strip(". ") or "/" in layout.run_id:
        raise ValueError(f"Not the id of one run: {layout.run_id!r}")
    delete_folder(spark, layout.run_folder)
    record_run(spark, layout, "removed")
