"""One run from specification to report."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as st

from twinloom.errors import CompareError, LoadError, SpecError
from twinloom.operators.audit import audit_reports
from twinloom.operators.compare import compare, report_frame
from twinloom.operators.generate import tables_in_turn
from twinloom.operators.runs import check_keep, runs_to_remove
from twinloom.plans.contract import ENGINES, Contract, read_contract
from twinloom.plans.layout import RunLayout, new_run_id
from twinloom.session import session_like, small_methods
from twinloom.sinks import artifacts
from twinloom.sinks.targets import TableLoad, load_tables
from twinloom.sources.tables import read_staged
from twinloom.sources.texts import read_reports


logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunResult:
    layout: RunLayout
    report: DataFrame
    removed_runs: tuple[str, ...]


def run_pipeline(
    spark: SparkSession,
    raw_contract: Mapping,
    base: str,
    as_of: date,
    seed: int = 0,
    run_id: str | None = None,
    keep_runs: int = 10,
    rows: Mapping[str, DataFrame] | None = None,
) -> RunResult:
    """Generate, stage, load both targets, run both queries, reconcile, publish.

    Pointers move only after every step has succeeded, also when the report says
    MISMATCH; readers therefore never see the tables of a failed run.
    """
    check_keep(keep_runs)
    contract = read_contract(raw_contract, as_of)
    layout = RunLayout(base.rstrip("/"), run_id or new_run_id())
    if artifacts.exists(spark, layout.run_folder):
        raise SpecError(f"Run {layout.run_id} exists already")
    artifacts.record_run(spark, layout, "started")
    try:
        stage(spark, contract, layout, seed, rows)
    except Exception:
        artifacts.delete_run(spark, layout)
        raise
    load_engines(spark, contract, layout)
    with artifacts.failures_recorded(spark, layout, "compare"):
        reconcile(spark, contract, layout)
    now = datetime.now(timezone.utc)
    artifacts.commit_pointers(spark, layout, [t.name for t in contract.tables], now)
    report = checked_report(spark, layout)
    try:
        removed = retain(spark, layout, keep_runs)
    except Exception:  # the run itself has succeeded and is published
        logger.exception("Old runs could not be removed after run %s", layout.run_id)
        removed = ()
    return RunResult(layout, report, removed)


def stage(
    spark: SparkSession,
    contract: Contract,
    layout: RunLayout,
    seed: int,
    rows: Mapping[str, DataFrame] | None = None,
) -> None:
    with small_methods(spark):
        schemas = {table.name: table.schema for table in contract.tables}
        for name, frame in tables_in_turn(spark, contract.tables, seed, rows):
            own = schemas[name].names
            supplied = [st.StructField(f.name, f.dataType) for f in frame.schema.fields if f.name not in own]
            artifacts.stage_table(frame, layout.table_data(name), schema=st.StructType(supplied + schemas[name].fields))
    for engine in ENGINES:
        artifacts.stage_query(spark, contract.queries[engine], layout.query(engine))


def load_engines(spark: SparkSession, contract: Contract, layout: RunLayout) -> None:
    """Load all engines at once, each in a session of its own, so that settings do not meet.

    When one fails, the jobs of the others are cancelled; only the first failure is recorded and raised. The
    sessions have the caller's settings and tables, but not its temporary views.
    """
    sessions = {engine: session_like(spark) for engine in ENGINES}
    groups = {engine: f"{layout.run_id}-{uuid.uuid4().hex}-{engine}" for engine in ENGINES}
    stopped = threading.Event()

    def load(engine: str) -> None:
        spark.sparkContext.setJobGroup(groups[engine], f"load {engine} of run {layout.run_id}")  # of this thread
        with artifacts.failures_recorded(sessions[engine], layout, f"load_{engine}", stopped.is_set):
            load_engine(sessions[engine], contract, layout, engine, stopped)

    with ThreadPoolExecutor(len(ENGINES)) as pool:
        running = {pool.submit(load, engine): engine for engine in ENGINES}
        failures = []
        for done in as_completed(running):
            if done.exception() is None:
                continue
            failures.append(done.exception())
            stopped.set()
            for engine in ENGINES:
                if engine != running[done]:
                    spark.sparkContext.cancelJobGroup(groups[engine])
    if failures:
        raise failures[0]


def load_engine(
    spark: SparkSession, contract: Contract, layout: RunLayout, engine: str, stopped: threading.Event | None = None
) -> None:
    """Load the tables of one engine and save its query's result, unless told to stop between two steps."""

    def go_on() -> None:
        if stopped is not None and stopped.is_set():
            raise LoadError("LOAD_CANCELLED", f"The load of {engine} was cancelled because another engine failed")

    def loads():
        for p in contract.loads:
            go_on()
            yield TableLoad(layout.table_data(p.table.name), p.targets[engine], p.mode.value, p.columns[engine])

    load_tables(spark, loads())
    go_on()
    artifacts.materialize_query(spark, layout.query(engine), layout.query_result(engine))


def reconcile(spark: SparkSession, contract: Contract, layout: RunLayout) -> None:
    uris = [layout.query_result(engine) for engine in ENGINES]
    left, right = (spark.read.parquet(uri) for uri in uris)
    columns, verdict = compare(left, right, *(contract.excludes[engine] for engine in ENGINES))
    checked_at = datetime.now(timezone.utc).replace(microsecond=0).isoformat()
    artifacts.write_report(report_frame(columns, verdict, layout.run_id, checked_at, *uris), layout.report)


def checked_report(spark: SparkSession, layout: RunLayout) -> DataFrame:
    """The stored report, after its structure and its numbers have been checked."""
    report = audit_reports(read_reports(spark, layout.report))
    fault = report.selectExpr("coalesce(problem, inconsistency) AS fault").first()
    if fault is None or fault.fault is not None:
        raise CompareError("REPORT_INVALID", f"Report of run {layout.run_id} is unusable: {fault}")
    return report.drop("expected_run", "problem", "inconsistency")


def retain(spark: SparkSession, layout: RunLayout, keep_runs: int) -> tuple[str, ...]:
    """Delete the runs that no pointer needs and that are not among the newest."""
    pointers = artifacts.current_pointers(spark, layout)
    gone = runs_to_remove(artifacts.read_runs(spark, layout), pointers, keep_runs)
    removed = tuple(sorted(row.run_id for row in gone.toLocalIterator()))
    for run_id in removed:
        artifacts.delete_run(spark, layout.for_run(run_id))
    return removed


def latest_table(spark: SparkSession, base: str, table: str) -> DataFrame | None:
    """The newest published data of a table, or None when it was never published."""
    layout = RunLayout(base.rstrip("/"), "")
    pointer = artifacts.current_pointers(spark, layout).where(F.col("table_name") == table).first()
    if pointer is None:
        return None
    return read_staged(spark, layout.for_run(pointer.run_id).table_data(table))
