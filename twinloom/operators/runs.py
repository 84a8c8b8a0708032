"""The run catalogue as tables: runs, pointers, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinloom.errors import SpecError


def list_runs(runs: DataFrame, run_column: str = "run_id") -> DataFrame:
    """Distinct run ids; ids start with a timestamp, so their order is time order."""
    return runs.select(F.col(run_column).alias("run_id")).distinct().orderBy("run_id")


def latest_pointers(history: DataFrame) -> DataFrame:
    """The current pointer of each table out of the append-only commit history.

    An aggregate, not a window: one table that owns most commits is combined before the
    shuffle instead of being sorted in one task.
    """
    entry = F.struct("updated_at", "run_id", "previous_run_id")
    latest = history.groupBy("table_name").agg(F.max(entry).alias("latest"))
    return latest.select("table_name", "latest.run_id", "latest.previous_run_id", "latest.updated_at")


def next_pointers(history: DataFrame, commits: DataFrame) -> DataFrame:
    """Pointer rows for newly published tables, remembering the run each one replaces.

    ``commits`` has ``table_name``, ``run_id``, ``updated_at`` and one row per table.
    """
    current = latest_pointers(history).select("table_name", F.col("run_id").alias("previous_run_id"))
    return commits.join(current, "table_name", "left").select(
        "table_name", "run_id", "previous_run_id", "updated_at"
    )


def protected_runs(pointers: DataFrame) -> DataFrame:
    """Runs that a current pointer needs. A pointer without a run id is an error."""
    checked = F.when(F.length("run_id") > 0, F.col("run_id")).otherwise(
        F.raise_error(F.concat(F.lit("Pointer without a run id: "), F.col("table_name")))
    )
    return pointers.select(checked.alias("run_id")).distinct()


def check_keep(keep: int) -> None:
    if isinstance(keep, bool) or not isinstance(keep, int) or keep < 1:
        raise SpecError("The number of retained runs must be a positive integer")


def runs_to_remove(runs: DataFrame, pointers: DataFrame, keep: int) -> DataFrame:
    """Runs outside the ``keep`` to be retained: protected ones first, then the newest.

    One aggregate marks the existing and the protected runs; the oldest unprotected run of a
    distributed top-k is the threshold.
    """
    check_keep(keep)
    yes, no = F.lit(True), F.lit(False)
    marked = runs.select("run_id", yes.alias("exists"), no.alias("protected")).unionByName(
        protected_runs(pointers).select("run_id", no.alias("exists"), yes.alias("protected"))
    )
    marked = marked.groupBy("run_id").agg(F.max("exists").alias("exists"), F.max("protected").alias("protected"))
    marked = marked.where("exists")
    retained = marked.orderBy(F.desc("protected"), F.desc("run_id")).limit(keep)
    oldest = retained.agg(F.min(F.when(~F.col("protected"), F.col("run_id")))).first()[0]
    free = marked.where("NOT protected").select("run_id")
    return free if oldest is None else free.where(F.col("run_id") < oldest)
