"""What is refused, with which code, beside what is accepted: over ``orders``, ``customer`` and ``events``."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as st

from entry_queries.base import AS_OF, column, read, reference, synthetic, use_utc
from twinloom.errors import CodedError, LoadError, SpecError
from twinloom.operators.align import align_to_schema, select_load_columns, strict_casts
from twinloom.operators.compare import compare
from twinloom.plans.layout import RunLayout
from twinloom.plans.pipeline import latest_table, run_pipeline
from twinloom.session import shared_folder
from twinloom.sinks.artifacts import exists, failures_recorded
from twinloom.sources.texts import read_diagnostics

QUERIES, ORACLES = {}, {}
Outcome = Callable[[], DataFrame]


def query(name: str, sql: str):
    def register(run):
        def with_utc(spark, sf_dir):
            use_utc(spark)
            return run(spark, sf_dir)

        QUERIES[name], ORACLES[name] = with_utc, sql
        return run

    return register


def outcomes(cases: dict[str, Outcome], refused: Callable[[], DataFrame]) -> DataFrame:
    """One row a case: its own (outcome, n_rows), or the error's code and the rows it was refused for."""
    rows = []
    for case, run in cases.items():
        try:
            found = run().select("outcome", "n_rows")
        except (CodedError, SpecError) as error:
            code = error.code if isinstance(error, CodedError) else type(error).__name__
            found = refused().select(F.lit(code).alias("outcome"), "n_rows")
        rows.append(found.select(F.lit(case).alias("case_name"), "outcome", F.col("n_rows").cast("bigint").alias("n_rows")))
    return reduce(DataFrame.unionByName, rows)


def counted(frame: DataFrame, outcome: str = "accepted") -> DataFrame:
    return frame.agg(F.lit(outcome).alias("outcome"), F.count("*").alias("n_rows"))


def expected(cases: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{case}' AS case_name, '{outcome}' AS outcome, {count} AS n_rows" for case, (outcome, count) in cases.items()
    )


ORDERS = "(SELECT count(*) FROM orders)"


@query(
    "gen_refused",
    expected(
        {
            "one class, unique": ("SpecError", ORDERS),
            "general pattern, unique": ("SpecError", ORDERS),
            "general pattern": ("generated", ORDERS),
            "a parent without values": ("UnsatisfiableError", ORDERS),
            "a parent without values, a child without": ("generated", "0"),
            "no such parents": ("SpecError", ORDERS),
            "a cycle": ("SpecError", ORDERS),
        }
    ),
)
def _(spark, sf_dir):
    """Specifications over the rows of ``orders``; what is generated counts its values."""

    def child(*columns, **parents) -> Outcome:
        tables = {name: ("customer", [parent]) for name, parent in parents.items()}

        def run() -> DataFrame:
            frame = synthetic(spark, sf_dir, **tables, t=("orders", list(columns)))["t"]
            return frame.agg(F.lit("generated").alias("outcome"), F.count("v").alias("n_rows"))

        return run

    none = column("k", "INT", null_ratio=1.0)
    cases = {
        "one class, unique": child(column("v", "STRING", regular_expr="^[a-z]{9}$", is_unique=True)),
        "general pattern, unique": child(column("v", "STRING", regular_expr="^(ab|cd){9}$", is_unique=True)),
        "general pattern": child(column("v", "STRING", regular_expr="^(ab|cd){9}$")),
        "a parent without values": child(reference("v", "p", "k"), p=none),
        "a parent without values, a child without": child(reference("v", "p", "k", null_ratio=1.0), p=none),
        "no such parents": child(reference("v", "q", "k"), reference("w", "p", "m"), p=none),
        "a cycle": child(reference("v", "p", "k"), column("w", "INT"), p=reference("k", "t", "w")),
    }
    return outcomes(cases, lambda: counted(read(spark, sf_dir, "orders")))


@query(
    "cmp_refused",
    expected(
        {
            "a repeated column": ("COMPARISON_DUPLICATE_COLUMNS", ORDERS),
            "a repeated column that is excluded": ("MATCH", ORDERS),
            "another column": ("COMPARISON_COLUMN_NAMES_MISMATCH", ORDERS),
            "another case": ("COMPARISON_COLUMN_NAMES_MISMATCH", ORDERS),
            "a nested column": ("COMPARISON_UNSUPPORTED_TYPE", ORDERS),
            "a nested column that is excluded": ("MATCH", ORDERS),
            "a whole and a fraction": ("COMPARISON_SCHEMA_MISMATCH", ORDERS),
            "a number and its text": ("COMPARISON_SCHEMA_MISMATCH", ORDERS),
            "whole numbers of two widths": ("MATCH", ORDERS),
        }
    ),
)
def _(spark, sf_dir):
    """Comparisons of ``orders`` with itself in other columns and types."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    key = F.col("o_orderkey")
    repeated = orders.select(key, F.col("o_custkey").alias("x"), F.col("o_orderstatus").alias("x"))
    nested = orders.select(key, F.array("o_custkey").alias("x"))

    def pair(left: DataFrame, right: DataFrame, *excluded: str) -> Outcome:
        return lambda: compare(left, right, excluded, excluded)[1].select(F.col("status").alias("outcome"), F.col("left_count").alias("n_rows"))

    cases = {
        "a repeated column": pair(repeated, repeated),
        "a repeated column that is excluded": pair(repeated, repeated, "X"),
        "another column": pair(orders, orders.drop("o_custkey")),
        "another case": pair(orders, orders.withColumnRenamed("o_custkey", "O_CUSTKEY")),
        "a nested column": pair(nested, nested),
        "a nested column that is excluded": pair(nested, nested, "x"),
        "a whole and a fraction": pair(orders.select(key), orders.select(key.cast("decimal(20,0)").alias("o_orderkey"))),
        "a number and its text": pair(orders.select(key), orders.select(key.cast("string").alias("o_orderkey"))),
        "whole numbers of two widths": pair(orders.select(key), orders.select(key.cast("int").alias("o_orderkey"))),
    }
    return outcomes(cases, lambda: counted(orders))


@query(
    "load_refused",
    expected(
        {
            "names equal up to case": ("LOAD_COLUMNS_AMBIGUOUS_BY_CASE", ORDERS),
            "names asked for twice": ("LOAD_COLUMNS_AMBIGUOUS_BY_CASE", ORDERS),
            "a column that is not staged": ("LOAD_COLUMNS_MISSING_IN_PARQUET", ORDERS),
            "another case": ("accepted", ORDERS),
            "a column the target lacks": ("LOAD_COLUMNS_ABSENT_IN_TARGET", ORDERS),
            "a required list": ("LOAD_NON_NULLABLE_TARGET_COLUMN_MISSING", ORDERS),
            "an optional list": ("accepted", ORDERS),
        }
    ),
)
def _(spark, sf_dir):
    """Columns of ``orders`` that are to be loaded, and targets they do not fit."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    twice = orders.select("o_orderkey", F.col("o_custkey").alias("O_ORDERKEY"))

    def target(nullable: bool) -> st.StructType:
        return st.StructType([*orders.schema.fields, st.StructField("tags", st.ArrayType(st.StringType()), nullable)])

    cases = {
        "names equal up to case": lambda: counted(select_load_columns(twice, ["o_orderkey"])),
        "names asked for twice": lambda: counted(select_load_columns(orders, ["o_orderkey", "O_orderkey"])),
        "a column that is not staged": lambda: counted(select_load_columns(orders, ["o_totalprice"])),
        "another case": lambda: counted(select_load_columns(orders, ["O_CUSTKEY"])),
        "a column the target lacks": lambda: counted(align_to_schema(orders, orders.drop("o_custkey").schema)),
        "a required list": lambda: counted(align_to_schema(orders, target(False))),
        "an optional list": lambda: counted(align_to_schema(orders, target(True))),
    }
    return outcomes(cases, lambda: counted(orders))


@query(
    "diagnostics_sink",
    "SELECT event_type AS run_id, 'load' AS task_id, 'TOO_FEW_EVENTS' AS code, 'Only ' || count(*) || ' events' AS message "
    "FROM events GROUP BY ALL UNION ALL SELECT DISTINCT event_type, 'cast', 'TECHNICAL_FAILURE', "
    "'NumberFormatException in step cast' FROM events",
)
def _(spark, sf_dir):
    """A run for each of the few event types: one step fails with a code, one in the middle of a Spark job, one not at all."""
    base = shared_folder(spark, "failing")
    events = read(spark, sf_dir, "events")
    for kind, count in events.groupBy("event_type").count().collect():
        layout = RunLayout(base, kind)
        own = events.where(F.col("event_type") == kind)
        with suppress(LoadError), failures_recorded(spark, layout, "load"):
            raise LoadError("TOO_FEW_EVENTS", f"Only {count} events")
        with suppress(Exception), failures_recorded(spark, layout, "cast"), strict_casts(spark):
            own.select(F.col("props").cast("bigint")).write.format("noop").mode("overwrite").save()
        with failures_recorded(spark, layout, "count"):
            own.count()
    return read_diagnostics(spark, RunLayout(base, "*").diagnostics)


@query(
    "failed_run_dropped",
    "SELECT o_orderkey, o_orderkey AS k, false AS failed_run_exists FROM orders",
)
def _(spark, sf_dir):
    """A run publishes a table of order keys, the next one fails after staging it; readers still have the first."""
    base = shared_folder(spark, "runs-of-two-days")
    keys = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    count = keys.count()
    targets = {engine: f"twinloom_{base.rsplit('-', 1)[1]}_{engine}" for engine in ("hive", "iceberg")}
    tables = [
        {
            "table_name": name,
            "total_rows": count,
            "columns": [column("k", "INT", min_value=0, max_value=count - 1, is_unique=True)],
            "write_mode": "OVERWRITE_TABLE",
            **{f"{engine}_target_table": target for engine, target in targets.items()},
        }
        for name in ("first", "second")
    ]
    contract = {"tables": tables[:1], "queries": {f"{engine}_sql": f"SELECT k FROM {name}" for engine, name in targets.items()}}
    for name in targets.values():
        spark.sql(f"CREATE TABLE {name} (k bigint) USING PARQUET LOCATION '{shared_folder(spark, 'target')}'")
    try:
        run_pipeline(spark, contract, base, AS_OF, run_id="20250101_000000_00000001", rows={"first": keys})
        failing = RunLayout(base, "20250102_000000_00000002")
        wrong = {"first": keys, "second": keys.withColumn("row_id", F.col("row_id") + 1)}
        with suppress(SpecError):
            run_pipeline(spark, contract | {"tables": tables}, base, AS_OF, run_id=failing.run_id, rows=wrong)
    finally:
        for name in targets.values():
            spark.sql(f"DROP TABLE {name}")
    left = F.lit(exists(spark, failing.run_folder)).alias("failed_run_exists")
    return latest_table(spark, base, "first").select(F.col("k").alias("o_orderkey"), "k", left)
