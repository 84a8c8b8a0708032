"""Reports, diagnostics, pointers and retention over rows derived from ``orders`` and ``events``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from entry_queries.base import read, use_utc
from twinloom.operators.audit import audit_reports, parse_diagnostics, parse_reports
from twinloom.operators.runs import latest_pointers, list_runs, next_pointers, protected_runs, runs_to_remove
from twinloom.plans.layout import RunLayout
from twinloom.plans.pipeline import latest_table
from twinloom.session import shared_folder
from twinloom.sinks.artifacts import commit_pointers, stage_table
from twinloom.sources.texts import read_diagnostics, read_reports

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str):
    def register(run):
        def with_utc(spark, sf_dir):
            use_utc(spark)
            return run(spark, sf_dir)

        QUERIES[name], ORACLES[name] = with_utc, sql
        return run

    return register


# One report per order: counts from keys and prices, some of them inconsistent or malformed.
REPORT_ROWS = """
    SELECT o_orderkey, concat(year(o_orderdate), '_', o_orderkey) AS run_id, o_orderstatus AS kind,
           o_custkey + 10 AS hive_rows, o_custkey + 10 + CASE WHEN o_orderpriority = '1-URGENT' THEN 5 ELSE 0 END AS iceberg_rows,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS hive_only,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 6 ELSE 0 END AS iceberg_only,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 5 WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS delta,
           CASE WHEN o_orderpriority = '1-URGENT' OR o_orderpriority = '5-LOW' THEN 'MISMATCH'
                WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 'UNKNOWN' ELSE 'MATCH' END AS status
    FROM {0}"""


def report_payloads(spark, sf_dir):
    """Report JSON texts and the run each was asked for."""
    rows = spark.sql(REPORT_ROWS.format("{rows}"), rows=read(spark, sf_dir, "orders"))
    hive = F.round(F.col("hive_only") / F.col("hive_rows"), 6)
    iceberg = F.round(F.col("iceberg_only") / F.col("iceberg_rows"), 6)

    def pair(a, b):
        return F.struct(F.lit(a).alias("hive") if isinstance(a, str) else a.alias("hive"),
                        F.lit(b).alias("iceberg") if isinstance(b, str) else b.alias("iceberg"))

    names = F.array(F.lit("load_part"))
    excluded = F.when(
        F.col("kind") == "F", F.struct(names.alias("hive"), F.array().cast("array<string>").alias("iceberg"), names.alias("temporal"))
    )
    body = F.struct(
        "run_id",
        F.when(F.col("hive_rows") % 17 == 0, "").otherwise("2025-06-30T00:00:00+00:00").alias("checked_at"),
        "status",
        F.struct(
            pair(F.col("hive_rows"), F.col("iceberg_rows")).alias("row_count"),
            F.col("delta").alias("row_count_delta"),
            pair(F.col("hive_only"), F.col("iceberg_only")).alias("exclusive_row_count"),
            pair(hive, iceberg).alias("exclusive_row_ratio"),
        ).alias("summary"),
        F.struct(F.lit("a").alias("hive_result_uri"), F.lit("b").alias("iceberg_result_uri")).alias("artifacts"),
        excluded.alias("excluded_columns"),
    )
    asked = F.when(F.col("hive_rows") % 13 == 0, "another").otherwise(F.col("run_id"))
    return rows.select("o_orderkey", asked.alias("asked_run"), F.to_json(body).alias("payload"))


SCAN = f"""WITH r AS ({REPORT_ROWS.format('orders')}) SELECT o_orderkey, run_id, status, hive_rows, iceberg_rows,
    CASE WHEN kind = 'F' THEN 1 ELSE 0 END AS n_hive_excluded,
    CASE WHEN hive_rows % 13 = 0 THEN 'run_id mismatch' WHEN hive_rows % 17 = 0 THEN 'checked_at'
         WHEN status = 'UNKNOWN' THEN 'unsupported status' END AS problem FROM r"""


@query("report_scan", SCAN)
def _(spark, sf_dir):
    reports = parse_reports(report_payloads(spark, sf_dir), expected_run="asked_run")
    return reports.select(
        "o_orderkey",
        "run_id",
        "status",
        F.col("summary.row_count.hive").alias("hive_rows"),
        F.col("summary.row_count.iceberg").alias("iceberg_rows"),
        F.size("excluded_columns.hive").alias("n_hive_excluded"),
        "problem",
    )


@query(
    "report_audit",
    f"""WITH r AS ({REPORT_ROWS.format('orders')}) SELECT o_orderkey,
        CASE WHEN delta <> abs(hive_rows - iceberg_rows) THEN 'row_count_delta'
             WHEN status <> CASE WHEN hive_only = 0 AND iceberg_only = 0 THEN 'MATCH' ELSE 'MISMATCH' END THEN 'status'
        END AS inconsistency FROM r""",
)
def _(spark, sf_dir):
    reports = parse_reports(report_payloads(spark, sf_dir), expected_run="asked_run")
    return audit_reports(reports).select("o_orderkey", "inconsistency")


@query(
    "report_files",
    "SELECT 'run=' || strftime(o_orderdate, '%Y') AS run_id, count(*) AS n_reports, "
    "count(*) FILTER (WHERE o_orderstatus = 'P') AS n_faulty FROM orders GROUP BY ALL",
)
def _(spark, sf_dir):
    """Reports written under run folders (one run per year of orders) and scanned from there."""
    base = shared_folder(spark, "reports")
    orders = read(spark, sf_dir, "orders").withColumn("run", F.date_format("o_orderdate", "yyyy"))
    claimed = F.when(F.col("o_orderstatus") == "P", "other").otherwise(F.concat(F.lit("run="), "run"))
    text = F.concat(
        F.lit('{"run_id":"'), claimed, F.lit('","checked_at":"t","status":"MATCH","summary":{"row_count":{"hive":'),
        F.col("o_custkey"), F.lit(',"iceberg":'), F.col("o_custkey"),
        F.lit('},"row_count_delta":0,"exclusive_row_count":{"hive":0,"iceberg":0},"exclusive_row_ratio":'
              '{"hive":0.0,"iceberg":0}},"artifacts":{"hive_result_uri":"a","iceberg_result_uri":"b"}}'),
    )
    orders.select(text.alias("value"), "run").write.partitionBy("run").text(f"{base}/runs")
    reports = read_reports(spark, f"{base}/runs")
    return reports.groupBy(F.col("expected_run").alias("run_id")).agg(
        F.count("*").alias("n_reports"), F.count("problem").alias("n_faulty")
    )


@query(
    "diagnostics_files",
    "SELECT 'run=' || event_type AS run_id, user_id::VARCHAR AS task_id, count(*) AS n FROM events "
    "WHERE user_id <> 3 GROUP BY ALL",
)
def _(spark, sf_dir):
    """Diagnostics written under run folders (one run per event type); user 3 claims another run."""
    base = shared_folder(spark, "diagnostics")
    claimed = F.when(F.col("user_id") == 3, "other").otherwise(F.concat(F.lit("run="), "event_type"))
    entry = F.struct(
        claimed.alias("run_id"),
        F.col("user_id").cast("string").alias("task_id"),
        F.lit("TECHNICAL_FAILURE").alias("code"),
        F.col("props").alias("message"),
    )
    rows = read(spark, sf_dir, "events").select(F.to_json(entry).alias("value"), F.col("event_type").alias("run"))
    rows.write.partitionBy("run").text(f"{base}/runs")
    return read_diagnostics(spark, f"{base}/runs").groupBy("run_id", "task_id").agg(F.count("*").alias("n"))


@query(
    "diagnostics_scan",
    "SELECT 'run_1' AS run_id, event_type AS task_id, 'TECHNICAL_FAILURE' AS code, 'user ' || user_id AS message, count(*) AS n "
    "FROM events WHERE event_type <> 'click' AND user_id <> 3 AND value >= 1 GROUP BY ALL",
)
def _(spark, sf_dir):
    """Clicks are cut short, user 3 belongs to another run, small values lack a message."""
    events = read(spark, sf_dir, "events")
    whole = F.to_json(
        F.struct(
            F.when(F.col("user_id") == 3, "run_2").otherwise("run_1").alias("run_id"),
            F.col("event_type").alias("task_id"),
            F.lit("TECHNICAL_FAILURE").alias("code"),
            F.when(F.col("value") >= 1, F.concat(F.lit("user "), "user_id")).alias("message"),
        )
    )
    payload = F.when(F.col("event_type") == "click", F.substring(whole, 1, 20)).otherwise(whole)
    found = parse_diagnostics(events.select(payload.alias("payload"), F.lit("run_1").alias("expected_run")))
    return found.groupBy("run_id", "task_id", "code", "message").agg(F.count("*").alias("n"))


# Commit history: each order is a commit of the table named by its priority.
HISTORY = """SELECT o_orderpriority AS table_name,
    concat(strftime(o_orderdate, '%Y%m%d'), '_', lpad(o_custkey::VARCHAR, 8, '0')) AS run_id,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('before_', o_custkey) END AS previous_run_id,
    o_orderdate AS updated_at FROM orders"""


def history(spark, sf_dir):
    run_id = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"))
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("table_name"),
        run_id.alias("run_id"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("before_"), "o_custkey")).alias("previous_run_id"),
        F.col("o_orderdate").alias("updated_at"),
    )


LATEST = f"""h AS ({HISTORY}), p AS (SELECT table_name, run_id, previous_run_id, updated_at FROM (SELECT *, row_number() OVER (
    PARTITION BY table_name ORDER BY updated_at DESC, run_id DESC, previous_run_id DESC NULLS LAST) AS rn FROM h) WHERE rn = 1)"""


@query("latest_pointer", f"WITH {LATEST} SELECT * FROM p")
def _(spark, sf_dir):
    return latest_pointers(history(spark, sf_dir))


COMMITS = "SELECT c_mktsegment AS table_name, max(c_name) AS run_id, TIMESTAMP '2030-01-01' AS updated_at FROM customer GROUP BY ALL"


@query(
    "pointer_previous",
    f"WITH {LATEST}, c AS (SELECT table_name, 'new_' || count(*) AS run_id, TIMESTAMP '2030-01-01' AS updated_at FROM h GROUP BY ALL "
    "UNION ALL SELECT c_mktsegment, max(c_name), TIMESTAMP '2030-01-01' FROM customer GROUP BY ALL) "
    "SELECT c.table_name, c.run_id, p.run_id AS previous_run_id, c.updated_at FROM c LEFT JOIN p USING (table_name)",
)
def _(spark, sf_dir):
    """A new commit for every known table and for tables never published before."""
    past = history(spark, sf_dir)
    moment = F.lit("2030-01-01").cast("timestamp_ntz").alias("updated_at")
    known = past.groupBy("table_name").agg(F.concat(F.lit("new_"), F.count("*")).alias("run_id")).select("*", moment)
    fresh = read(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("table_name")).agg(F.max("c_name").alias("run_id"))
    return next_pointers(past, known.unionByName(fresh.select("*", moment)))


@query("latest_table_data", "SELECT o_orderkey, o_totalprice + 3 AS o_totalprice FROM orders")
def _(spark, sf_dir):
    """Three runs stage the same table with other prices; readers follow the pointer to the last."""
    base = shared_folder(spark, "catalogue")
    orders = read(spark, sf_dir, "orders")
    for day in (1, 2, 3):
        layout = RunLayout(base, f"2025010{day}_000000_0000000{day}")
        stage_table(orders.select("o_orderkey", (F.col("o_totalprice") + day).alias("o_totalprice")), layout.table_data("orders"))
        commit_pointers(spark, layout, ["orders"], datetime(2025, 1, day))
    return latest_table(spark, base, "orders")


@query("list_runs", f"WITH h AS ({HISTORY}) SELECT DISTINCT run_id FROM h")
def _(spark, sf_dir):
    return list_runs(history(spark, sf_dir))


@query("protected_runs", f"WITH {LATEST} SELECT DISTINCT run_id FROM p")
def _(spark, sf_dir):
    return protected_runs(latest_pointers(history(spark, sf_dir)))


KEEP = 50


@query(
    "retention_select",
    f"""WITH {LATEST}, e AS (SELECT DISTINCT run_id FROM h), k AS (SELECT run_id FROM e WHERE run_id IN (SELECT run_id FROM p)),
    f AS (SELECT run_id, row_number() OVER (ORDER BY run_id DESC) AS rn FROM e WHERE run_id NOT IN (SELECT run_id FROM k))
    SELECT run_id FROM f WHERE rn > greatest({KEEP} - (SELECT count(*) FROM k), 0)""",
)
def _(spark, sf_dir):
    past = history(spark, sf_dir)
    return runs_to_remove(past, latest_pointers(past), KEEP)
