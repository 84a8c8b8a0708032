"""Comparison of ``lineitem`` with a changed copy, and of typed columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.base import read, use_utc
from twinloom.operators.align import strict_casts
from twinloom.operators.audit import audit_reports, parse_reports
from twinloom.operators.compare import (
    TECHNICAL_COLUMNS,
    compare,
    comparison_columns,
    difference_metrics,
    exclusive_rows,
    normalize,
    report_frame,
    unbalanced_rows,
    with_verdict,
)

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str):
    def register(run):
        def with_utc(spark, sf_dir):
            use_utc(spark)
            return run(spark, sf_dir)

        QUERIES[name], ORACLES[name] = with_utc, sql
        return run

    return register


# The changed copy loses, repeats, changes and blanks rows.
CHANGED = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN l_shipdate < TIMESTAMP '1995-03-01' THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
           l_extendedprice, l_discount, CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN NULL ELSE l_tax END AS l_tax,
           l_returnflag, l_linestatus
    FROM {0} WHERE l_linenumber <> 7
    UNION ALL
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus
    FROM {0} WHERE l_linenumber = 1 AND l_returnflag = 'R'"""
ORIGINAL = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus FROM {0}"""


def sides(spark, sf_dir):
    lineitem = read(spark, sf_dir, "lineitem")
    changed = CHANGED.format("{rows}").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return spark.sql(ORIGINAL.format("{rows}"), rows=lineitem), spark.sql(changed, rows=lineitem)


def as_doubles(frame):
    """Decimals back to doubles for output; every value here has at most two decimals."""
    return frame.select(
        *(F.col(n).cast("double").alias(n) if kind.startswith("decimal") else F.col(n) for n, kind in frame.dtypes)
    )


def bigints(sql: str) -> str:
    return f"SELECT * REPLACE (l_linenumber::BIGINT AS l_linenumber) FROM ({sql})"


LEFT, RIGHT = bigints(ORIGINAL.format("lineitem")), bigints(CHANGED.format("lineitem"))
PARTS = f"WITH a AS ({LEFT}), b AS ({RIGHT})"
LEFT_ONLY, RIGHT_ONLY = "(SELECT * FROM a EXCEPT ALL SELECT * FROM b)", "(SELECT * FROM b EXCEPT ALL SELECT * FROM a)"


@query("cmp_except_all_left", f"{PARTS} SELECT * FROM {LEFT_ONLY}")
def _(spark, sf_dir):
    return as_doubles(exclusive_rows(*sides(spark, sf_dir)))


@query("cmp_except_all_right", f"{PARTS} SELECT * FROM {RIGHT_ONLY}")
def _(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return as_doubles(exclusive_rows(right, left))


@query(
    "cmp_bag_diff_one_pass",
    f"{PARTS}, u AS (SELECT *, 1 AS l, 0 AS r FROM a UNION ALL SELECT *, 0, 1 FROM b) "
    "SELECT * EXCLUDE (l, r), sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows FROM u "
    "GROUP BY ALL HAVING sum(l) <> sum(r)",
)
def _(spark, sf_dir):
    return as_doubles(unbalanced_rows(*sides(spark, sf_dir)))


COUNTS = f"""{PARTS}, m AS (SELECT (SELECT count(*) FROM a) AS left_count, (SELECT count(*) FROM b) AS right_count,
    (SELECT count(*) FROM {LEFT_ONLY}) AS left_exclusive, (SELECT count(*) FROM {RIGHT_ONLY}) AS right_exclusive)"""
VERDICT = """SELECT *, abs(left_count - right_count) AS count_delta,
    round(left_exclusive / left_count, 6) AS left_ratio, round(right_exclusive / right_count, 6) AS right_ratio,
    CASE WHEN left_exclusive = 0 AND right_exclusive = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM m"""


@query("cmp_counts", f"{COUNTS} SELECT * FROM m")
def _(spark, sf_dir):
    return difference_metrics(*sides(spark, sf_dir))


@query("cmp_metrics", f"{COUNTS} {VERDICT}")
def _(spark, sf_dir):
    return with_verdict(difference_metrics(*sides(spark, sf_dir)))


@query(
    "cmp_report",
    f"{COUNTS}, v AS ({VERDICT}) SELECT 'run' AS run_id, status, left_count AS hive_rows, right_count AS iceberg_rows, "
    "count_delta, left_exclusive AS hive_only, right_exclusive AS iceberg_only, left_ratio AS hive_ratio, "
    "right_ratio AS iceberg_ratio, 'load_part' AS hive_excluded, 'job_insert_id,l_comment' AS iceberg_excluded, "
    "'' AS temporal_excluded FROM v",
)
def _(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    left = left.withColumn("load_part", F.lit(1))
    right = right.withColumn("JOB_INSERT_ID", F.lit("x")).withColumn("l_comment", F.lit("y"))
    columns, verdict = compare(left, right, right_excludes=["L_COMMENT"])
    report = report_frame(columns, verdict, "run", "2025-06-30T00:00:00+00:00", "left", "right")
    summary = F.col("summary")
    joined = {side: F.lower(F.array_join(F.col(f"excluded_columns.{side}"), ",")) for side in ("hive", "iceberg", "temporal")}
    return report.select(
        "run_id",
        "status",
        summary["row_count"]["hive"].alias("hive_rows"),
        summary["row_count"]["iceberg"].alias("iceberg_rows"),
        summary["row_count_delta"].alias("count_delta"),
        summary["exclusive_row_count"]["hive"].alias("hive_only"),
        summary["exclusive_row_count"]["iceberg"].alias("iceberg_only"),
        summary["exclusive_row_ratio"]["hive"].alias("hive_ratio"),
        summary["exclusive_row_ratio"]["iceberg"].alias("iceberg_ratio"),
        *(text.alias(f"{side}_excluded") for side, text in joined.items()),
    )


# Which columns are compared: the kept columns are returned with their data.
@query("cmp_excludes", "SELECT o_orderkey, o_custkey FROM orders")
def _(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    left = orders.withColumn("Date_Part", F.lit(1))
    right = orders.withColumn("sys_update_stamp", F.lit(2))
    excludes = {side: (*names, "O_ORDERPRIORITY") for side, names in TECHNICAL_COLUMNS.items()}
    columns = comparison_columns(left.schema, right.schema, excludes["hive"], excludes["iceberg"])
    return left.select(*columns.compared)


@query("cmp_temporal", "SELECT o_orderkey, o_totalprice::VARCHAR::DECIMAL(38, 18)::DOUBLE AS o_totalprice FROM orders")
def _(spark, sf_dir):
    left = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    right = left.withColumn("o_orderdate", F.col("o_orderdate").cast("string")).withColumn(
        "o_orderstatus", F.current_date()
    )
    columns = comparison_columns(left.schema, right.schema)
    return as_doubles(normalize(left, columns.compared))


def typed_match(name: str, table: str, left_sql: str, right_sql: str) -> None:
    """Two spellings of the same values must be equal after normalisation."""

    @query(name, f"SELECT count(*) AS left_count, count(*) AS right_count, 0::BIGINT AS left_exclusive, 0::BIGINT AS right_exclusive FROM {table}")
    def _(spark, sf_dir):
        rows = read(spark, sf_dir, table)
        left, right = rows.selectExpr(left_sql), rows.selectExpr(right_sql)
        return difference_metrics(left, right)


typed_match("cmp_norm_int", "lineitem", "cast(l_linenumber AS tinyint) AS v", "cast(l_linenumber AS bigint) AS v")
typed_match("cmp_norm_boolean", "lineitem", "l_returnflag = 'R' AS v", "string(l_returnflag = 'R') AS v")


@query(
    "cmp_norm_decimal",
    "SELECT l_orderkey, l_partkey, (l_discount::VARCHAR::DECIMAL(38, 18))::VARCHAR AS from_double, "
    "(l_discount::FLOAT::DOUBLE::VARCHAR::DECIMAL(38, 18))::VARCHAR AS from_float, "
    "(l_discount::DECIMAL(4, 2)::DECIMAL(38, 18))::VARCHAR AS from_decimal FROM lineitem",
)
def _(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        F.col("l_discount").alias("from_double"),
        F.col("l_discount").cast("float").alias("from_float"),
        F.col("l_discount").cast("decimal(4,2)").alias("from_decimal"),
        F.col("l_orderkey"),
        F.col("l_partkey"),
    )
    text = normalize(rows, rows.columns)
    with strict_casts(spark):  # its decimal text has no exponent
        return text.select(*(F.col(n).cast("string").alias(n) if n.startswith("from") else n for n in text.columns))


SHIPPED = "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem"
DELAYED = (
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 10 THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END AS l_shipdate "
    "FROM lineitem"
)


@query(
    "cmp_report_temporal",
    f"WITH a AS ({SHIPPED}), b AS ({DELAYED}) SELECT 'MISMATCH' AS status, (SELECT count(*) FROM a) AS hive_rows, "
    "(SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) AS hive_only, (SELECT count(*) FROM (FROM b EXCEPT ALL FROM a)) AS iceberg_only, "
    "3::BIGINT AS n_compared, false AS counts_only",
)
def _(spark, sf_dir):
    """Dates on both sides, compared because they are asked for."""
    left = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    later = F.when(F.col("l_quantity") < 10, F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("l_shipdate"))
    return stored_report(left.drop("l_quantity"), left.withColumn("l_shipdate", later).drop("l_quantity"), compare_temporal=True)


@query(
    "cmp_no_columns",
    "SELECT 'MATCH' AS status, count(*) AS hive_rows, 0::BIGINT AS hive_only, 0::BIGINT AS iceberg_only, "
    "0::BIGINT AS n_compared, true AS counts_only FROM lineitem",
)
def _(spark, sf_dir):
    """Nothing but different dates: equal counts are all there is, and the stored report says so."""
    left = read(spark, sf_dir, "lineitem").select("l_shipdate")
    return stored_report(left, left.select((F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("l_shipdate")))


def stored_report(left, right, **options):
    """What is left of a comparison after its report has been written and read."""
    columns, verdict = compare(left, right, **options)
    report = report_frame(columns, verdict, "run", "2025-06-30T00:00:00+00:00", "left", "right")
    text = report.select(F.to_json(F.struct(*report.columns)).alias("payload"))
    return audit_reports(parse_reports(text)).select(
        "status",
        F.col("summary.row_count.hive").alias("hive_rows"),
        F.col("summary.exclusive_row_count.hive").alias("hive_only"),
        F.col("summary.exclusive_row_count.iceberg").alias("iceberg_only"),
        F.size("compared_columns").cast("bigint").alias("n_compared"),
        "counts_only",
    )
