"""Projection, alignment, staging, the write modes, and user SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as st

from entry_queries.base import column, local_times, read, synthetic, use_utc
from entry_queries.generators import ORACLES as GENERATOR_ORACLES
from twinloom.operators.align import align_to_schema, select_load_columns, strict_casts
from twinloom.plans.contract import engine_columns
from twinloom.session import shared_folder
from twinloom.sinks.artifacts import materialize_query, stage_query, stage_table
from twinloom.sinks.targets import TableLoad, load_table, write_target
from twinloom.sources.tables import is_partitioned, read_staged
from twinloom.sources.texts import query_from_text

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str):
    def register(run):
        def with_utc(spark, sf_dir):
            use_utc(spark)
            return local_times(run(spark, sf_dir))

        QUERIES[name], ORACLES[name] = with_utc, sql
        return run

    return register


@query("scan_staged", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'")
def _(spark, sf_dir):
    rows = read_staged(spark, f"{sf_dir}/lineitem.parquet")
    return rows.where("l_shipdate >= timestamp_ntz'1998-01-01'").select("l_orderkey", "l_quantity")


SCOPED = {
    "table_name": "customer",
    "columns": [
        {"name": "C_CUSTKEY"},
        {"name": "c_name", "engine_scope": "HIVE_ONLY"},
        {"name": "c_acctbal", "engine_scope": "iceberg_only"},
        {"name": "c_mktsegment", "engine_scope": "ALL"},
    ],
}


@query("scope_hive", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf_dir):
    return select_load_columns(read(spark, sf_dir, "customer"), engine_columns(SCOPED, "hive"))


@query("scope_iceberg", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def _(spark, sf_dir):
    return select_load_columns(read(spark, sf_dir, "customer"), engine_columns(SCOPED, "iceberg"))


@query("load_select", 'SELECT l_shipdate AS "L_ShipDate", l_orderkey AS "L_ORDERKEY" FROM lineitem')
def _(spark, sf_dir):
    return select_load_columns(read(spark, sf_dir, "lineitem"), ["L_ShipDate", "L_ORDERKEY"])


WIDE = st.StructType(
    [
        st.StructField("O_OrderKey", st.StringType()),
        st.StructField("o_custkey", st.IntegerType()),
        st.StructField("o_totalprice", st.DecimalType(18, 1)),
        st.StructField("o_orderdate", st.DateType()),
        st.StructField("o_orderpriority", st.StringType()),
    ]
)


@query(
    "align_cast",
    'SELECT o_orderkey::VARCHAR AS "O_OrderKey", o_custkey::INT AS o_custkey, '
    "round(o_totalprice::VARCHAR::DECIMAL(38, 18), 1)::DECIMAL(18, 1)::VARCHAR AS o_totalprice, "
    "o_orderdate::DATE AS o_orderdate, o_orderpriority FROM orders",
)
def _(spark, sf_dir):
    with strict_casts(spark):
        aligned = align_to_schema(read(spark, sf_dir, "orders").drop("o_orderstatus"), WIDE)
    return aligned.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))


@query(
    "align_null_fill",
    "SELECT o_orderkey, NULL::VARCHAR AS note, NULL::BIGINT AS amount, NULL::DATE AS day FROM orders",
)
def _(spark, sf_dir):
    schema = st.StructType.fromDDL("o_orderkey bigint, note string, amount bigint, day date")
    return align_to_schema(read(spark, sf_dir, "orders").select("o_orderkey"), schema)


TECHNICAL = {
    "a_byte": ("tinyint", "1::TINYINT"),
    "a_short": ("smallint", "1::SMALLINT"),
    "an_int": ("int", "1::INT"),
    "a_long": ("bigint", "1::BIGINT"),
    "a_float": ("float", "0.1::FLOAT::DOUBLE"),
    "a_double": ("double", "0.1::DOUBLE"),
    "a_decimal": ("decimal(10,2)", "'0.10'"),
    "a_coarse_decimal": ("decimal(10,0)", "'0'"),
    "a_string": ("string", "'N/A'"),
    "a_flag": ("boolean", "false"),
    "a_day": ("date", "DATE '2040-01-01'"),
    "a_time": ("timestamp", "TIMESTAMP '2040-01-01 23:59:59'"),
    "a_local_time": ("timestamp_ntz", "TIMESTAMP '2040-01-01 23:59:59'"),
}


@query("align_tech_fill", f"SELECT c_custkey, {', '.join(f'{sql} AS {n}' for n, (_, sql) in TECHNICAL.items())} FROM customer")
def _(spark, sf_dir):
    fields = ", ".join(f"{name} {kind} NOT NULL" for name, (kind, _) in TECHNICAL.items())
    schema = st.StructType.fromDDL(f"c_custkey bigint, {fields}")
    filled = align_to_schema(read(spark, sf_dir, "customer").select("c_custkey"), schema)
    for name in ("a_decimal", "a_coarse_decimal"):
        filled = filled.withColumn(name, F.col(name).cast("string"))
    return filled.withColumn("a_float", F.col("a_float").cast("double"))


@query("align_strict_ok", "SELECT substr(c_name, 10)::INT AS code FROM customer")
def _(spark, sf_dir):
    codes = read(spark, sf_dir, "customer").select(F.substring("c_name", 10, 20).alias("code"))
    with strict_casts(spark):
        return align_to_schema(codes, st.StructType.fromDDL("code int"))


def new_table(spark, columns: str, partitioned_by: str = "") -> str:
    name = f"twinloom_{uuid.uuid4().hex}"
    place = shared_folder(spark, "table")
    parts = f"PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET {parts} LOCATION '{place}'")
    return name


def contents(spark, name: str):
    """The rows of a table, which itself is dropped: its files stay where they were put."""
    schema = spark.table(name).schema
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(place).select(schema.fieldNames())


def orders_target(spark, sf_dir, partitioned: bool = True) -> str:
    """A table that already holds all orders."""
    columns = "o_orderkey bigint, o_totalprice double, o_orderstatus string"
    name = new_table(spark, columns, "o_orderstatus" if partitioned else "")
    write_target(order_rows(spark, sf_dir), name, "APPEND")
    return name


def order_rows(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


def doubled(spark, sf_dir, status: str | None = "F"):
    """New content for the orders of one status, which is what an overwrite tells apart, or for all."""
    rows = order_rows(spark, sf_dir)
    rows = rows if status is None else rows.where(F.col("o_orderstatus") == status)
    return rows.withColumn("o_totalprice", F.col("o_totalprice") * 2)


BASE_SQL = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders"
DOUBLED_SQL = "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'"


@query(
    "partitioned_check",
    "SELECT o_orderstatus, count(*) AS n_rows, true AS partitioned, false AS flat_partitioned FROM orders GROUP BY ALL",
)
def _(spark, sf_dir):
    parted, flat = orders_target(spark, sf_dir), orders_target(spark, sf_dir, partitioned=False)
    marks = is_partitioned(spark, parted), is_partitioned(spark, flat)
    spark.sql(f"DROP TABLE {flat}")
    counts = contents(spark, parted).groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))
    return counts.select("*", F.lit(marks[0]).alias("partitioned"), F.lit(marks[1]).alias("flat_partitioned"))


def sink_query(name: str, mode: str, sql: str, partitioned: bool = True, status: str | None = "F"):
    @query(name, sql)
    def _(spark, sf_dir):
        target = orders_target(spark, sf_dir, partitioned)
        write_target(doubled(spark, sf_dir, status), target, mode)
        return contents(spark, target)


sink_query("sink_append", "APPEND", f"{BASE_SQL} UNION ALL {DOUBLED_SQL.partition(' WHERE')[0]}", status=None)
sink_query("sink_overwrite_table", "OVERWRITE_TABLE", DOUBLED_SQL)
sink_query("sink_overwrite_flat_table", "OVERWRITE_TABLE", DOUBLED_SQL, partitioned=False)
sink_query(
    "sink_overwrite_partitions", "OVERWRITE_PARTITIONS", f"{BASE_SQL} WHERE o_orderstatus <> 'F' UNION ALL {DOUBLED_SQL}"
)


@query("stage_roundtrip", GENERATOR_ORACLES["null_exact"])
def _(spark, sf_dir):
    spec = column("v", "INT", min_value=0, max_value=9, null_ratio=0.29)
    frame = synthetic(spark, sf_dir, null_exact=("orders", [spec]))["null_exact"]
    uri = shared_folder(spark, "staged")
    stage_table(frame, uri)
    return read_staged(spark, uri)


@query(
    "load_end_to_end",
    "SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS note, o_orderpriority FROM orders",
)
def _(spark, sf_dir):
    target = new_table(
        spark, "O_ORDERKEY bigint, o_totalprice double, note string, o_orderpriority string", "o_orderpriority"
    )
    columns = ("o_orderpriority", "o_orderkey", "o_totalprice")
    load_table(spark, TableLoad(f"{sf_dir}/orders.parquet", target, "OVERWRITE_PARTITIONS", columns))
    return contents(spark, target).withColumnRenamed("O_ORDERKEY", "o_orderkey")


SQL_TEXTS = {
    "sql_join_agg": """
        SELECT n.n_name, c.c_mktsegment, count(*) AS n_orders,
               CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS VARCHAR(40)) AS revenue
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name, c.c_mktsegment""",
    "sql_window": """
        SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth,
               max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS best_so_far
        FROM orders""",
    "sql_topk": """
        SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber LIMIT 100""",
}


def with_views(spark, sf_dir):
    """A session of its own with the tables as views, so that the caller's views stay."""
    session = spark.newSession()
    for table in ("orders", "customer", "nation", "lineitem"):
        read(session, sf_dir, table).createOrReplaceTempView(table)
    return session


def sql_query(name: str, text: str):
    @query(name, text)
    def _(spark, sf_dir):
        spark = with_views(spark, sf_dir)
        uri = shared_folder(spark, "query")
        stage_query(spark, text, uri)
        return query_from_text(spark, uri)


for _name, _text in SQL_TEXTS.items():
    sql_query(_name, _text)


@query("sql_materialize", SQL_TEXTS["sql_join_agg"])
def _(spark, sf_dir):
    spark = with_views(spark, sf_dir)
    text_uri, result_uri = shared_folder(spark, "query"), shared_folder(spark, "result")
    stage_query(spark, SQL_TEXTS["sql_join_agg"], text_uri)
    materialize_query(spark, text_uri, result_uri)
    return read_staged(spark, result_uri)
