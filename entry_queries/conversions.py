"""Output conversions and derivations over columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.base import local_times, read, use_utc
from twinloom.functions.convert import convert, derive
from twinloom.plans.types import LogicalType as T

QUERIES, ORACLES = {}, {}


def over(name: str, table: str, key: str, sql: str, **columns) -> None:
    """``columns`` map an output name to a function of nothing that returns its expression."""

    def run(spark, sf_dir):
        use_utc(spark)
        cells = [build().alias(alias) for alias, build in columns.items()]
        return local_times(read(spark, sf_dir, table).select(key, *cells))

    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, {sql} FROM {table}"


def conv(value, source: T, target: T, fmt: str | None = None):
    return lambda: convert(value() if callable(value) else F.col(value), source, target, fmt)


PRICE = lambda factor: lambda: F.col("o_totalprice") * F.lit(factor)
DAY = lambda: F.to_date("o_orderdate")
MOMENT = lambda: F.date_trunc("second", F.col("ts").cast("timestamp"))
SECOND = "date_trunc('second', ts)"

over("conv_int_float", "customer", "c_custkey", "c_custkey::DOUBLE AS v", v=conv("c_custkey", T.INT, T.FLOAT))
over("conv_int_string", "lineitem", "l_orderkey", "(l_partkey - 500)::VARCHAR AS v",
     v=conv(lambda: F.col("l_partkey") - 500, T.INT, T.STRING))
over("conv_int_boolean", "customer", "c_custkey", "c_nationkey <> 0 AS v", v=conv("c_nationkey", T.INT, T.BOOLEAN))
over(
    "conv_float_string", "orders", "o_orderkey",
    "o_totalprice::VARCHAR AS plain, (o_totalprice * 1000.0::DOUBLE)::VARCHAR AS large, "
    "(o_totalprice * 1e14::DOUBLE)::VARCHAR AS huge, (o_totalprice * 1e-9::DOUBLE)::VARCHAR AS small, "
    "(o_totalprice * 1e-12::DOUBLE)::VARCHAR AS tiny",
    plain=conv("o_totalprice", T.FLOAT, T.STRING),
    large=conv(PRICE(1000.0), T.FLOAT, T.STRING),
    huge=conv(PRICE(1e14), T.FLOAT, T.STRING),
    small=conv(PRICE(1e-9), T.FLOAT, T.STRING),
    tiny=conv(PRICE(1e-12), T.FLOAT, T.STRING),
)
over("conv_float_int", "customer", "c_custkey", "trunc(c_acctbal)::BIGINT AS v, trunc(-c_acctbal)::BIGINT AS w",
     v=conv("c_acctbal", T.FLOAT, T.INT), w=conv(lambda: -F.col("c_acctbal"), T.FLOAT, T.INT))
over("conv_boolean_string", "customer", "c_custkey", "CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS v",
     v=conv(lambda: F.col("c_acctbal") > 0, T.BOOLEAN, T.STRING))
over("conv_boolean_int", "lineitem", "l_orderkey", "(l_returnflag = 'R')::BIGINT AS v",
     v=conv(lambda: F.col("l_returnflag") == "R", T.BOOLEAN, T.INT))
over("conv_string_int", "customer", "c_custkey", "substr(c_name, 10)::BIGINT AS v",
     v=conv(lambda: F.substring("c_name", 10, 20), T.STRING, T.INT))
over("conv_date_string", "orders", "o_orderkey",
     "strftime(o_orderdate, '%d.%m.%Y') AS v, strftime(o_orderdate, 'week day: %a, %b %d (%j)') AS w",
     v=conv(DAY, T.DATE, T.STRING, "%d.%m.%Y"), w=conv(DAY, T.DATE, T.STRING, "week day: %a, %b %d (%j)"))
over("conv_date_int", "orders", "o_orderkey", "strftime(o_orderdate, '%y%m%d')::BIGINT AS v",
     v=conv(DAY, T.DATE, T.INT, "%y%m%d"))
over("conv_date_ts", "orders", "o_orderkey", "o_orderdate::DATE::TIMESTAMP AS v", v=conv(DAY, T.DATE, T.TIMESTAMP))
over("conv_ts_string", "events", "event_id",
     f"strftime({SECOND}, '%Y-%m-%d %H:%M:%S') AS v, strftime({SECOND}, '%I:%M %p') AS w",
     v=conv(MOMENT, T.TIMESTAMP, T.STRING), w=conv(MOMENT, T.TIMESTAMP, T.STRING, "%I:%M %p"))
over("conv_ts_int", "events", "event_id", f"strftime({SECOND}, '%H%M%S')::BIGINT AS v",
     v=conv(MOMENT, T.TIMESTAMP, T.INT, "%H%M%S"))
over("conv_ts_date", "events", "event_id", "ts::DATE AS v", v=conv(MOMENT, T.TIMESTAMP, T.DATE))

over("derive_yyyymmdd", "orders", "o_orderkey",
     "strftime(o_orderdate, '%Y%m%d') AS s, strftime(o_orderdate, '%Y%m%d')::BIGINT AS i",
     s=lambda: derive(DAY(), "YYYYMMDD", T.STRING), i=lambda: derive(DAY(), "YYYYMMDD", T.INT))
over("derive_yyyy", "orders", "o_orderkey",
     "strftime(o_orderdate, '%Y') AS s, strftime(o_orderdate, '%Y')::BIGINT AS i",
     s=lambda: derive(DAY(), "YYYY", T.STRING), i=lambda: derive(DAY(), "YYYY", T.INT))
over("derive_mm", "lineitem", "l_orderkey",
     "strftime(l_shipdate, '%m') AS s, strftime(l_shipdate, '%m')::BIGINT AS i",
     s=lambda: derive(F.to_date("l_shipdate"), "MM", T.STRING), i=lambda: derive(F.to_date("l_shipdate"), "MM", T.INT))
over("derive_from_ts", "events", "event_id",
     "strftime(ts, '%Y%m%d') AS s, strftime(ts, '%m')::BIGINT AS i",
     s=lambda: derive(MOMENT(), "YYYYMMDD", T.STRING), i=lambda: derive(MOMENT(), "MM", T.INT))
