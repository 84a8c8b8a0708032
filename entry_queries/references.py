"""Foreign keys between generated tables.

The engine evaluates the parent's expression at a drawn parent row (or joins a dense
index); the oracles build the parent table in full and join it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.base import column, derived, read, reference, synthetic
from entry_queries.duck import below, chars, hash_sql, key, pick, rows_of, signed
from entry_queries.generators import LOWER
from twinloom.operators.checks import null_counts, orphan_values

QUERIES, ORACLES = {}, {}


def child_of(name: str, *parents: tuple, child: list[dict], given: str = "orders") -> None:
    tables = {table: (source, columns) for table, source, columns in parents}
    QUERIES[name] = lambda spark, sf_dir: synthetic(spark, sf_dir, **tables, **{name: (given, child)})[name]


def with_parts(*rows, main: str) -> str:
    """CTE chains joined in ``main``, where ``{p}`` stands for the chain with prefix p."""
    for chain in rows:
        main = main.replace(f"{{{chain.prefix}}}", chain.name)
    return f"WITH {', '.join(chain.ctes() for chain in rows)} {main}"


def code_parent(table: str, prefix: str, source: str = "customer", id_column: str = "c_custkey"):
    """A unique ten-digit key: value by rank."""
    rows = rows_of(source, id_column, prefix).permute("pos", table, "code").nulls("0")
    return rows.spread("idx", "9000000000", key(table, "code")).let(val="(1000000000 + idx)::BIGINT")


CODE = column("code", "INT", digits_count=10, is_unique=True)
GROUP = column("grp", "INT", min_value=1, max_value=50, null_ratio=0.2)

# One to many, unique parent.
child_of("ref_one_to_many", ("p_many", "customer", [CODE]), child=[reference("v", "p_many", "code", null_ratio=0.1)])
ORACLES["ref_one_to_many"] = with_parts(
    code_parent("p_many", "p"),
    rows_of("orders", "o_orderkey", "c").permute("pos", "ref_one_to_many", "v").nulls("0.1")
    .let(seat=below("(SELECT count(*) FROM customer)", key("ref_one_to_many", "v"), "id")),
    main="SELECT c.id AS o_orderkey, CASE WHEN c.rank >= 0 THEN p.val END AS v "
    "FROM {c} c JOIN {p} p ON p.rank = c.seat",
)

# One to many, parent with duplicates and NULLs: duplicates keep their weight.
child_of("ref_weighted", ("p_weight", "customer", [GROUP]), child=[reference("v", "p_weight", "grp")])
ORACLES["ref_weighted"] = with_parts(
    rows_of("customer", "c_custkey", "p").permute("pos", "p_weight", "grp").nulls("0.2")
    .let(val=f"(1 + {below(50, key('p_weight', 'grp'), 'id')})::BIGINT"),
    rows_of("orders", "o_orderkey", "c")
    .let(filled="(SELECT count(*) - CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) FROM customer)")
    .let(seat=below("filled", key("ref_weighted", "v"), "id")),
    main="SELECT c.id AS o_orderkey, p.val AS v FROM {c} c JOIN {p} p ON p.rank = c.seat",
)

# One to one with a parent that repeats values: a dense index over the distinct ones.
WIDE = column("code", "INT", min_value=1, max_value=1_000_000_000, null_ratio=0.1)
child_of("ref_one_to_one", ("p_one", "orders", [WIDE]), child=[reference("v", "p_one", "code", "ONE_TO_ONE", null_ratio=0.25)], given="customer")
_INDEX_HASH = signed(hash_sql(key("p_one", "code", "index"), "val"))
ORACLES["ref_one_to_one"] = with_parts(
    rows_of("orders", "o_orderkey", "p").permute("pos", "p_one", "code").nulls("0.1")
    .let(val=f"(1 + {below(1_000_000_000, key('p_one', 'code'), 'id')})::BIGINT"),
    rows_of("customer", "c_custkey", "c").permute("pos", "ref_one_to_one", "v").nulls("0.25"),
    main=(
        ", d0 AS (SELECT DISTINCT val, greatest(1, (filled + 499999) // 500000) AS buckets FROM {p} WHERE rank >= 0), "
        f"d1 AS (SELECT val, buckets, {_INDEX_HASH} AS h FROM d0), "
        "d AS (SELECT val, row_number() OVER (ORDER BY (h % buckets + buckets) % buckets, h, val) - 1 AS position, count(*) OVER () AS total FROM d1), "
        "k0 AS (SELECT id, rank, filled, greatest(rank, 0)::HUGEINT AS r0, (SELECT any_value(total) FROM d)::HUGEINT AS total FROM {c}), "
        "k1 AS (SELECT *, r0 * total // filled AS lo, (r0 + 1) * total // filled AS hi FROM k0), "
        f"k AS (SELECT id, rank, lo + {below('hi - lo', key('ref_one_to_one', 'v', 'stratum'), 'r0')} AS seat FROM k1) "
        "SELECT k.id AS c_custkey, CASE WHEN k.rank >= 0 THEN d.val END AS v FROM k JOIN d ON d.position = k.seat"
    ),
)

# One to one with a unique parent: no join on the Spark side.
child_of("ref_one_to_one_unique", ("p_uniq", "orders", [CODE]), child=[reference("v", "p_uniq", "code", "ONE_TO_ONE", null_ratio=0.1)], given="customer")
ORACLES["ref_one_to_one_unique"] = with_parts(
    code_parent("p_uniq", "p", "orders", "o_orderkey"),
    rows_of("customer", "c_custkey", "c").permute("pos", "ref_one_to_one_unique", "v").nulls("0.1")
    .spread("seat", "(SELECT count(*) FROM orders)", key("ref_one_to_one_unique", "v", "stratum")),
    main="SELECT c.id AS c_custkey, CASE WHEN c.rank >= 0 THEN p.val END AS v FROM {c} c JOIN {p} p ON p.rank = c.seat",
)

# A chain: orders -> customer -> supplier, each drawing from the one above.
child_of(
    "ref_chain",
    ("g_top", "supplier", [CODE]),
    ("g_mid", "customer", [reference("code", "g_top", "code", null_ratio=0.3)]),
    child=[reference("v", "g_mid", "code")],
)
ORACLES["ref_chain"] = with_parts(
    code_parent("g_top", "p", "supplier", "s_suppkey"),
    rows_of("customer", "c_custkey", "m").permute("pos", "g_mid", "code").nulls("0.3")
    .let(seat=below("(SELECT count(*) FROM supplier)", key("g_mid", "code"), "id")),
    rows_of("orders", "o_orderkey", "c")
    .let(filled="(SELECT count(*) - CAST(floor(count(*) * 0.3::DOUBLE) AS BIGINT) FROM customer)")
    .let(seat=below("filled", key("ref_chain", "v"), "id")),
    main="SELECT c.id AS o_orderkey, p.val AS v FROM {c} c JOIN {m} m ON m.rank = c.seat JOIN {p} p ON p.rank = m.seat",
)

# A reference to a derived column shares the source's rows and NULLs.
DAY = column("d", "DATE", min_value="2021-01-01", max_value="2023-12-31", null_ratio=0.1)
child_of(
    "ref_to_derived",
    ("p_day", "customer", [DAY, derived("ymd", "d", "YYYYMMDD", "INT")]),
    child=[reference("v", "p_day", "ymd")],
)
ORACLES["ref_to_derived"] = with_parts(
    rows_of("customer", "c_custkey", "p").permute("pos", "p_day", "d").nulls("0.1")
    .let(day=f"DATE '2021-01-01' + {below(1095, key('p_day', 'd'), 'id')}::INT"),
    rows_of("orders", "o_orderkey", "c")
    .let(filled="(SELECT count(*) - CAST(floor(count(*) * 0.1::DOUBLE) AS BIGINT) FROM customer)")
    .let(seat=below("filled", key("ref_to_derived", "v"), "id")),
    main="SELECT c.id AS o_orderkey, strftime(p.day, '%Y%m%d')::BIGINT AS v FROM {c} c JOIN {p} p ON p.rank = c.seat",
)

# A chain of whole tables: stations, some of which have one sensor each, and the readings of sensors.
STATIONS = [
    column("altitude", "FLOAT", min_value=-20, max_value=2500, precision=1),
    column("opened", "DATE", min_value="2001-01-01", max_value="2009-12-31", null_ratio=0.05),
    derived("opened_year", "opened", "YYYY", "STRING"),
    column("station", "STRING", unique=True, length=7, case_mode="upper"),
]
SENSORS = [
    column("in_use", "BOOLEAN"),
    reference("station", "stations", "station", "ONE_TO_ONE"),
    column("model", "STRING", allowed_values=["wind", "rain", "heat"]),
]
READINGS = [
    reference("station", "sensors", "station"),
    column("taken", "TIMESTAMP", min_timestamp="2024-02-28 12:00:00", max_timestamp="2024-03-01 19:33:20"),
    derived("month", "taken", "MM", "INT"),
    column("celsius", "FLOAT", min_value=-30, max_value=45, null_ratio=0.02),
]
CHAIN = {"stations": ("customer", STATIONS), "sensors": ("supplier", SENSORS), "readings": ("orders", READINGS)}


def _two_tables(spark, sf_dir):
    frames = synthetic(spark, sf_dir, **CHAIN)
    stations, sensors = frames["stations"].drop("c_custkey"), frames["sensors"].drop("s_suppkey")
    return frames["readings"].join(sensors, "station").join(stations, "station")


QUERIES["gen_two_tables"] = _two_tables


def _two_tables_sql() -> str:
    def k(table, name, purpose="value"):
        return key(table, name, purpose)

    def grid(low: int, high: int, scale: str, stream: int) -> str:
        """A rounded uniform number: the ends of the grid have half the weight."""
        return f"({low} + ({below(2 * (high - low), stream, 'id')} + 1) // 2)::BIGINT::DOUBLE / {scale}::DOUBLE"

    stations = rows_of("customer", "c_custkey", "p").permute("pos", "stations", "station").nulls("0")
    stations.spread("idx", str(26**7), k("stations", "station")).let(
        station=chars("idx", LOWER.upper(), 7), altitude=grid(-200, 25_000, "10.0", k("stations", "altitude"))
    )
    opened = rows_of("customer", "c_custkey", "o").permute("pos", "stations", "opened").nulls("0.05")
    opened.let(day=f"CASE WHEN rank >= 0 THEN (DATE '2001-01-01' + {below(3287, k('stations', 'opened'), 'id')}::INT)::DATE END")
    sensors = rows_of("supplier", "s_suppkey", "m").permute("pos", "sensors", "station").nulls("0")
    sensors.spread("seat", "(SELECT count(*) FROM customer)", k("sensors", "station", "stratum")).let(
        in_use=pick(["true", "false"], k("sensors", "in_use"), "id"),
        model=pick(["'wind'", "'rain'", "'heat'"], k("sensors", "model"), "id"),
    )
    readings = rows_of("orders", "o_orderkey", "c").permute("pos", "readings", "celsius").nulls("0.02").let(
        seat=below("(SELECT count(*) FROM supplier)", k("readings", "station"), "id"),
        taken=f"TIMESTAMP '2024-02-28 12:00:00' + to_seconds({below(200_001, k('readings', 'taken'), 'id')}::BIGINT)",
        degrees=grid(-3000, 4500, "100.0", k("readings", "celsius")),
    )
    return with_parts(
        stations,
        opened,
        sensors,
        readings,
        main="SELECT c.id AS o_orderkey, p.station, c.taken, strftime(c.taken, '%m')::BIGINT AS month, "
        "CASE WHEN c.rank >= 0 THEN c.degrees END AS celsius, m.in_use, m.model, p.altitude, o.day AS opened, "
        "strftime(o.day, '%Y') AS opened_year "
        "FROM {c} c JOIN {m} m ON m.rank = c.seat JOIN {p} p ON p.rank = m.seat JOIN {o} o ON o.id = p.id",
    )


ORACLES["gen_two_tables"] = _two_tables_sql()


# Integrity: a generated child has no orphans, and the checker finds those of real tables.
def _integrity(spark, sf_dir):
    frames = synthetic(
        spark, sf_dir, p_int=("customer", [CODE]), c_int=("orders", [reference("v", "p_int", "code", null_ratio=0.1)])
    )
    child = frames["c_int"]
    orphans = orphan_values(child, "v", frames["p_int"], "code").agg(F.count("*").alias("n")).select(F.lit("orphans").alias("what"), "n")
    counted = null_counts(child.select("v"))
    return counted.selectExpr("stack(2, 'rows', n_rows, 'nulls', v) AS (what, n)").unionByName(orphans)


QUERIES["ref_integrity"] = _integrity
ORACLES["ref_integrity"] = (
    "SELECT 'rows' AS what, count(*) AS n FROM orders UNION ALL "
    "SELECT 'nulls', CAST(floor(count(*) * 0.1::DOUBLE) AS BIGINT) FROM orders UNION ALL SELECT 'orphans', 0"
)
QUERIES["ref_orphans"] = lambda spark, sf_dir: orphan_values(
    read(spark, sf_dir, "lineitem"), "l_orderkey", read(spark, sf_dir, "customer"), "c_custkey"
)
ORACLES["ref_orphans"] = (
    "SELECT l_orderkey AS orphan, count(*) AS n_rows FROM lineitem "
    "WHERE l_orderkey NOT IN (SELECT c_custkey FROM customer) GROUP BY ALL"
)
