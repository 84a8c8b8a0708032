from datetime import date, datetime

import pytest

from tests.helpers import AS_OF, col, ref, specs, table
from twinloom.errors import SpecError, UnsatisfiableError
from twinloom.plans.contract import engine_columns, read_contract
from twinloom.plans.spec import Choice, Pattern, Span, Text, read_tables
from twinloom.plans.types import LogicalType as T
from twinloom.plans.types import WriteMode


def one(kind, output=None, rows=10, **constraints):
    return specs(table("t", rows, col("v", kind, output, **constraints)))[0].columns[0]


def derive(source, rule="YYYY", output="INT", **more):
    return {"name": "x", "output_data_type": output, "derive": {"source_column": source, "rule": rule}, **more}


def test_names_are_lower_cased_but_tables_keep_their_case():
    tables = specs(table("Tab", 3, col(" INN ", "int"), ref("Copy", "Tab2", "iNN")), table("Tab2", 3, col("Inn", "INT")))
    assert tables[0].name == "Tab" and [c.name for c in tables[0].columns] == ["inn", "copy"]
    with pytest.raises(SpecError, match="missing table"):
        specs(table("a", 1, ref("x", "B", "y")), table("b", 1, col("y", "INT")))


def test_defaults():
    assert one("INT").domain == Span(0, 1000, "number")
    assert one("FLOAT").domain == Span(0, 100_000, "decimal", 2)
    days = one("DATE").domain
    assert days.capacity == 365 and days.low == (date(2025, 1, 1) - date(1970, 1, 1)).days
    times = one("TIMESTAMP").domain
    assert times.origin == datetime(2025, 1, 1) and times.high == 365 * 86_400 - 1
    assert one("STRING").domain.length == 10 and len(one("STRING").domain.pool) == 52
    assert one("BOOLEAN").domain == Choice((True, False))


def test_unique_defaults_grow_with_the_table():
    assert one("INT", rows=5000, unique=True, min_value=10).domain.high == 5009
    assert one("INT", rows=50, is_unique=True).domain.high == 1000
    assert one("INT", rows=5000, unique=True, max_value=1200).domain.high == 1200
    assert one("FLOAT", rows=200_000, unique=True).domain.high == 199_999
    assert one("DATE", rows=1000, unique=True).domain.capacity == 1000
    assert one("TIMESTAMP", rows=40_000_000, unique=True).domain.capacity == 40_000_000
    with pytest.raises(UnsatisfiableError):
        one("DATE", rows=10_000_000, unique=True)


def test_types_and_formats():
    assert one("DATE_STRING").source is T.DATE and one("TIMESTAMP_STRING").output is T.TIMESTAMP
    assert one("DATE", date_format="%Y").output is T.STRING
    assert one("TIMESTAMP", timestamp_format="%Y").output is T.STRING
    assert one("DATE", "INT", date_format="%Y%m%d").output is T.INT
    legacy = read_tables([table("t", 1, {"name": "a", "gen_data_type": "int"})], AS_OF)[0].columns[0]
    assert legacy.source is T.INT


def test_string_options():
    assert one("STRING", uppercase=True).domain.pool.isupper()
    assert one("STRING", digits_only=True, length=3).domain == Span(100, 999, "digits")
    assert one("STRING", digits_only=True, length=1).domain == Span(0, 9, "digits")
    assert one("STRING", regular_expr="^[A-Z]{4}$", length=9).domain == Text("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 4)
    assert one("STRING", regular_expr="[A-Z]{4}", case_mode="lower").domain == Pattern("[A-Z]{4}", "lower")
    assert one("STRING", allowed_values=["b", 1, "b"]).domain == Choice(("b", "1"))
    assert one("INT", allowed_values=[1, 1, 2]).domain == Choice((1, 1, 2))


@pytest.mark.parametrize(
    "kind, output, constraints",
    [
        ("INT", None, {"min_value": 5, "max_value": 4}),
        ("INT", None, {"min_value": 1.5}),
        ("INT", None, {"max_value": 2**63}),
        ("INT", None, {"digits_count": 0}),
        ("INT", None, {"digits_count": True}),
        ("INT", None, {"digits_count": 3, "min_value": 1}),
        ("INT", None, {"digits_count": 3, "allowed_values": [1]}),
        ("INT", None, {"allowed_values": "123"}),
        ("INT", None, {"allowed_values": ["x"]}),
        ("INT", None, {"null_ratio": 1.1}),
        ("INT", None, {"null_ratio": True}),
        ("INT", None, {"is_unique": 1}),
        ("INT", "DATE", {}),
        ("INT", "BOOLEAN", {"unique": True}),
        ("FLOAT", "INT", {"unique": True}),
        ("TIMESTAMP", "DATE", {"unique": True}),
        ("FLOAT", None, {"precision": -1}),
        ("FLOAT", None, {"min_value": "a"}),
        ("FLOAT", "BOOLEAN", {}),
        ("STRING", "DATE", {}),
        ("STRING", None, {"length": 0}),
        ("STRING", None, {"case_mode": "title"}),
        ("STRING", None, {"character_set": "emoji"}),
        ("STRING", None, {"regular_expr": " "}),
        ("DATE", None, {"min_value": "soon"}),
        ("DATE", None, {"min_value": "2025-02-01", "max_value": "2025-01-01"}),
        ("DATE", "INT", {"date_format": "%Y-%m"}),
        ("DATE", None, {"date_format": "%Q"}),
        ("DATE", "BOOLEAN", {}),
        ("BOOLEAN", None, {"allowed_values": ["yes"]}),
        ("MONEY", None, {}),
    ],
)
def test_bad_columns(kind, output, constraints):
    with pytest.raises(SpecError):
        one(kind, output, **constraints)


@pytest.mark.parametrize(
    "tables",
    [
        [],
        [table("", 1, col("a", "INT"))],
        [table("t", 0, col("a", "INT"))],
        [table("t", True, col("a", "INT"))],
        [table("t", 1)],
        [table("t", 1, col("a", "INT"), col("A ", "INT"))],
        [table("t", 1, col("a", "INT")), table("t", 1, col("a", "INT"))],
        [table("t", 1, ref("a", "t", "b"), ref("b", "t", "a"))],
        [table("t", 1, col("a", "INT"), ref("b", "t", "a", unique=True))],
        [table("t", 1, col("a", "INT"), ref("b", "t", "a", "MANY"))],
        [table("t", 1, col("a", "INT"), derive("a"))],
        [table("t", 1, col("a", "DATE"), derive("a", rule="DD"))],
        [table("t", 1, col("a", "DATE"), derive("a", output="DATE"))],
        [table("t", 1, col("a", "DATE"), derive("a", constraints={"null_ratio": 0.1}))],
        [table("t", 1, col("a", "DATE"), derive("nothing"))],
        [table("t", 1, col("a", "DATE"), derive("a"), {**derive("x"), "name": "y"})],
        [table("t", 1, col("a", "DATE"), {**derive("a"), "reference": {"table_name": "t", "column_name": "a"}})],
    ],
)
def test_bad_tables(tables):
    with pytest.raises(SpecError):
        specs(*tables)


def test_all_broken_references_are_reported_together():
    with pytest.raises(SpecError, match=r"a\.x -> nowhere\.y.*a\.z -> a\.gone"):
        specs(table("a", 1, ref("x", "nowhere", "y"), ref("z", "a", "gone")))


def contract(**changes):
    raw_table = table("t", 5, col("Both", "INT"), {**col("H", "INT"), "engine_scope": "hive_only"}, {**col("i", "INT"), "engine_scope": "ICEBERG_ONLY"})
    raw_table |= {"hive_target_table": "h.t", "iceberg_target_table": "i.t", "write_mode": "append"}
    raw_table |= changes.pop("table", {})
    return {"tables": [raw_table], "queries": {"hive_sql": "select 1", "iceberg_sql": "select 1"}} | changes


def test_contract():
    read = read_contract(contract(), AS_OF)
    load = read.loads[0]
    assert load.mode is WriteMode.APPEND and load.targets == {"hive": "h.t", "iceberg": "i.t"}
    assert load.columns == {"hive": ("both", "h"), "iceberg": ("both", "i")}
    assert read.excludes == {"hive": (), "iceberg": ()}


@pytest.mark.parametrize(
    "changes",
    [
        {"queries": None},
        {"queries": {"hive_sql": "select 1"}},
        {"tables": None},
        {"table": {"write_mode": "MERGE"}},
        {"table": {"hive_target_table": " "}},
        {"table": {"columns": [{**col("a", "INT"), "engine_scope": "NONE"}]}},
        {"table": {"columns": [{**col("a", "INT"), "engine_scope": "HIVE_ONLY"}]}},
    ],
)
def test_bad_contracts(changes):
    with pytest.raises(SpecError):
        read_contract(contract(**changes), AS_OF)


def test_engine_columns_keep_declared_order():
    raw = table("t", 1, {"name": "Z"}, {"name": "a", "engine_scope": None}, {"name": "m", "engine_scope": "HIVE_ONLY"})
    assert engine_columns(raw, "hive") == ("z", "a", "m")
