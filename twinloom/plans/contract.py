"""The whole input: tables, where they are loaded, and the two queries to reconcile."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from twinloom.errors import SpecError
from twinloom.plans.spec import Fields, Table, read_tables
from twinloom.plans.types import EngineScope, WriteMode

ENGINES = ("hive", "iceberg")


@dataclass(frozen=True)
class LoadPlan:
    table: Table
    mode: WriteMode
    targets: dict[str, str]
    columns: dict[str, tuple[str, ...]]


@dataclass(frozen=True)
class Contract:
    loads: tuple[LoadPlan, ...]
    queries: dict[str, str]
    excludes: dict[str, tuple[str, ...]]

    @property
    def tables(self) -> tuple[Table, ...]:
        return tuple(load.table for load in self.loads)


def engine_columns(raw_table: Mapping, engine: str) -> tuple[str, ...]:
    """The columns whose scope includes the engine, in declared order."""
    table = Fields(raw_table, "Table")
    wanted = {EngineScope.ALL, EngineScope[f"{engine.upper()}_ONLY"]}
    columns = [Fields(raw, f"Column of {table.text('table_name')}") for raw in table.objects("columns")]
    chosen = tuple(c.name("name") for c in columns if _scope(c) in wanted)
    if not chosen:
        raise SpecError(f"Table {table.text('table_name')} has no columns for {engine}")
    return chosen


def _scope(column: Fields) -> EngineScope:
    return column.one_of("engine_scope", EngineScope) if column.get("engine_scope") else EngineScope.ALL


def read_contract(raw: Mapping, as_of: date) -> Contract:
    contract = Fields(raw, "Contract")
    if contract.get("queries") is None:
        raise SpecError("Contract queries must be an object")
    queries = contract.child("queries")
    raw_tables = contract.objects("tables")
    loads = []
    for table, raw_table in zip(read_tables(raw_tables, as_of), raw_tables):
        fields = Fields(raw_table, f"Table {table.name}")
        loads.append(
            LoadPlan(
                table,
                fields.one_of("write_mode", WriteMode),
                {engine: fields.text(f"{engine}_target_table") for engine in ENGINES},
                {engine: engine_columns(raw_table, engine) for engine in ENGINES},
            )
        )
    return Contract(
        tuple(loads),
        {engine: queries.text(f"{engine}_sql") for engine in ENGINES},
        {engine: tuple(queries.get(f"{engine}_exclude_columns") or ()) for engine in ENGINES},
    )
