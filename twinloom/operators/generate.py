"""Distributed generation of related tables.

A cell is a pure function of (seed, table, column, row id), evaluated over
``spark.range``: no shuffle, no state, same result for any partitioning or retry. NULL
positions come from an exact permutation of the row ids; its dense non-null ranks also
drive unique values. A foreign key re-evaluates the parent's expression at a drawn parent
row, so it needs no join; only a one-to-one reference to a column that may repeat does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import replace
from datetime import datetime
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinloom.errors import SpecError, UnsatisfiableError
from twinloom.functions import convert as cv
from twinloom.functions.doubles import GridDoubles
from twinloom.functions.draws import bigint, draw_below, draw_unit, pick, stream_key
from twinloom.functions.ordering import MAX_SPACE, Permutation, spread_index
from twinloom.functions.pattern import pattern_text
from twinloom.functions.stages import Stages, Term, combine
from twinloom.functions.text import distinct_text, encode_index, random_text
from twinloom.operators.align import strict_casts
from twinloom.operators.checks import repeating_columns
from twinloom.operators.indexing import DenseIndex, dense_index
from twinloom.plans.spec import (
    Choice,
    Column,
    DerivedColumn,
    GeneratedColumn,
    Listed,
    Real,
    ReferenceColumn,
    Span,
    Table,
    Text,
)
from twinloom.plans.types import Cardinality
from twinloom.plans.types import LogicalType as T
from twinloom.sinks.pools import Pools

ROW_ID = "row_id"
ROWS_PER_TASK = 5_000_000
_SINGLE_ZONE = {"UTC", "ETC/UTC", "GMT", "Z", "+00:00"}
_EXACT_DOUBLE = 1 << 53


def dependency_order(tables: Iterable[Table]) -> list[Table]:
    """Parents before children; all faulty references are named at once, a cycle of tables is an error."""
    by_name = {table.name: table for table in tables}
    links = [(t, c) for t in by_name.values() for c in t.columns if isinstance(c, ReferenceColumn)]
    outputs = {(t.name, c.name): c.output.value for t in by_name.values() for c in t.columns}
    faults = []
    for table, column in links:
        target = column.parent_table, column.parent_column
        found = outputs.get(target, "missing")
        if found != column.output.value:
            faults.append(f"{table.name}.{column.name} needs {column.output.value} at {'.'.join(target)}, which is {found}")
    if faults:
        raise SpecError("Invalid references: " + "; ".join(faults))
    order = TopologicalSorter({name: [c.parent_table for t, c in links if t.name == name] for name in by_name})
    try:
        return [by_name[name] for name in order.static_order()]
    except CycleError as error:
        raise SpecError(f"A cycle of references leaves no first table: {' -> '.join(error.args[1])}") from error


def generate_tables(
    spark: SparkSession,
    tables: Iterable[Table],
    seed: int = 0,
    rows: Mapping[str, DataFrame] | None = None,
    verify: bool = True,
    lists: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """One DataFrame per table, in dependency order, columns in declared order.

    ``rows`` may supply the rows of a table instead of ``spark.range``: a DataFrame whose
    ``row_id`` column numbers them 0..n-1. Its other columns are kept in front.
    ``lists`` supplies the lists of values that columns name in ``allowed_from``: DataFrames of one
    column, of any length. ``verify`` runs the duplicate check for unique columns whose output
    conversion could merge values; provably unique columns cost nothing.

    The frames are lazy, so the value pools that some of them read stay in the shared folder;
    ``tables_in_turn`` removes them.
    """
    generator = Generator(spark, tables, seed, rows, lists)
    return {table.name: generator.checked_frame(table, verify) for table in generator.ordered}


def tables_in_turn(
    spark: SparkSession,
    tables: Iterable[Table],
    seed: int = 0,
    rows: Mapping[str, DataFrame] | None = None,
    verify: bool = True,
    lists: Mapping[str, DataFrame] | None = None,
) -> Iterator[tuple[str, DataFrame]]:
    """The same tables one after the other, each to be written before the next is asked for.

    A value pool is removed as soon as no later table draws from it.
    """
    generator = Generator(spark, tables, seed, rows, lists)
    try:
        for table in generator.ordered:
            yield table.name, generator.checked_frame(table, verify)
            generator.finish(table)
    finally:
        generator.pools.close()


def generate_table(
    spark: SparkSession, table: Table, seed: int = 0, rows: DataFrame | None = None, verify: bool = True
) -> DataFrame:
    supplied = {} if rows is None else {table.name: rows}
    return generate_tables(spark, [table], seed, supplied, verify)[table.name]


class Generator:
    def __init__(
        self,
        spark: SparkSession,
        tables: Iterable[Table],
        seed: int,
        rows: Mapping[str, DataFrame] | None,
        lists: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self._spark = spark
        self._seed = seed
        self._rows = dict(rows or {})
        self._lists = dict(lists or {})
        self.ordered = dependency_order(tables)
        self._tables = {table.name: table for table in self.ordered}
        self._columns = {(t.name, c.name): c for t in self.ordered for c in t.columns}
        self._dense: set[str] = set()
        self.pools = Pools(spark)
        self._check_time_zone()
        for table in self.ordered:
            for column in table.columns:
                self._check_capacity(table, column)
        for table in self.ordered:
            for column in table.columns:
                if self._joins(column):
                    self._expect(self._pool_key(table, column))

    # --- what can be known before any job runs -------------------------------------------

    def _check_time_zone(self) -> None:
        uses_time = any(
            T.TIMESTAMP in (c.output, getattr(c, "source", None)) for c in self._columns.values()
        )
        zone = self._spark.conf.get("spark.sql.session.timeZone")
        if uses_time and zone.upper() not in _SINGLE_ZONE:
            raise SpecError(f"Timestamps are generated in UTC; set spark.sql.session.timeZone (now {zone})")

    def _check_capacity(self, table: Table, column: Column) -> None:
        needed = table.rows - table.null_count(column)
        if isinstance(column, GeneratedColumn) and isinstance(column.domain, Listed):
            if column.domain.name not in self._lists:
                raise SpecError(f"{table.name}.{column.name}: no list {column.domain.name!r} is supplied")
            if len(self._lists[column.domain.name].columns) != 1:
                raise SpecError(f"{table.name}.{column.name}: the list {column.domain.name!r} needs one column")
        elif isinstance(column, GeneratedColumn) and column.unique and column.domain.capacity < needed:
            raise UnsatisfiableError(
                f"{table.name}.{column.name} needs {needed} unique values, only {column.domain.capacity} exist"
            )
        if isinstance(column, ReferenceColumn) and needed:
            parent, source = self._parent(column)
            available = parent.rows - parent.null_count(source)
            one_to_one = column.cardinality is Cardinality.ONE_TO_ONE
            if not available or (one_to_one and needed > available):
                raise UnsatisfiableError(
                    f"{table.name}.{column.name} needs {needed} parent values, only {available} exist"
                )

    def _parent(self, column: ReferenceColumn) -> tuple[Table, Column]:
        return self._tables[column.parent_table], self._columns[column.parent_table, column.parent_column]

    def _distinct_by_construction(self, column: Column) -> bool:
        if isinstance(column, ReferenceColumn):
            return column.cardinality is Cardinality.ONE_TO_ONE
        return column.unique

    def _ranked(self, table: Table, column: Column) -> bool:
        """Whether the value is a function of the non-null rank rather than of the row id."""
        if isinstance(column, DerivedColumn):
            column = table.column(column.source_column)
        return self._distinct_by_construction(column)

    def _joins(self, column: Column) -> bool:
        """Whether the value must be looked up, because no expression of the row gives it."""
        if not isinstance(column, ReferenceColumn):
            return isinstance(getattr(column, "domain", None), Listed)
        _, parent = self._parent(column)
        repeats = column.cardinality is Cardinality.ONE_TO_ONE and not self._distinct_by_construction(parent)
        return repeats or self._joins(parent)

    def _key(self, table: Table, column: Column, purpose: str) -> int:
        return stream_key(self._seed, table.name, column.name, purpose)

    def _order(self, table: Table, column: Column) -> Permutation:
        if isinstance(column, DerivedColumn):
            column = table.column(column.source_column)
        return Permutation(table.rows, self._seed, table.name, column.name)

    # --- building frames -----------------------------------------------------------------

    def row_frame(self, table: Table) -> DataFrame:
        supplied = self._rows.get(table.name)
        if supplied is not None:
            return self._checked_rows(table, supplied)
        tasks = max(self._spark.sparkContext.defaultParallelism, -(-table.rows // ROWS_PER_TASK))
        return self._spark.range(0, table.rows, 1, tasks).withColumnRenamed("id", ROW_ID)

    def _checked_rows(self, table: Table, supplied: DataFrame) -> DataFrame:
        """The supplied rows, once it is known that they are numbered 0..n-1 and as many as declared."""
        if table.name not in self._dense:
            n = F.col(ROW_ID)
            seen = supplied.agg(F.count("*"), F.count_distinct(n), F.min(n), F.max(n)).first()
            dense = (table.rows, table.rows, 0, table.rows - 1) if table.rows else (0, 0, None, None)
            if tuple(seen) != dense:
                raise SpecError(
                    f"Rows of {table.name} must have the {ROW_ID} values 0..{table.rows - 1}, each once; "
                    f"found {seen[0]} rows, {seen[1]} values from {seen[2]} to {seen[3]}"
                )
            self._dense.add(table.name)
        return supplied

    def frame(self, table: Table) -> DataFrame:
        rows = self.row_frame(table)
        kept = [name for name in rows.columns if name != ROW_ID]
        return self._build(table, rows, table.columns).select(*kept, *(c.name for c in table.columns))

    def _build(
        self, table: Table, rows: DataFrame, columns: Iterable[Column], with_rank: Column | None = None
    ) -> DataFrame:
        writer = _RowWriter(self, table)
        row = Term(F.col(ROW_ID), 0)
        outputs, lookups = [], []
        for column in columns:
            if self._joins(column):
                pool, key = self._lookup(writer, table, column, row)
                lookups.append((column, pool))
                outputs.append(key.column.alias(f"__key_{column.name}"))
            else:
                value = writer.value(column, row)
                outputs.append(value.column.alias(column.name))
        if with_rank is not None:
            outputs.append(writer.rank(with_rank, row).column.alias("__rank"))
        kept = [F.col(name) for name in rows.columns if name != ROW_ID]
        frame = writer.stages.apply(rows).select(*kept, *outputs)
        for column, pool in lookups:
            frame = pool.look_up(frame, f"__key_{column.name}", column.name)
        return frame

    def _lookup(self, writer: "_RowWriter", table: Table, column: Column, row: Term) -> tuple[DenseIndex, Term]:
        """The pool that the column draws from, and the position each row takes there.

        Rows that stay NULL get distinct negative positions that match nothing, so they
        spread over the join partitions instead of meeting under one NULL key.
        """
        needed = table.rows - table.null_count(column)
        rank = writer.rank(column, row)
        pool = self._pool(self._pool_key(table, column))
        if self._distinct_by_construction(column):
            if needed > pool.count:
                raise UnsatisfiableError(
                    f"{table.name}.{column.name} needs {needed} distinct values, only {pool.count} exist"
                )
            if not needed:
                return pool, rank
            purpose = "stratum" if isinstance(column, ReferenceColumn) else "value"
            seat = combine(lambda r: F.greatest(r, bigint(0)), rank)
            position = combine(lambda r: spread_index(r, needed, pool.count, self._key(table, column, purpose), r), seat)
        else:
            if needed and not pool.count:
                raise UnsatisfiableError(f"{table.name}.{column.name} needs {needed} values, none exist")
            count = max(1, pool.count)
            position = combine(lambda r: draw_below(count, self._key(table, column, "value"), r), row)
        return pool, combine(lambda r, p: F.when(r >= 0, p).otherwise(r), rank, position)

    # --- value pools ---------------------------------------------------------------------

    def _pool_key(self, table: Table, column: Column) -> tuple:
        """What the column draws from: a supplied list, a parent's distinct values, or its values by rank."""
        if isinstance(column, GeneratedColumn):
            weighted = column.domain.weighted and not column.unique
            return "list", column.domain.name, column.source, column.output, column.fmt, weighted
        parent, source = self._parent(column)
        one_to_one = column.cardinality is Cardinality.ONE_TO_ONE
        kind = "distinct" if one_to_one and not self._distinct_by_construction(source) else "ranks"
        return kind, parent.name, source.name

    def _inner(self, key: tuple) -> tuple | None:
        """The pool that building this one reads."""
        if key[0] == "list":
            return None
        table = self._tables[key[1]]
        column = table.column(key[2])
        return self._pool_key(table, column) if self._joins(column) else None

    def _expect(self, key: tuple) -> None:
        """Count a use of a pool and, at the first one, those of what it is built from."""
        if not self.pools.expected(key) and (inner := self._inner(key)):
            self._expect(inner)
        self.pools.expect(key)

    def finish(self, table: Table) -> None:
        """The table has been written: its columns no longer need their pools."""
        for column in table.columns:
            if self._joins(column):
                self.pools.release(self._pool_key(table, column))

    def _pool(self, key: tuple) -> DenseIndex:
        def build(folder: str) -> DenseIndex:
            built = getattr(self, f"_build_{key[0]}")(folder, *key[1:])
            if inner := self._inner(key):
                self.pools.release(inner)
            return built

        return self.pools.get(key, build)

    def _build_ranks(self, folder: str, table_name: str, column_name: str) -> DenseIndex:
        table = self._tables[table_name]
        column = table.column(column_name)
        frame = self._build(table, self.row_frame(table).select(ROW_ID), [column], with_rank=column)
        ranked = frame.where(F.col("__rank") >= 0).select(F.col("__rank").alias("position"), F.col(column.name).alias("value"))
        ranked.write.parquet(folder)
        return DenseIndex(self._spark.read.schema(ranked.schema).parquet(folder), table.rows - table.null_count(column))

    def _build_distinct(self, folder: str, table_name: str, column_name: str) -> DenseIndex:
        table = self._tables[table_name]
        column = table.column(column_name)
        values = self._build(table, self.row_frame(table).select(ROW_ID), [column])
        at_most = table.rows - table.null_count(column)
        return dense_index(values, at_most, self._key(table, column, "index"), folder)

    def _build_list(self, folder: str, name: str, source: T, output: T, fmt: str | None, weighted: bool) -> DenseIndex:
        """Positions of the list's values, and what each is converted to."""
        given = self._lists[name]
        with strict_casts(self._spark):
            values = given.select(F.col(f"`{given.columns[0]}`").cast(source.spark_type).alias("value"))
            index = dense_index(values, values.count(), stream_key(self._seed, "list", name), folder, weighted)
        return replace(index, spans=index.spans.withColumn("value", cv.convert(F.col("value"), source, output, fmt)))

    # --- the final uniqueness check ------------------------------------------------------

    def checked_frame(self, table: Table, verify: bool) -> DataFrame:
        with strict_casts(self._spark):
            frame = self.frame(table)
        if verify:
            self.verify(table, frame)
        return frame

    def verify(self, table: Table, frame: DataFrame) -> None:
        """One pass over the rows for all columns whose conversion could merge values."""
        doubtful = [
            c.name for c in table.columns if isinstance(c, GeneratedColumn) and c.unique and not _stays_unique(c)
        ]
        if repeated := repeating_columns(frame.select(doubtful), doubtful):
            raise UnsatisfiableError(
                f"{table.name}.{', '.join(repeated)} must be unique, but the output conversion repeats values"
            )


def _stays_unique(column: GeneratedColumn) -> bool:
    if cv.is_injective(column.source, column.output, column.fmt):
        return True
    domain = column.domain
    if isinstance(domain, Listed):
        return False
    if column.source is T.INT and column.output is T.FLOAT:
        bounds = (domain.low, domain.high) if isinstance(domain, Span) else domain.values
        return max(map(abs, bounds)) <= _EXACT_DOUBLE
    return column.source is T.STRING and isinstance(domain, Span)


class _RowWriter:
    """Writes the expressions of one select over the rows of a table."""

    def __init__(self, generator: Generator, table: Table) -> None:
        self._gen = generator
        self._table = table
        self.stages = Stages()
        self._ranks: dict[str, Term] = {}
        self._sources: dict[tuple, Term] = {}

    def rank(self, column: Column, row: Term) -> Term:
        """The dense non-null rank of the row; negative where the column is NULL."""
        name = getattr(column, "source_column", column.name)
        nulls = self._table.null_count(column)
        if not nulls and not self._gen._ranked(self._table, column):
            return row
        if name not in self._ranks:
            position = self._gen._order(self._table, column).forward(self.stages, row)
            rank = combine(lambda p: p - bigint(nulls), position) if nulls else position
            self._ranks[name] = self.stages.let(rank) if nulls else rank
        return self._ranks[name]

    def value(self, column: Column, row: Term) -> Term:
        nulls = self._table.null_count(column)
        if nulls == self._table.rows:
            return Term(F.lit(None).cast(column.output.spark_type), 0)
        rank = self.rank(column, row)
        seat = row
        if self._gen._ranked(self._table, column):
            seat = combine(lambda r: F.greatest(r, bigint(0)), rank) if nulls else rank
        present = self._present(self._table, column, seat)
        if not nulls:
            return present
        return combine(lambda r, v: F.when(r >= 0, v), rank, present)

    def _present(self, table: Table, column: Column, seat: Term) -> Term:
        """The non-null value at a seat: the rank of a ranked column, else the row id."""
        if isinstance(column, ReferenceColumn):
            return self._referenced(table, column, seat)
        if isinstance(column, DerivedColumn):
            source = table.column(column.source_column)
            return combine(lambda v: cv.derive(v, column.rule, column.output), self._source(table, source, seat))
        value = self._source(table, column, seat)
        return combine(lambda v: cv.convert(v, column.source, column.output, column.fmt), value)

    def _referenced(self, table: Table, column: ReferenceColumn, seat: Term) -> Term:
        parent, source = self._gen._parent(column)
        nulls = parent.null_count(source)
        count = parent.rows - nulls
        if column.cardinality is Cardinality.ONE_TO_ONE:
            needed = table.rows - table.null_count(column)
            key = self._gen._key(table, column, "stratum")
            position = combine(lambda r: spread_index(r, needed, count, key, r), seat)
        else:
            key = self._gen._key(table, column, "value")
            position = combine(lambda r: draw_below(count, key, r), seat)
        if nulls and not self._gen._ranked(parent, source):
            shifted = combine(lambda p: p + bigint(nulls), position)
            position = self._gen._order(parent, source).backward(self.stages, shifted)
        else:
            position = self.stages.let(position)
        return self._present(parent, source, position)

    def _source(self, table: Table, column: GeneratedColumn, seat: Term) -> Term:
        if any(getattr(c, "source_column", None) == column.name for c in table.columns):
            # Shared with derived columns: evaluate once.
            key = (table.name, column.name, seat.depth, str(seat.column))
            if key not in self._sources:
                self._sources[key] = self.stages.let(self._draw_source(table, column, seat))
            return self._sources[key]
        return self._draw_source(table, column, seat)

    def _draw_source(self, table: Table, column: GeneratedColumn, seat: Term) -> Term:
        key, domain = self._gen._key(table, column, "value"), column.domain
        needed = table.rows - table.null_count(column)

        def distinct(space: int) -> Term:
            return combine(lambda r: spread_index(r, needed, space, key, r), seat)

        if isinstance(domain, Choice):
            values = [F.lit(v).cast(column.source.spark_type) for v in domain.values]
            if not column.unique:
                return combine(lambda s: pick(values, key, s), seat)
            options = [F.lit(v).cast(column.source.spark_type) for v in dict.fromkeys(domain.values)]
            return combine(lambda i: F.get(F.array(*options), i.cast("int")), distinct(len(options)))
        if isinstance(domain, Span):
            offset = distinct(domain.capacity) if column.unique else _span_offset(domain, key, seat)
            return combine(lambda o: _render_span(domain, o), offset)
        if isinstance(domain, Real):
            return combine(lambda s: _real(domain, draw_unit(key, s)), seat)
        if isinstance(domain, Text):
            return self._text(domain, column.unique, key, seat, distinct)
        text = pattern_text(self.stages, domain.regex, key, seat, domain.most)
        change = {"lower": F.lower, "upper": F.upper}.get(domain.case, lambda c: c)
        return combine(change, text)

    def _text(self, domain: Text, unique: bool, key: int, seat: Term, distinct) -> Term:
        if unique:
            if domain.capacity < MAX_SPACE:
                index = self.stages.let(distinct(domain.capacity))
                return combine(lambda v: F.concat(*encode_index(v, domain.pool, domain.length)), index)
            return distinct_text(self.stages, domain.pool, domain.length, domain.lead, key, seat)
        length = domain.length - (domain.lead is not None)
        text = random_text(self.stages, domain.pool, length, key, seat)
        if domain.lead is None:
            return text
        lead = random_text(self.stages, domain.lead, 1, key ^ (1 << 59), seat)
        return combine(lambda a, b: F.concat(a, b), lead, text)


def _span_offset(domain: Span, key: int, seat: Term) -> Term:
    steps = domain.high - domain.low
    if domain.unit == "decimal" and steps:
        # A uniform real rounded to the grid reaches each end half as often as other points.
        halves = combine(lambda s: draw_below(2 * steps, key, s), seat)
        return combine(lambda h: F.call_function("div", h + F.lit(1), F.lit(2)), halves)
    return combine(lambda s: draw_below(domain.capacity, key, s), seat)


def _real(domain: Real, unit: SparkColumn) -> SparkColumn:
    # Uniform over the range, not over the doubles in it, which lie closer near zero. Weighting the two ends avoids an overflow when the range spans most doubles.
    value = F.lit(domain.low) * (F.lit(1.0) - unit) + F.lit(domain.high) * unit
    return F.round(value, domain.precision)


def _render_span(domain: Span, offset: SparkColumn) -> SparkColumn:
    if domain.unit == "second":
        start = (domain.origin - datetime(1970, 1, 1)) // _MICROSECOND
        return F.timestamp_micros(offset.cast("bigint") * bigint(1_000_000) + bigint(start))
    low = domain.low
    if domain.unit == "double":
        rank = (F.lit(str(low)).cast("decimal(38,0)") + offset).cast("bigint")
        return GridDoubles(domain.precision).column(rank, low, domain.high)
    wide = low < -(1 << 62) or domain.high - low >= MAX_SPACE
    number = (F.lit(str(low)).cast("decimal(38,0)") + offset if wide else bigint(low) + offset).cast("bigint")
    if domain.unit == "decimal":
        value = number.cast("double")
        return value / F.lit(float(10**domain.precision)) if domain.precision else value
    if domain.unit == "day":
        return F.date_from_unix_date(number.cast("int"))
    return number.cast("string") if domain.unit == "digits" else number


_MICROSECOND = datetime.resolution
