"""What a synthetic table looks like: typed, validated, and free of data.

Every generated column is reduced to a few value domains. Dates, timestamps, fixed
precision floats and digit strings are all integer spans that differ only in how the
integer is rendered, so ranges, uniqueness and capacity checks are written once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from typing import Any

from dateutil.parser import parse as parse_moment
from pyspark.sql import types as st

from twinloom.errors import SpecError, UnsatisfiableError
from twinloom.functions.convert import DERIVATIONS, check_conversion
from twinloom.functions.doubles import GridDoubles
from twinloom.functions.pattern import UNBOUNDED_REPEAT, read_pattern, single_class
from twinloom.plans.types import Cardinality
from twinloom.plans.types import LogicalType as T

# Defaults of the input contract.
INT_RANGE = (0, 1000)
FLOAT_RANGE = (0.0, 1000.0)
FLOAT_PRECISION = 2
STRING_LENGTH = 10
DATE_FORMAT = "%Y-%m-%d"
TIMESTAMP_FORMAT = "%Y-%m-%d %H:%M:%S"
TYPE_ALIASES = {"DATE_STRING": "DATE", "TIMESTAMP_STRING": "TIMESTAMP"}
CASE_MODES = ("lower", "upper", "mixed")
CHARACTER_SETS = ("digits", "letters", "alphanumeric")

LETTERS = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "mixed": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
}
DIGITS = "0123456789"

_EPOCH_DAY = date(1970, 1, 1)
_EPOCH = datetime(1970, 1, 1)
_INT64 = (-(1 << 63), (1 << 63) - 1)


@dataclass(frozen=True)
class Choice:
    """A value from a list; repeated values carry weight."""

    values: tuple

    @property
    def capacity(self) -> int:
        return len(dict.fromkeys(self.values))


@dataclass(frozen=True)
class Listed:
    """A value of a list that is supplied as a table; repeated values carry weight if ``weighted``."""

    name: str
    weighted: bool


@dataclass(frozen=True)
class Span:
    """An integer of a closed range. ``unit`` says what one step stands for.

    ``number`` and ``digits`` use the integer itself, ``decimal`` divides it by ten to
    the ``precision``, ``double`` numbers the doubles that such quotients become, ``day``
    counts from the epoch and ``second`` from ``origin``.
    """

    low: int
    high: int
    unit: str
    precision: int = 0
    origin: datetime | None = None

    @property
    def capacity(self) -> int:
        return self.high - self.low + 1


@dataclass(frozen=True)
class Real:
    """A rounded real number of a closed range whose decimal grid is finer than doubles are."""

    low: float
    high: float
    precision: int


@dataclass(frozen=True)
class Text:
    """A string of fixed length over a character pool; the first character may be restricted."""

    pool: str
    length: int
    lead: str | None = None

    @property
    def capacity(self) -> int:
        return len(self.lead or self.pool) * len(self.pool) ** (self.length - 1)


@dataclass(frozen=True)
class Pattern:
    """A string that matches a regular expression, then changed to the given case.

    A repeat without an upper limit stops at ``most``, the constraint ``max_repeat``.
    """

    regex: str
    case: str
    most: int = UNBOUNDED_REPEAT


@dataclass(frozen=True)
class GeneratedColumn:
    name: str
    source: T
    output: T
    domain: Choice | Listed | Span | Real | Text | Pattern
    null_ratio: float = 0.0
    unique: bool = False
    fmt: str | None = None


@dataclass(frozen=True)
class ReferenceColumn:
    name: str
    output: T
    parent_table: str
    parent_column: str
    cardinality: Cardinality
    null_ratio: float = 0.0
    unique: bool = False


@dataclass(frozen=True)
class DerivedColumn:
    name: str
    output: T
    source_column: str
    rule: str
    null_ratio: float = 0.0
    unique: bool = False


Column = GeneratedColumn | ReferenceColumn | DerivedColumn


@dataclass(frozen=True)
class Table:
    name: str
    rows: int
    columns: tuple[Column, ...]

    def __post_init__(self) -> None:
        if self.rows <= 0:
            raise SpecError(f"Table {self.name} needs a positive number of rows")
        if not self.columns:
            raise SpecError(f"Table {self.name} needs at least one column")
        names = [column.name for column in self.columns]
        if repeated := sorted({name for name in names if names.count(name) > 1}):
            raise SpecError(f"Table {self.name} repeats columns {', '.join(repeated)}")

    @property
    def schema(self) -> st.StructType:
        """Output types; a column is nullable when it may hold NULLs."""
        return st.StructType(
            [st.StructField(c.name, c.output.spark_type, c.null_ratio > 0) for c in self.columns]
        )

    def column(self, name: str) -> Column:
        return next(column for column in self.columns if column.name == name)

    def null_count(self, column: Column) -> int:
        """The exact number of NULLs: the floating product, truncated."""
        return int(self.rows * column.null_ratio)


class Fields:
    """Typed access to one raw mapping; every complaint names the place it came from."""

    def __init__(self, raw: Any, place: str) -> None:
        if not isinstance(raw, Mapping):
            raise SpecError(f"{place} must be an object")
        self.raw, self.place = raw, place

    def get(self, name: str) -> Any:
        return self.raw.get(name)

    def text(self, *names: str) -> str:
        """The first of the alternative fields that is present, as non-blank text."""
        value = next((self.raw[n] for n in names if self.raw.get(n) is not None), None)
        if not isinstance(value, str) or not value.strip():
            raise SpecError(f"{self.place}: {names[0]} must be a non-empty string")
        return value

    def name(self, field: str) -> str:
        return self.text(field).strip().lower()

    def one_of(self, field: str, options, default=None):
        if self.raw.get(field) is None and default is not None:
            return default
        value = self.text(field)
        for option in options:
            if value.upper() == getattr(option, "value", option).upper():
                return option
        raise SpecError(f"{self.place}: unsupported {field} {value!r}")

    def integer(self, field: str, default: int | None = None) -> int:
        value = self.raw.get(field)
        value = default if value is None else value
        if isinstance(value, bool) or not isinstance(value, int):
            raise SpecError(f"{self.place}: {field} must be an integer")
        return value

    def number(self, field: str, default: float) -> float:
        value = self.raw.get(field)
        value = default if value is None else value
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            raise SpecError(f"{self.place}: {field} must be a number")
        return float(value)

    def flag(self, *names: str) -> bool:
        value = next((self.raw[n] for n in names if self.raw.get(n) is not None), False)
        if not isinstance(value, bool):
            raise SpecError(f"{self.place}: {names[0]} must be true or false")
        return value

    def ratio(self, field: str) -> float:
        value = self.number(field, 0.0)
        if not 0 <= value <= 1:
            raise SpecError(f"{self.place}: {field} must be inside [0, 1]")
        return value

    def moment(self, field: str, value: Any) -> datetime:
        if isinstance(value, str):
            try:
                value = parse_moment(value)
            except (ValueError, OverflowError) as error:
                raise SpecError(f"{self.place}: invalid {field} {value!r}") from error
        if isinstance(value, date) and not isinstance(value, datetime):
            value = datetime(value.year, value.month, value.day)
        if not isinstance(value, datetime):
            raise SpecError(f"{self.place}: invalid {field} {value!r}")
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        return value

    def objects(self, field: str) -> list[Mapping]:
        value = self.raw.get(field)
        if not isinstance(value, list) or not all(isinstance(item, Mapping) for item in value):
            raise SpecError(f"{self.place}: {field} must be a list of objects")
        return value

    def child(self, field: str) -> "Fields":
        value = self.raw.get(field)
        return Fields({} if value is None else value, f"{self.place} {field}")


def read_tables(raw_tables: Sequence[Mapping], as_of: date) -> tuple[Table, ...]:
    """Validate raw table descriptions; ``as_of`` fixes the default date ranges."""
    return _Reader(raw_tables, as_of).tables()


class _Reader:
    def __init__(self, raw_tables: Sequence[Mapping], as_of: date) -> None:
        self._as_of = as_of
        self._rows: dict[str, int] = {}
        self._raw: dict[tuple[str, str], Fields] = {}
        self._done: dict[tuple[str, str], Column] = {}
        for raw in raw_tables:
            table = Fields(raw, "Table")
            name = table.text("table_name")
            if name in self._rows:
                raise SpecError(f"Table {name} is described twice")
            table.place = f"Table {name}"
            self._rows[name] = table.integer("total_rows")
            for raw_column in table.objects("columns"):
                column = Fields(raw_column, f"Column of {name}")
                key = (name, column.name("name"))
                if key in self._raw:
                    raise SpecError(f"Column {name}.{key[1]} is described twice (names ignore case)")
                column.place = f"Column {name}.{key[1]}"
                self._raw[key] = column
        if not self._rows:
            raise SpecError("At least one table is needed")
        self._check_links()

    def _check_links(self) -> None:
        """Report every reference to a missing table or column at once."""
        broken = []
        for (table, name), fields in self._raw.items():
            link = fields.child("reference")
            if not link.raw:
                continue
            parent = (link.text("table_name"), link.name("column_name"))
            if parent not in self._raw:
                missing = "table" if parent[0] not in self._rows else "column"
                broken.append(f"{table}.{name} -> {'.'.join(parent)} (missing {missing})")
        if broken:
            raise SpecError("Invalid references: " + "; ".join(broken))

    def tables(self) -> tuple[Table, ...]:
        return tuple(
            Table(name, rows, tuple(self._column(key, ()) for key in self._raw if key[0] == name))
            for name, rows in self._rows.items()
        )

    def _column(self, key: tuple[str, str], path: tuple) -> Column:
        if key in path:
            raise SpecError(f"Circular column dependency: {' -> '.join('.'.join(k) for k in (*path, key))}")
        if key not in self._raw:
            raise SpecError(f"{'.'.join(path[-1])} -> {'.'.join(key)}: no such column")
        if key not in self._done:
            fields = self._raw[key]
            links = [kind for kind in ("reference", "derive") if fields.child(kind).raw]
            if len(links) == 2:
                raise SpecError(f"{fields.place} cannot be both a reference and derived")
            build = {"reference": self._reference, "derive": self._derived}.get("".join(links))
            path = (*path, key)
            self._done[key] = build(key, fields, path) if build else self._generated(key, fields)
        return self._done[key]

    def _reference(self, key, fields: Fields, path) -> ReferenceColumn:
        limits, link = fields.child("constraints"), fields.child("reference")
        if extra := sorted(set(limits.raw) - {"null_ratio"}):
            raise SpecError(f"{fields.place}: a reference takes only null_ratio, not {', '.join(extra)}")
        parent = (link.text("table_name"), link.name("column_name"))
        return ReferenceColumn(
            name=key[1],
            output=self._column(parent, path).output,
            parent_table=parent[0],
            parent_column=parent[1],
            cardinality=link.one_of("cardinality", Cardinality),
            null_ratio=limits.ratio("null_ratio"),
        )

    def _derived(self, key, fields: Fields, path) -> DerivedColumn:
        if fields.child("constraints").raw:
            raise SpecError(f"{fields.place}: a derived column takes no constraints")
        output = fields.one_of("output_data_type", T)
        link = fields.child("derive")
        source = self._column((key[0], link.name("source_column")), path)
        if not isinstance(source, GeneratedColumn) or source.source not in (T.DATE, T.TIMESTAMP):
            raise SpecError(f"{fields.place}: the source must be a generated DATE or TIMESTAMP column")
        if isinstance(source.domain, Listed):
            raise SpecError(f"{fields.place}: a column drawn from a supplied list has no derived columns")
        if output not in (T.INT, T.STRING):
            raise SpecError(f"{fields.place}: a derived column is INT or STRING")
        rule = link.text("rule")
        if rule not in DERIVATIONS:
            raise SpecError(f"{fields.place}: unsupported rule {rule!r}")
        return DerivedColumn(key[1], output, source.name, rule, source.null_ratio)

    def _generated(self, key, fields: Fields) -> GeneratedColumn:
        limits = fields.child("constraints")
        limits.place = fields.place
        spelled = fields.text("generator_data_type", "gen_data_type").upper()
        source = Fields({"type": TYPE_ALIASES.get(spelled, spelled)}, fields.place).one_of("type", T)
        format_field = {T.DATE: "date_format", T.TIMESTAMP: "timestamp_format"}.get(source)
        default_output = T.STRING if format_field in limits.raw else source
        output = fields.one_of("output_data_type", T, default_output)
        fmt = None
        if format_field:
            default = DATE_FORMAT if source is T.DATE else TIMESTAMP_FORMAT
            fmt = limits.text(format_field) if format_field in limits.raw else default
        unique = limits.flag("is_unique", "unique")
        try:
            check_conversion(source, output, unique, fmt)
        except SpecError as error:
            raise SpecError(f"{fields.place}: {error}") from error
        allowed = limits.get("allowed_values")
        if allowed is not None and not isinstance(allowed, list):
            raise SpecError(f"{fields.place}: allowed_values must be a list")
        grow = self._rows[key[0]] - 1 if unique and not allowed else 0
        builders = {
            T.STRING: _text_domain,
            T.INT: _int_domain,
            T.FLOAT: _float_domain,
            T.DATE: _date_domain,
            T.TIMESTAMP: _timestamp_domain,
            T.BOOLEAN: lambda *_: Choice((True, False)),
        }
        domain = builders[source](limits, grow, self._as_of)
        if allowed:
            domain = _choice(limits, source, allowed)
        if limits.get("allowed_from") is not None:
            if allowed is not None:
                raise SpecError(f"{fields.place}: allowed_from cannot be combined with allowed_values")
            domain = Listed(limits.text("allowed_from"), source not in (T.STRING, T.BOOLEAN))
        return GeneratedColumn(
            key[1], source, output, domain, limits.ratio("null_ratio"), unique, fmt
        )


def _choice(limits: Fields, source: T, allowed: list) -> Choice:
    kinds = {T.INT: int, T.FLOAT: (int, float), T.BOOLEAN: bool}
    if source in kinds:
        for value in allowed:
            if not isinstance(value, kinds[source]) or (source is not T.BOOLEAN and isinstance(value, bool)):
                raise SpecError(f"{limits.place}: allowed value {value!r} is not {source.value}")
    if source is T.INT:
        _check_int64(limits, *allowed)
    if source is T.FLOAT:
        allowed = [float(value) for value in allowed]
    if source is T.DATE:
        allowed = [limits.moment("allowed_values", value).date() for value in allowed]
    if source is T.TIMESTAMP:
        allowed = [limits.moment("allowed_values", value) for value in allowed]
    if source is T.STRING:
        allowed = [str(value) for value in allowed]
    if source in (T.STRING, T.BOOLEAN):  # these two forget how often a value was listed
        allowed = list(dict.fromkeys(allowed))
    return Choice(tuple(allowed))


def _check_int64(limits: Fields, *values: int) -> None:
    if any(not _INT64[0] <= value <= _INT64[1] for value in values):
        raise SpecError(f"{limits.place}: integers must fit in 64 bits")


def _span(limits: Fields, low: int, high: int, unit: str, **extra) -> Span:
    if high < low:
        raise SpecError(f"{limits.place}: the maximum is below the minimum")
    return Span(low, high, unit, **extra)


def _int_domain(limits: Fields, grow: int, as_of: date) -> Span:
    if limits.get("digits_count") is not None:
        clash = [f for f in ("min_value", "max_value", "allowed_values") if limits.get(f) is not None]
        if clash:
            raise SpecError(f"{limits.place}: digits_count cannot be combined with {', '.join(clash)}")
        low, high = _digit_range(limits, "digits_count", limits.integer("digits_count"))
    else:
        low = limits.integer("min_value", INT_RANGE[0])
        high = limits.integer("max_value", max(INT_RANGE[1], low + grow) if grow else INT_RANGE[1])
    _check_int64(limits, low, high)
    return _span(limits, low, high, "number")


def _digit_range(limits: Fields, field: str, digits: int) -> tuple[int, int]:
    """All numbers of that many digits, without a leading zero."""
    if digits <= 0:
        raise SpecError(f"{limits.place}: {field} must be greater than 0")
    return (0 if digits == 1 else 10 ** (digits - 1)), 10**digits - 1


def _float_domain(limits: Fields, grow: int, as_of: date) -> Span | Real:
    precision = limits.integer("precision", FLOAT_PRECISION)
    if precision < 0:
        raise SpecError(f"{limits.place}: precision must not be negative")
    scale = 10**precision
    low = limits.number("min_value", FLOAT_RANGE[0])
    high = limits.number("max_value", max(FLOAT_RANGE[1], low + grow / scale))
    if high < low:
        raise SpecError(f"{limits.place}: the maximum is below the minimum")
    doubles = GridDoubles(precision)
    ranks = doubles.rank(low), doubles.rank(high)
    if doubles.is_plain(*ranks):
        return Span(*ranks, "decimal", precision)
    if limits.flag("is_unique", "unique"):  # of the numbers that exist, which are fewer than the grid has
        return Span(*ranks, "double", precision)
    return Real(low, high, precision)


def _date_domain(limits: Fields, grow: int, as_of: date) -> Span:
    low = date(as_of.year, 1, 1)
    if limits.get("min_value") is not None:
        low = limits.moment("min_value", limits.get("min_value")).date()
    high = max(date(as_of.year, 12, 31), _later(limits, low, timedelta(days=grow))) if grow else date(as_of.year, 12, 31)
    if limits.get("max_value") is not None:
        high = limits.moment("max_value", limits.get("max_value")).date()
    return _span(limits, (low - _EPOCH_DAY).days, (high - _EPOCH_DAY).days, "day")


def _later(limits: Fields, start: date, step: timedelta) -> date:
    try:
        return start + step
    except OverflowError as error:
        raise UnsatisfiableError(f"{limits.place}: the calendar ends before all rows have a value") from error


def _timestamp_domain(limits: Fields, grow: int, as_of: date) -> Span:
    low = datetime(as_of.year, 1, 1)
    if limits.get("min_timestamp") is not None:
        low = limits.moment("min_timestamp", limits.get("min_timestamp"))
    high = datetime(as_of.year, 12, 31, 23, 59, 59)
    high = max(high, _later(limits, low, timedelta(seconds=grow))) if grow else high
    if limits.get("max_timestamp") is not None:
        high = limits.moment("max_timestamp", limits.get("max_timestamp"))
    if high < low:
        raise SpecError(f"{limits.place}: the maximum is below the minimum")
    return Span(0, (high - low) // timedelta(seconds=1), "second", origin=low)


def _text_domain(limits: Fields, grow: int, as_of: date) -> Text | Span | Pattern:
    case = "upper" if limits.get("uppercase") else "lower" if limits.get("lowercase") else "mixed"
    case = limits.one_of("case_mode", CASE_MODES, case)
    charset = "digits" if limits.get("digits_only") else "letters"
    charset = limits.one_of("character_set", CHARACTER_SETS, charset)
    length = limits.integer("length", STRING_LENGTH)
    if length <= 0:
        raise SpecError(f"{limits.place}: length must be greater than 0")
    if limits.get("regular_expr") is not None:
        regex = limits.text("regular_expr")
        if limits.flag("is_unique", "unique"):
            raise SpecError(f"{limits.place}: a unique column cannot use a regular expression")
        if pool := single_class(regex):  # the pattern decides length and case on its own
            return Text(*pool)
        most = limits.integer("max_repeat", UNBOUNDED_REPEAT)
        if most < 1:
            raise SpecError(f"{limits.place}: max_repeat must be greater than 0")
        if not limits.get("allowed_values"):
            read_pattern(regex, most)
        return Pattern(regex, case, most)
    if charset == "digits":
        if length > 18:  # beyond 64 bits
            return Text(DIGITS, length, lead=DIGITS[1:])
        return Span(*_digit_range(limits, "length", length), "digits")
    return Text(LETTERS[case] + (DIGITS if charset == "alphanumeric" else ""), length)
