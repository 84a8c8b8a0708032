"""Conversions from a generated type to the output type, and derived date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinloom.errors import SpecError
from twinloom.functions.formats import keeps_every_day, keeps_every_second, renders_only_digits, spark_pattern
from twinloom.plans.types import LogicalType as T

# The output types each generated type may take.
OUTPUT_TYPES = {
    T.INT: (T.INT, T.FLOAT, T.STRING, T.BOOLEAN),
    T.FLOAT: (T.FLOAT, T.STRING, T.INT),
    T.BOOLEAN: (T.BOOLEAN, T.STRING, T.INT),
    T.STRING: (T.STRING, T.INT),
    T.DATE: (T.DATE, T.STRING, T.INT, T.TIMESTAMP),
    T.TIMESTAMP: (T.TIMESTAMP, T.STRING, T.INT, T.DATE),
}

# Conversions that merge values, so they cannot feed a unique column.
LOSSY = {(T.INT, T.BOOLEAN), (T.FLOAT, T.INT), (T.TIMESTAMP, T.DATE)}

# Derivation rule -> strftime format of the source.
DERIVATIONS = {"YYYYMMDD": "%Y%m%d", "YYYY": "%Y", "MM": "%m"}


def check_conversion(source: T, target: T, unique: bool = False, fmt: str | None = None) -> None:
    if target not in OUTPUT_TYPES[source]:
        raise SpecError(f"Conversion not allowed: {source.value} -> {target.value}")
    if unique and (source, target) in LOSSY:
        raise SpecError(f"A unique column cannot be converted {source.value} -> {target.value}")
    if fmt is not None and source in (T.DATE, T.TIMESTAMP) and target in (T.STRING, T.INT):
        if target is T.INT and not renders_only_digits(fmt):
            raise SpecError(f"Format {fmt!r} must produce only digits for {source.value} -> INT")
        spark_pattern(fmt)


def convert(value: Column, source: T, target: T, fmt: str | None = None) -> Column:
    """The value as the target type; the session time zone is taken to be UTC."""
    check_conversion(source, target, fmt=fmt)
    if source is target:
        return value
    if source in (T.DATE, T.TIMESTAMP) and target in (T.STRING, T.INT):
        default = "%Y-%m-%d" if source is T.DATE else "%Y-%m-%d %H:%M:%S"
        text = F.date_format(value, spark_pattern(fmt or default))
        return text.cast("bigint") if target is T.INT else text
    if (source, target) == (T.INT, T.BOOLEAN):
        return value != F.lit(0)
    if (source, target) == (T.FLOAT, T.STRING):
        return float_text(value)
    if (source, target) == (T.BOOLEAN, T.STRING):
        return F.initcap(value.cast("string"))
    return value.cast(target.spark_type)


def float_text(value: Column) -> Column:
    """A double as Python prints it: plain from 1e-4 to 1e16, otherwise ``1e+16`` style.

    Spark switches to ``1.0E7`` style at 1e7 and below 1e-3, and on older JVMs may print a
    digit more than needed. Most values need neither repair and take the first branch.
    """
    text = value.cast("string")
    usual = (F.length(text) <= 17) & ~text.contains("E")
    # The one-element transform binds the repaired text to a name used several times.
    repaired = F.transform(F.array(_shortest(value, text)), _python_style)
    return F.when(usual, text).otherwise(F.get(repaired, F.lit(0)))


def _python_style(text: Column) -> Column:
    size = F.abs(text.cast("double"))
    digits = text.cast("decimal(38,21)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.?0*$", "")
    exponent = F.substring_index(text, "E", -1).cast("int")
    power = F.abs(exponent)
    sign = F.when(exponent < 0, "e-").otherwise("e+")
    scientific = F.concat(mantissa, sign, F.when(power < 10, "0").otherwise(""), power.cast("string"))
    return (
        F.when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def _shortest(value: Column, text: Column) -> Column:
    """The fewest digits (15 to 17) that still read back as the same double."""
    candidates = F.array(*(F.format_string(f"%.{digits - 1}E", value) for digits in (15, 16, 17)), text)
    first = F.get(F.filter(candidates, lambda candidate: candidate.cast("double") == value), F.lit(0))
    return F.when(F.length(text) <= 17, text).otherwise(first)


def is_injective(source: T, target: T, fmt: str | None = None) -> bool:
    """True when distinct source values certainly stay distinct."""
    if source is target:
        return True
    if target in (T.STRING, T.INT):
        if source is T.DATE:
            return keeps_every_day(fmt or "%Y-%m-%d")
        if source is T.TIMESTAMP:
            return keeps_every_second(fmt or "%Y-%m-%d %H:%M:%S")
    return (source, target) in {
        (T.INT, T.STRING),
        (T.FLOAT, T.STRING),
        (T.BOOLEAN, T.STRING),
        (T.BOOLEAN, T.INT),
        (T.DATE, T.TIMESTAMP),
    }


def derive(value: Column, rule: str, target: T) -> Column:
    """Format a date or timestamp by a derivation rule, as STRING or INT."""
    text = F.date_format(value, spark_pattern(DERIVATIONS[rule]))
    return text.cast("bigint") if target is T.INT else text
