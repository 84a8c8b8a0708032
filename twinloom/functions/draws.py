"""Pseudo-random draws that depend only on (seed, stream, row id).

``rand(seed)`` depends on the partitioning, so a retried or re-partitioned task would
produce other values. Hashing the row id does not: each cell can be recomputed anywhere.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# A 64-bit draw reduced modulo a bound has a relative bias of bound / 2**64. Above this
# bound a second draw is appended, in decimal arithmetic, to keep the bias negligible.
SINGLE_DRAW_LIMIT = 1 << 50


def stream_key(seed: int, *parts: object) -> int:
    """A 60-bit key that names one independent stream of draws."""
    text = "\x1f".join(str(part) for part in (seed, *parts))
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)


def bigint(value: int) -> Column:
    return F.lit(value) if abs(value) >= 1 << 31 else F.lit(value).cast("bigint")


def draw(key: int, *ids: Column) -> Column:
    """A signed 64-bit draw for each row."""
    return F.xxhash64(bigint(key), *ids)


def draw_below(bound: int, key: int, *ids: Column) -> Column:
    """A uniform integer in ``[0, bound)``: bigint, or decimal(38,0) for wide bounds."""
    if bound <= SINGLE_DRAW_LIMIT:
        return F.pmod(draw(key, *ids), bigint(bound))
    high = F.pmod(draw(key, *ids), bigint(1 << 62)).cast("decimal(38,0)")
    low = F.pmod(draw(key ^ 1, *ids), bigint(1 << 32))
    wide = high * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(10,0)")
    return F.pmod(wide.cast("decimal(38,0)"), F.lit(str(bound)).cast("decimal(38,0)")).cast("decimal(38,0)")


def draw_unit(key: int, *ids: Column) -> Column:
    """A uniform double in ``[0, 1)``."""
    return F.shiftrightunsigned(draw(key, *ids), 11) * F.lit(2.0**-53)


def int_div(column: Column, divisor: int | Column) -> Column:
    """Integer division (truncating; every use here has non-negative operands)."""
    return F.call_function("div", column, bigint(divisor) if isinstance(divisor, int) else divisor)


def draw_within(width: Column, key: int, *ids: Column) -> Column:
    """A uniform integer in ``[0, width)`` where the width itself is a column."""
    return F.pmod(draw(key, *ids), width)


def draw_within_wide(width: Column, key: int, *ids: Column) -> Column:
    """The same for a decimal width beyond 64 bits: 94 drawn bits modulo the width."""
    high = F.pmod(draw(key, *ids), bigint(1 << 62)).cast("decimal(19,0)")
    low = F.pmod(draw(key ^ 1, *ids), bigint(1 << 32)).cast("decimal(10,0)")
    bits = (high * F.lit(1 << 32).cast("decimal(10,0)") + low).cast("decimal(38,0)")
    return F.pmod(bits, width).cast("decimal(38,0)")


def pick(values: list, key: int, *ids: Column) -> Column:
    """One of the literal columns, uniformly; repeated entries carry their weight."""
    if len(values) == 1:
        return values[0]
    return F.get(F.array(*values), draw_below(len(values), key, *ids).cast("int"))
