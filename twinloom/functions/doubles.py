"""The doubles that numbers of a decimal grid become, as a range of integers in the same order.

Near zero the grid is wider than the gaps between doubles, so each of its points is a double of
its own. From a power of two on, the gaps are at least as wide as the grid, and every double is the
nearest one of some point. Points below that power are numbered by the grid, doubles from there on
by their bits, and negative ones mirrored; so the numbers that exist are exactly the integers of a
range, and distinct integers are distinct doubles (up to 22 places, beyond which 10^places is
itself no double).
"""

from __future__ import annotations

import math
import struct
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinloom.functions.draws import bigint

_FRACTION_BITS = 52


def _bits(value: float) -> int:
    return struct.unpack("<q", struct.pack("<d", value))[0]


class GridDoubles:
    """Doubles rounded to a number of decimal places."""

    def __init__(self, precision: int) -> None:
        self.scale = 10**precision
        exponent = -4 * precision - 1  # below 10^-precision
        while Fraction(2) ** exponent * self.scale < 1:
            exponent += 1
        # The first power of two from which neighbouring doubles are 10^-precision or more apart.
        self.dense = math.ldexp(1.0, exponent + _FRACTION_BITS)
        self.points = math.ceil(Fraction(self.dense) * self.scale)

    def rank(self, value: float) -> int:
        """The integer of the grid point next to the value, or of the double itself."""
        size = abs(value)
        rank = round(Fraction(size) * self.scale) if size < self.dense else self.points + _bits(size) - _bits(self.dense)
        return rank if value >= 0 else -rank

    def is_plain(self, low: int, high: int) -> bool:
        """Whether the integers of a range are all grid points."""
        return max(abs(low), abs(high)) <= self.points

    def value(self, rank: int) -> float:
        size = abs(rank)
        if size < self.points:
            found = size / self.scale
        else:
            found = struct.unpack("<d", struct.pack("<q", size - self.points + _bits(self.dense)))[0]
        return found if rank >= 0 else -found

    def column(self, rank: Column, low: int, high: int) -> Column:
        """The doubles of a column of integers from ``low`` to ``high``."""
        size = F.abs(rank)
        above = size - bigint(self.points)  # bits beyond those of the first dense double
        power = F.call_function("div", above, bigint(1 << _FRACTION_BITS))
        fraction = (above % bigint(1 << _FRACTION_BITS) + bigint(1 << _FRACTION_BITS)).cast("double")
        first = math.frexp(self.dense)[1] - 1 - _FRACTION_BITS
        last = math.frexp(self.value(max(abs(low), abs(high))))[1] - _FRACTION_BITS
        powers = F.array(*(F.lit(math.ldexp(1.0, exponent)) for exponent in range(first, last + 1)))
        near = size.cast("double") / F.lit(float(self.scale))
        value = F.when(size < bigint(self.points), near).otherwise(fraction * F.get(powers, power.cast("int")))
        return F.when(rank < 0, -value).otherwise(value)
