"""Exact permutations of ``0..n-1`` and distinct indexes, without sorting or shuffling.

An affine map spreads neighbouring rows over the whole range; a few swap-or-not rounds
(Hoang, Morris, Rogaway, CRYPTO 2012) then break its lattice. Each round pairs ``x`` with
``(k - x) mod n`` and swaps the pair on a hash bit, so it is its own inverse for every n.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinloom.errors import SpecError
from twinloom.functions.draws import bigint, draw_within, draw_within_wide, int_div, stream_key
from twinloom.functions.stages import Stages, Term, combine

ROUNDS = 4
_HALF = 1 << 21
_BIGINT_ROWS = 1 << 41
_NARROW_ROWS = 1 << 31
MAX_SPACE = 1 << 62


def _is_prime(number: int) -> bool:
    witnesses = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
    if any(number % w == 0 for w in witnesses):
        return number in witnesses
    odd, twos = number - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for w in witnesses:
        power = pow(w, odd, number)
        if power in (1, number - 1):
            continue
        if not any((power := power * power % number) == number - 1 for _ in range(twos - 1)):
            return False
    return True


def multiplier(key: int, size: int) -> int:
    """A prime of about 40 bits that shares no factor with ``size``."""
    candidate = (1 << 40) + key % (1 << 40) | 1
    while not (_is_prime(candidate) and gcd(candidate, size) == 1):
        candidate += 2
    return candidate


def multiply_mod(column: Column, factor: int, addend: int, size: int) -> Column:
    """``(column * factor + addend) mod size`` without leaving the integer range."""
    factor, addend = factor % size, addend % size
    if size < _NARROW_ROWS:
        return (column * bigint(factor) + bigint(addend)) % bigint(size)
    if size < _BIGINT_ROWS:
        high, low = divmod(factor, _HALF)
        upper = (column * bigint(high)) % bigint(size)
        return (upper * bigint(_HALF) + column * bigint(low) + bigint(addend)) % bigint(size)
    wide = column.cast("decimal(19,0)") * F.lit(str(factor)).cast("decimal(18,0)")
    total = wide.cast("decimal(38,0)") + F.lit(str(addend)).cast("decimal(19,0)")
    return (total.cast("decimal(38,0)") % F.lit(str(size)).cast("decimal(19,0)")).cast("bigint")


class Permutation:
    """A keyed bijection of ``0..size-1``."""

    def __init__(self, size: int, seed: int, *stream: object) -> None:
        if size >= MAX_SPACE:
            raise SpecError(f"Cannot permute more than {MAX_SPACE - 1} rows")
        self.size = size
        key = stream_key(seed, *stream, "affine")
        self._factor = multiplier(key, size)
        self._addend = stream_key(seed, *stream, "offset")
        self._rounds = [stream_key(seed, *stream, "round", number) for number in range(ROUNDS)]

    def forward(self, stages: Stages, position: Term) -> Term:
        spread = combine(lambda x: multiply_mod(x, self._factor, self._addend, self.size), position)
        current = stages.let(spread)
        for key in self._rounds:
            current = self._swap_or_not(stages, key, current)
        return stages.let(current, pinned=True)

    def backward(self, stages: Stages, rank: Term) -> Term:
        current = stages.let(rank)
        for key in reversed(self._rounds):
            current = self._swap_or_not(stages, key, current)
        inverse = pow(self._factor, -1, self.size)
        return stages.let(
            combine(lambda y: multiply_mod(y, inverse, -self._addend * inverse, self.size), current),
            pinned=True,
        )

    def _swap_or_not(self, stages: Stages, key: int, position: Term) -> Term:
        x, size = position.name, f"{self.size}L"
        partner = f"pmod({key % self.size}L - {x}, {size})"
        swap = f"xxhash64({key}L, least({x}, {partner})) < 0"
        return stages.let(Term(F.expr(f"CASE WHEN {swap} THEN {partner} ELSE {x} END"), position.depth))


def _wide_index(rank: Column, count: int, width: int, extra: int, key: int, *ids: Column) -> Column:
    """The same for spaces beyond 64-bit arithmetic, in decimals; at most 2^64 values, rows below 2^62."""

    def number(value: int) -> Column:
        return F.lit(str(value)).cast("decimal(20,0)")

    def start(position: Column) -> Column:
        whole = position.cast("decimal(18,0)" if count < 10**18 else "decimal(19,0)")
        steps = int_div((whole * number(extra)).cast("decimal(38,0)"), number(count)).cast("decimal(20,0)")
        return ((whole * number(width)).cast("decimal(38,0)") + steps).cast("decimal(38,0)")

    first = start(rank)
    size = (start(rank + bigint(1)) - first).cast("decimal(38,0)")
    return (first + draw_within_wide(size, key, *ids)).cast("decimal(38,0)")


def spread_index(rank: Column, count: int, space: int, key: int, *ids: Column) -> Column:
    """Map the dense ranks ``0..count-1`` to distinct integers in ``[0, space)``.

    Rank r owns the stratum ``[floor(r*space/count), floor((r+1)*space/count))`` and draws
    inside it: distinct by construction, every value of the space is reachable, and no
    lookup table or shuffle is needed.
    """
    width, extra = divmod(space, count)
    if space >= MAX_SPACE:
        return _wide_index(rank, count, width, extra, key, *ids)
    if extra == 0:
        return rank if width == 1 else rank * bigint(width) + draw_within(bigint(width), key, *ids)

    def start(position: Column) -> Column:
        if count < _NARROW_ROWS:
            steps = int_div(position * bigint(extra), count)
        else:
            product = position.cast("decimal(19,0)") * F.lit(str(extra)).cast("decimal(19,0)")
            steps = int_div(product.cast("decimal(38,0)"), count)
        return position * bigint(width) + steps

    first = start(rank)
    return first + draw_within(start(rank + bigint(1)) - first, key, *ids)

