"""Fixed-length strings over a character pool."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinloom.functions.draws import bigint, draw_below, int_div
from twinloom.functions.stages import Stages, Term, combine

_CHUNK_SPACE = 1 << 40
_DIGITS_PER_DRAW = 12
_LIMB_SPACE = 1 << 50  # a limb and a shift add up within 64 bits, and one hash is a fair draw
#: How often each limb of a distinct string is shifted.
SHIFTS = 3


def pool_array(pool: str) -> Column:
    """The pool as an array; Catalyst folds it to a literal, so a lookup is one index."""
    return F.split(F.lit(pool), "")


def chars_within(base: int, space: int) -> int:
    """The longest string over ``base`` characters whose combinations fit in ``space``."""
    count = 1
    while base > 1 and base ** (count + 1) <= space:
        count += 1
    return count


def encode_index(index: Column, pool: str, length: int) -> list[Column]:
    """The base-N digits of the index, most significant first, as pool characters."""
    base, chars = len(pool), pool_array(pool)
    if base == 1:
        return [F.lit(pool)] * length
    digits = []
    for place in range(length - 1, -1, -1):
        digit = index if place == 0 else int_div(index, base**place)
        if place != length - 1:
            digit = digit % bigint(base)
        digits.append(F.get(chars, digit.cast("int")))
    return digits


def random_text(stages: Stages, pool: str, length: int, key: int, row: Term) -> Term:
    """``length`` independent characters; one hash serves as many of them as it can hold."""
    if length == 0:
        return combine(lambda _: F.lit(""), row)
    numeric = pool == string.digits
    per_draw = _DIGITS_PER_DRAW if numeric else chars_within(len(pool), _CHUNK_SPACE)
    pieces: list[Term] = []
    for number, start in enumerate(range(0, length, per_draw)):
        size = min(per_draw, length - start)
        value = combine(lambda x: draw_below(len(pool) ** size, key + 2 * number, x), row)
        if numeric:
            pieces.append(combine(lambda v: F.lpad(v.cast("string"), size, "0"), value))
        elif size == 1 or len(pool) == 1:
            pieces.append(combine(lambda v: F.concat(*encode_index(v, pool, size)), value))
        else:
            pieces.append(combine(lambda v: F.concat(*encode_index(v, pool, size)), stages.let(value)))
    return pieces[0] if len(pieces) == 1 else combine(lambda *parts: F.concat(*parts), *pieces)


def limbs(pool: str, length: int, lead: str | None) -> list[tuple[str, int]]:
    """The text as pieces (pool, characters), each of which one draw can fill."""
    pieces = [(lead, 1)] if lead else []
    left, most = length - len(pieces), chars_within(len(pool), _LIMB_SPACE)
    while left:
        pieces.append((pool, min(left, most)))
        left -= pieces[-1][1]
    return pieces


def distinct_text(stages: Stages, pool: str, length: int, lead: str | None, key: int, rank: Term) -> Term:
    """Distinct strings of a space beyond 64 bits, for distinct ranks below 2^62.

    The rank is written as a number of several limbs, the last first. A keyed permutation of the
    whole space follows: each limb in turn is shifted, modulo its size, by a hash of all others,
    which can be undone and so keeps numbers distinct. After ``SHIFTS`` turns the strings lie like
    a random sample of the space, so their first characters agree as often as such a sample's do.
    """
    pieces = limbs(pool, length, lead)
    sizes = [len(of) ** count for of, count in pieces]
    held, rest = [None] * len(pieces), rank
    for place in range(len(pieces) - 1, -1, -1):
        size = bigint(sizes[place])
        held[place] = stages.let(combine(lambda v: v % size, rest))
        rest = stages.let(combine(lambda v: int_div(v, size), rest))
    for turn in range(SHIFTS):
        for place, size in enumerate(sizes):
            stream = key + 2 * (turn * len(pieces) + place)
            others = held[:place] + held[place + 1 :]
            held[place] = stages.let(
                combine(lambda v, *ids: (v + draw_below(size, stream, *ids)) % bigint(size), held[place], *others)
            )
    texts = [
        combine(lambda v, of=of, count=count: F.concat(*encode_index(v, of, count)), limb)
        for limb, (of, count) in zip(held, pieces, strict=True)
    ]
    return combine(lambda *parts: F.concat(*parts), *texts)
