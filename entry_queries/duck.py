"""The generator's draws, permutation and distinct index written a second time, in SQL.

The Spark side evaluates ``xxhash64``; here the same public algorithm (XXH64 of one
64-bit value) is spelled out in unsigned DuckDB arithmetic, so the oracle shares nothing
with the engine but the stream keys.
"""

from __future__ import annotations

from twinloom.functions.draws import stream_key
from twinloom.functions.ordering import multiplier

SEED = 42

# The XXH64 primes.
P1 = 0x9E3779B185EBCA87
P2 = 0xC2B2AE3D27D4EB4F
P3 = 0x165667B19E3779F9
P4 = 0x85EBCA77C2B2AE63
P5 = 0x27D4EB2F165667C5
_MOD = 1 << 64


def hash_long(value: int, seed: int = 42) -> int:
    def rotate(x: int, bits: int) -> int:
        return (x << bits | x >> (64 - bits)) % _MOD

    h = (seed + P5 + 8) % _MOD ^ rotate(value * P2 % _MOD, 31) * P1 % _MOD
    h = (rotate(h, 27) * P1 + P4) % _MOD
    h = (h ^ h >> 33) * P2 % _MOD
    h = (h ^ h >> 29) * P3 % _MOD
    return h ^ h >> 32


def _mul(a: str, b: int) -> str:
    return f"(({a}::UHUGEINT * {b}::UHUGEINT) % {_MOD}::UHUGEINT)::UBIGINT"


def _rotate(a: str, bits: int) -> str:
    return f"({_mul(a, 1 << bits)} + ({a} >> {64 - bits}))"


def hash_sql(key: int, *ids: str) -> str:
    """The unsigned 64-bit draw of a row: the key first, then each id chained as seed."""
    seed: str | int = hash_long(key)
    for value in ids:
        if isinstance(seed, int):
            start = f"{(seed + P5 + 8) % _MOD}::UBIGINT"
        else:
            start = f"(({seed}::UHUGEINT + {P5 + 8}::UHUGEINT) % {_MOD}::UHUGEINT)::UBIGINT"
        steps = [
            _mul("a", P2),
            f"xor({_mul(_rotate('a', 31), P1)}, {start})",
            f"(({_mul(_rotate('a', 27), P1)}::UHUGEINT + {P4}::UHUGEINT) % {_MOD}::UHUGEINT)::UBIGINT",
            _mul("xor(a, a >> 33)", P2),
            _mul("xor(a, a >> 29)", P3),
            "xor(a, a >> 32)",
        ]
        sql = f"[({value})::UBIGINT]"
        for step in steps:
            sql = f"list_transform({sql}, lambda a: {step})"
        seed = f"{sql}[1]"
    return seed


def signed(unsigned: str) -> str:
    return f"list_transform([{unsigned}::HUGEINT], lambda u: CASE WHEN u >= {1 << 63} THEN u - {_MOD}::HUGEINT ELSE u END)[1]"


def below(bound: int | str, key: int, *ids: str) -> str:
    """A draw reduced to ``[0, bound)``."""
    s = signed(hash_sql(key, *ids))
    return f"((({s}) % ({bound})::HUGEINT + ({bound})::HUGEINT) % ({bound})::HUGEINT)"


def key(table: str, column: str, purpose: str = "value") -> int:
    return stream_key(SEED, table, column, purpose)


def pick(values: list[str], k: int, *ids: str) -> str:
    return f"[{', '.join(values)}][(1 + {below(len(values), k, *ids)})::INT]"


def chars(index: str, pool: str, length: int) -> str:
    """The base-N digits of an index as pool characters, most significant first."""
    base = len(pool)
    return " || ".join(
        f"substr('{pool}', 1 + (({index})::HUGEINT // {base**place} % {base})::INT, 1)"
        for place in range(length - 1, -1, -1)
    )


class Rows:
    """A chain of CTEs; each ``let`` adds named columns."""

    def __init__(self, source: str, prefix: str = "s") -> None:
        self.prefix = prefix
        self._ctes = [source]

    @property
    def name(self) -> str:
        return f"{self.prefix}{len(self._ctes) - 1}"

    def let(self, **columns: str) -> "Rows":
        cells = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
        source = self.name
        self._ctes.append(f"SELECT *, {cells} FROM {source}")
        return self

    def ctes(self) -> str:
        return ", ".join(f"{self.prefix}{i} AS ({sql})" for i, sql in enumerate(self._ctes))

    def select(self, columns: str) -> str:
        return f"WITH {self.ctes()} SELECT {columns} FROM {self.name}"

    def permute(self, name: str, table: str, column: str) -> "Rows":
        """``name`` = the permuted position of ``id`` among ``n`` rows."""
        factor = multiplier(stream_key(SEED, table, column, "affine"), 1)
        offset = stream_key(SEED, table, column, "offset")
        self.let(x0=f"((id::HUGEINT * ({factor} % n) + {offset} % n) % n)")
        for number in range(4):
            k = stream_key(SEED, table, column, "round", number)
            x = f"x{number}"
            self.let(y=f"((({k} % n)::HUGEINT - {x} + n) % n)")
            swap = f"{hash_sql(k, f'least({x}, y)')} >= {1 << 63}"
            source = self.name
            self._ctes.append(
                f"SELECT * EXCLUDE (y, {x}), CASE WHEN {swap} THEN y ELSE {x} END AS x{number + 1} FROM {source}"
            )
        source = self.name
        self._ctes.append(f"SELECT * EXCLUDE (x4), x4 AS {name} FROM {source}")
        return self

    def nulls(self, ratio: str) -> "Rows":
        """``nulls`` and ``filled``: the exact counts; ``rank``: the non-null rank, from ``pos``."""
        self.let(nulls=f"CAST(floor(n * ({ratio})::DOUBLE) AS BIGINT)")
        return self.let(filled="n - nulls", rank="pos - nulls")

    def spread(self, name: str, space: str, k: int, rank: str = "rank", count: str = "filled") -> "Rows":
        """``name`` = distinct integers below ``space`` for the ranks below ``count``."""
        self.let(r0=f"greatest({rank}, 0)::HUGEINT")
        self.let(lo=f"r0 * ({space})::HUGEINT // {count}", hi=f"(r0 + 1) * ({space})::HUGEINT // {count}")
        source = self.name
        self._ctes.append(
            f"SELECT * EXCLUDE (r0, lo, hi), lo + {below('hi - lo', k, 'r0')} AS {name} FROM {source}"
        )
        return self


def rows_of(table: str, id_column: str, prefix: str = "s") -> Rows:
    return Rows(f"SELECT {id_column} AS id, (SELECT count(*) FROM {table}) AS n FROM {table}", prefix)
