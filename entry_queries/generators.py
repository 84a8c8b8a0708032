"""Generated columns over the rows of ``orders`` and ``customer``, with full value oracles."""

from __future__ import annotations

from entry_queries.base import column, derived, read, synthetic
from entry_queries.duck import SEED, below, chars, hash_sql, key, pick, rows_of, signed
from twinloom.functions.draws import stream_key
from twinloom.operators.checks import duplicate_values

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
DIGITS = "0123456789"
QUERIES, ORACLES = {}, {}


def generated(name: str, columns: list[dict], given: str = "orders"):
    QUERIES[name] = lambda spark, sf_dir: synthetic(spark, sf_dir, **{name: (given, columns)})[name]


def over(name: str, given: str = "orders"):
    return rows_of(given, "o_orderkey" if given == "orders" else "c_custkey")


def simple(name: str, kind: str, value_sql, **constraints) -> None:
    """A column without uniqueness or NULLs: a function of the row id alone."""
    generated(name, [column("v", kind, **constraints)])
    ORACLES[name] = over(name).select(f"id AS o_orderkey, {value_sql(key(name, 'v'))} AS v")


def unique(name: str, kind: str, space: str, value_sql, given: str = "orders", ratio: str = "0", **constraints) -> None:
    """A unique column: a function of the permuted non-null rank."""
    generated(name, [column("v", kind, unique=True, **constraints)], given)
    rows = over(name, given).permute("pos", name, "v").nulls(ratio).spread("idx", space, key(name, "v"))
    id_name = "o_orderkey" if given == "orders" else "c_custkey"
    ORACLES[name] = rows.select(f"id AS {id_name}, CASE WHEN rank >= 0 THEN {value_sql} END AS v")


def text_sql(pool: str, sizes: list[int], k: int, seat: str = "id") -> str:
    """Characters drawn in chunks; each chunk has its own stream."""
    return " || ".join(
        f"({chars(below(len(pool) ** size, k + 2 * number, seat), pool, size)})"
        for number, size in enumerate(sizes)
    )


simple("gen_int_range", "INT", lambda k: f"(10 + {below(99_990, k, 'id')})::BIGINT", min_value=10, max_value=99_999)
simple(
    "gen_float_range",
    "FLOAT",
    lambda k: f"(-5050 + ({below(20_200, k, 'id')} + 1) // 2)::BIGINT::DOUBLE / 100.0::DOUBLE",
    min_value=-50.5,
    max_value=50.5,
)
simple(
    "gen_date_range",
    "DATE",
    lambda k: f"(DATE '2020-01-01' + {below(1827, k, 'id')}::INT)::DATE",
    min_value="2020-01-01",
    max_value="2024-12-31",
)
simple(
    "gen_ts_range",
    "TIMESTAMP",
    lambda k: f"TIMESTAMP '2024-02-28 12:00:00' + to_seconds({below(200_001, k, 'id')}::BIGINT)",
    min_timestamp="2024-02-28 12:00:00",
    max_timestamp="2024-03-01 19:33:20",
)
simple("gen_boolean", "BOOLEAN", lambda k: pick(["true", "false"], k, "id"))
simple("gen_str_letters", "STRING", lambda k: text_sql(LOWER + UPPER, [7, 5], k), length=12)
simple(
    "gen_str_alnum", "STRING", lambda k: text_sql(UPPER + DIGITS, [7, 1], k),
    length=8, character_set="alphanumeric", case_mode="upper",
)
simple(
    "gen_str_digits", "STRING", lambda k: f"(100000 + {below(900_000, k, 'id')})::VARCHAR",
    length=6, character_set="digits",
)
simple(
    "gen_str_regex_class", "STRING", lambda k: text_sql(UPPER + DIGITS, [6], k),
    regular_expr="^[A-Z0-9]{6}$", length=3, case_mode="lower",
)
simple("gen_allowed_weighted", "INT", lambda k: pick(["1::BIGINT", "1", "2"], k, "id"), allowed_values=[1, 1, 2])
simple("gen_allowed_string", "STRING", lambda k: pick(["'a'", "'b'"], k, "id"), allowed_values=["a", "a", "b"])

# Several modes at once: a list wins over a pattern, a pattern over a character set, a list over a range.
simple(
    "gen_precedence_list", "STRING", lambda k: pick(["'a'", "'b'"], k, "id"),
    allowed_values=["a", "b"], regular_expr="^[x-z]{4}$", character_set="digits", length=9,
)
simple(
    "gen_precedence_pattern", "STRING", lambda k: text_sql(UPPER + DIGITS, [6], k),
    regular_expr="^[A-Z0-9]{6}$", character_set="digits", length=9,
)
simple(
    "gen_precedence_range", "INT", lambda k: pick(["1::BIGINT", "1", "2"], k, "id"),
    allowed_values=[1, 1, 2], min_value=50, max_value=60,
)


def _pattern_sql(k: int) -> str:
    step = 1 << 20
    letters = text_sql(UPPER, [2], k + step)
    digits = f"left(lpad({below(10**5, k + 3 * step, 'id')}::VARCHAR, 5, '0'), (3 + {below(3, k + 2 * step, 'id')})::INT)"
    ending = f"CASE WHEN {below(2, k + 4 * step, 'id')} = 1 THEN {pick(['$x$', '$yy$'], k + 5 * step, 'id', '1')} ELSE '' END"
    return f"({letters}) || '-' || {digits} || {ending}".replace("$", "'")


simple("gen_str_regex_general", "STRING", _pattern_sql, regular_expr=r"^[A-Z]{2}-\d{3,5}(x|yy)?$")

# With assertions inside, the value is a drawn index into the sorted strings that match: here all words of four are tried.
generated("gen_str_regex_lookahead", [column("v", "STRING", regular_expr=r"^(?=.*\d)(?=.*[A-F])(?!.*00)[A-F0-9]{4}\b$")])
ORACLES["gen_str_regex_lookahead"] = (
    f"WITH words AS (SELECT {chars('number', '0123456789ABCDEF', 4)} AS word FROM range({16**4}) AS numbers(number)), "
    "language AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS place FROM words "
    "WHERE word SIMILAR TO '.*[0-9].*' AND word SIMILAR TO '.*[A-F].*' AND NOT contains(word, '00')), "
    "drawn AS (SELECT o_orderkey, "
    f"{below('(SELECT count(*) FROM language)', key('gen_str_regex_lookahead', 'v'), 'o_orderkey')} AS place FROM orders) "
    "SELECT o_orderkey, word AS v FROM drawn JOIN language USING (place)"
)

unique("gen_int_unique", "INT", "greatest(1000, n)", "(1 + idx)::BIGINT", min_value=1)
unique("gen_int_digits", "INT", "9000000000", "(1000000000 + idx)::BIGINT", digits_count=10)
unique("gen_float_unique", "FLOAT", "greatest(100000, n - 1) + 1", "idx::BIGINT::DOUBLE / 100.0::DOUBLE")
unique(
    "gen_date_unique", "DATE", "greatest(DATE '2025-12-31' - DATE '1970-01-01', n - 1) + 1",
    "(DATE '1970-01-01' + idx::INT)::DATE", given="customer", min_value="1970-01-01",
)
unique(
    "gen_ts_unique", "TIMESTAMP", "greatest(365 * 86400 - 1, n - 1) + 1",
    "TIMESTAMP '2025-01-01' + to_seconds(idx::BIGINT)", min_timestamp="2025-01-01",
)


def _long_unique(name: str, pool: str, sizes: list[int], **constraints) -> None:
    """Unique strings of several limbs: the rank's limbs, each shifted three times by a hash of the others."""
    generated(name, [column("v", "STRING", unique=True, **constraints)])
    spaces, k = [len(pool) ** size for size in sizes], key(name, "v")
    rows = over(name).permute("pos", name, "v").nulls("0").let(rest="rank::HUGEINT")
    for place in range(len(sizes) - 1, -1, -1):
        rows.let(**{f"s0_{place}": f"rest % {spaces[place]}", f"rest{place}": f"rest // {spaces[place]}"})
        rows._ctes.append(f"SELECT * EXCLUDE (rest, rest{place}), rest{place} AS rest FROM {rows.name}")
    now = [f"s0_{place}" for place in range(len(sizes))]
    for turn in range(3):
        for place, space in enumerate(spaces):
            stream, others = k + 2 * (turn * len(sizes) + place), now[:place] + now[place + 1 :]
            shifted = f"s{turn + 1}_{place}"
            rows.let(**{shifted: f"({now[place]} + {below(space, stream, *others)}) % {space}"})
            now[place] = shifted
    text = " || ".join(f"({chars(limb, pool, size)})" for limb, size in zip(now, sizes, strict=True))
    ORACLES[name] = rows.select(f"id AS o_orderkey, {text} AS v")


_long_unique("gen_str_unique", LOWER, [10, 6], length=16, case_mode="lower")
_long_unique("gen_str_unique_long", LOWER + UPPER + DIGITS, [8, 8, 8, 6], length=30, character_set="alphanumeric")

# Two digits up to 10^15 are more numbers than there are doubles: hundredths below 2^46, then every double.
_HUNDREDTHS = 2**46 * 100
unique(
    "gen_float_unique_wide", "FLOAT", str(_HUNDREDTHS + int((10**15 - 2**49) * 2**3) + 3 * 2**52 + 1),
    f"CASE WHEN idx < {_HUNDREDTHS} THEN idx::BIGINT::DOUBLE / 100.0::DOUBLE ELSE "
    f"({2**52} + (idx - {_HUNDREDTHS}) % {2**52})::BIGINT::DOUBLE * "
    f"pow(2.0::DOUBLE, ((idx - {_HUNDREDTHS}) // {2**52} - 6)::INT) END",
    min_value=0, max_value=10**15,
)
unique("null_with_unique", "INT", "5000000000", "(7 + idx)::BIGINT", ratio="0.1", null_ratio=0.1, min_value=7, max_value=5_000_000_006)

# Lists of allowed values that are columns of a table: their distinct values, or each as often as it occurs.
def listed(name: str, source: str, **constraints) -> None:
    def run(spark, sf_dir):
        values = read(spark, sf_dir, "lineitem").select(source)
        return synthetic(spark, sf_dir, {source: values}, **{name: ("orders", [column("v", "INT", allowed_from=source, **constraints)])})[name]

    QUERIES[name] = run


def _positions(source: str, rows: str) -> str:
    """The values in the order of their hash buckets and hashes."""
    h = signed(hash_sql(stream_key(SEED, "list", source), "val"))
    bucket = f"(({h}) % buckets + buckets) % buckets"
    return (
        f"d0 AS ({rows}), d1 AS (SELECT val, greatest(1, ((SELECT count(*) FROM lineitem) + 499999) // 500000) AS buckets FROM d0), "
        f"d AS (SELECT val, row_number() OVER (ORDER BY {bucket}, {h}, val) - 1 AS place FROM d1)"
    )


listed("gen_allowed_unique", "l_partkey", unique=True, null_ratio=0.95)
_one_of_a_list = (
    over("gen_allowed_unique").permute("pos", "gen_allowed_unique", "v").nulls("0.95")
    .spread("idx", "(SELECT count(*) FROM d)", key("gen_allowed_unique", "v"))
)
ORACLES["gen_allowed_unique"] = (
    f"WITH {_positions('l_partkey', 'SELECT DISTINCT l_partkey AS val FROM lineitem')}, {_one_of_a_list.ctes()} "
    f"SELECT id AS o_orderkey, CASE WHEN rank >= 0 THEN val END AS v FROM {_one_of_a_list.name} JOIN d ON place = idx"
)

listed("gen_allowed_table", "l_linenumber")
ORACLES["gen_allowed_table"] = (
    f"WITH {_positions('l_linenumber', 'SELECT l_linenumber::BIGINT AS val FROM lineitem')}, drawn AS (SELECT o_orderkey, "
    f"{below('(SELECT count(*) FROM lineitem)', key('gen_allowed_table', 'v'), 'o_orderkey')} AS place FROM orders) "
    "SELECT o_orderkey, val AS v FROM drawn JOIN d USING (place)"
)

# Exact NULL counts: the row keeps its value, the permutation decides which rows lose it.
generated("null_exact", [column("v", "INT", min_value=0, max_value=9, null_ratio=0.29)])
ORACLES["null_exact"] = (
    over("null_exact").permute("pos", "null_exact", "v").nulls("0.29")
    .select(f"id AS o_orderkey, CASE WHEN rank >= 0 THEN ({below(10, key('null_exact', 'v'), 'id')})::BIGINT END AS v")
)

# Derived columns share the source's NULL positions and its unconverted value.
generated(
    "derive_generated",
    [
        column("d", "DATE", "STRING", date_format="%d.%m.%Y", min_value="2021-01-01", max_value="2023-12-31", null_ratio=0.1),
        derived("ymd", "d", "YYYYMMDD", "INT"),
        derived("yyyy", "d", "YYYY", "STRING"),
        derived("mm", "d", "MM", "INT"),
    ],
)
ORACLES["derive_generated"] = (
    over("derive_generated").permute("pos", "derive_generated", "d").nulls("0.1")
    .let(day=f"CASE WHEN rank >= 0 THEN DATE '2021-01-01' + {below(1095, key('derive_generated', 'd'), 'id')}::INT END")
    .select(
        "id AS o_orderkey, strftime(day, '%d.%m.%Y') AS d, strftime(day, '%Y%m%d')::BIGINT AS ymd, "
        "strftime(day, '%Y') AS yyyy, strftime(day, '%m')::BIGINT AS mm"
    )
)

# The final uniqueness check, on a key that does repeat.
QUERIES["unique_violations"] = lambda spark, sf_dir: duplicate_values(
    read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
)
ORACLES["unique_violations"] = (
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
    "WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1"
)
