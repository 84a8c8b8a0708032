"""Strings that match a regular expression, as a plain column expression.

The pattern is read once on the driver, after the standard library has found it valid; each
node becomes a draw, so generation stays inside Spark. A pattern with anchors inside, word
boundaries or look-around becomes a finite automaton, whose strings are drawn by index. Every
string matches the whole pattern; a pattern that no string matches is refused. A repeat without
an upper limit stops at a given number of times.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinloom.errors import SpecError
from twinloom.functions import automaton as am
from twinloom.functions.draws import bigint, draw_below, pick
from twinloom.functions.stages import Stages, Term, combine
from twinloom.functions.text import pool_array, random_text

# Single-class patterns that are treated as a character pool.
CLASS_POOLS = {
    "[0-9]": string.digits,
    "[A-Z]": string.ascii_uppercase,
    "[a-z]": string.ascii_lowercase,
    "[A-Za-z]": string.ascii_letters,
    "[A-Z0-9]": string.ascii_uppercase + string.digits,
    "[a-z0-9]": string.ascii_lowercase + string.digits,
    "[A-Za-z0-9]": string.ascii_letters + string.digits,
}

# What a class escape may produce.
_WORD = string.ascii_letters + string.digits + "_"
_ESCAPED_CLASSES = {
    "d": string.digits,
    "s": string.whitespace,
    "w": _WORD,
    "D": "".join(c for c in string.printable if c not in string.digits),
    "S": "".join(c for c in string.printable if c not in string.whitespace),
    "W": "".join(c for c in string.printable if c not in _WORD),
}
_ESCAPED_CHARS = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v", "a": "\a"}
_HEX_LENGTH = {"x": 2, "u": 4, "U": 8}


@dataclass(frozen=True)
class Chars:
    """One character of a pool; an entry that occurs twice counts twice. ``source`` is its spelling."""

    pool: str
    source: str = field(default="", compare=False)


@dataclass(frozen=True)
class Branch:
    options: tuple[tuple, ...]


@dataclass(frozen=True)
class Group:
    number: int
    body: tuple


@dataclass(frozen=True)
class Same:
    """A back-reference."""

    number: int


@dataclass(frozen=True)
class Repeat:
    low: int
    high: int | None
    body: tuple


@dataclass(frozen=True)
class Edge:
    """An assertion about a place: ``start``, ``end`` (before a last line feed too), ``stop``, ``word`` or ``inside``."""

    kind: str


@dataclass(frozen=True)
class Look:
    """An assertion about what follows a place or comes before it."""

    ahead: bool
    wanted: bool
    body: tuple


_EDGES = {"^": "start", "$": "end", "A": "start", "Z": "stop", "b": "word", "B": "inside"}

#: Where a repeat without an upper limit stops unless the column says otherwise.
UNBOUNDED_REPEAT = 100
_UNROLLED_CHARS = 32
_UNROLLED_DIGITS = 128


def single_class(pattern: str) -> tuple[str, int] | None:
    """``(pool, length)`` when the whole pattern is ``^[class]{n}$`` with a known class."""
    for spelling, pool in CLASS_POOLS.items():
        prefix = f"^{spelling}{{"
        count = pattern.removeprefix(prefix).removesuffix("}$")
        if pattern == f"{prefix}{count}}}$" and count.isascii() and count.isdigit():
            return pool, int(count)
    return None


def parse_pattern(pattern: str) -> tuple:
    """The pattern as a sequence of nodes; what cannot be generated is refused."""
    try:
        compiled = re.compile(pattern)
    except re.error as error:
        raise SpecError(f"Invalid regular expression {pattern!r}: {error}") from error
    return _Reader(pattern, compiled.groupindex).whole()


class _Reader:
    """Reads a pattern that is known to be valid, so it need not report syntax errors."""

    def __init__(self, pattern: str, names: Mapping[str, int]) -> None:
        self._text, self._names, self._at, self._groups = pattern, names, 0, 0

    def whole(self) -> tuple:
        return self._options()

    def _next(self) -> str:
        self._at += 1
        return self._text[self._at - 1]

    def _take(self, form: str) -> re.Match | None:
        found = re.compile(form, re.DOTALL).match(self._text, self._at)
        self._at = found.end() if found else self._at
        return found

    def _options(self) -> tuple:
        options = [self._sequence()]
        while self._take(r"\|"):
            options.append(self._sequence())
        return options[0] if len(options) == 1 else (Branch(tuple(options)),)

    def _sequence(self) -> tuple:
        nodes: list = []
        while self._at < len(self._text) and self._text[self._at] not in "|)":
            piece = self._item()
            bounds = self._bounds() if piece is not None else None
            if bounds is not None:
                piece = (Repeat(*bounds, piece),)
            nodes += piece or ()
        return tuple(nodes)

    def _bounds(self) -> tuple[int, int | None] | None:
        """Limits of a quantifier; whether it is greedy makes no difference to what it may match."""
        found = self._take(r"(?:([*+?])|\{(\d+)\}|\{(?=[\d,])(?!,\})(\d*),(\d*)\})[?+]?")
        if not found:
            return None
        sign, exact, low, high = found.groups()
        if sign:
            return {"*": (0, None), "+": (1, None), "?": (0, 1)}[sign]
        if exact:
            return int(exact), int(exact)
        return int(low or 0), int(high) if high else None

    def _item(self) -> tuple | None:
        """The nodes of one item, none for a comment."""
        begun, char = self._at, self._next()
        if char in "^$":
            return (Edge(_EDGES[char]),)
        if char == ".":
            return (Chars(string.printable.replace("\n", ""), "."),)
        if char == "[":
            pool = self._class()
            return (Chars(pool, self._text[begun : self._at]),)
        if char == "(":
            return self._group()
        return self._escape() if char == "\\" else (Chars(char, re.escape(char)),)

    def _group(self) -> tuple | None:
        if self._take(r"\?#[^)]*\)"):
            return None
        if same := self._take(r"\?P=(\w+)\)"):
            return (Same(self._names[same[1]]),)
        if look := self._take(r"\?(<?)([=!])"):
            body = self._options()
            self._next()
            return (Look(not look[1], look[2] == "=", body),)
        plain = self._take(r"\?[:>]")
        if not plain and not self._take(r"\?P<\w+>") and self._take(r"\?"):
            raise SpecError(f"Conditions and flags are not supported: {self._text!r}")
        number = None
        if not plain:
            self._groups += 1
            number = self._groups
        body = self._options()
        self._next()
        return body if number is None else (Group(number, body),)

    def _escape(self) -> tuple | None:
        begun, char = self._at - 1, self._next()
        if char in _EDGES:
            return (Edge(_EDGES[char]),)
        if char in "123456789":
            octal = self._take(r"[0-7]{2}") if char in "123" else None
            if octal:
                return (Chars(chr(int(char + octal[0], 8)), self._text[begun : self._at]),)
            more = self._take(r"\d")
            return (Same(int(char + (more[0] if more else ""))),)
        pool = self._escaped(char)
        return (Chars(pool, self._text[begun : self._at]),)

    def _escaped(self, char: str) -> str:
        """The pool behind an escape that stands for characters."""
        if char in _ESCAPED_CLASSES:
            return _ESCAPED_CLASSES[char]
        if char in _HEX_LENGTH:
            return chr(int(self._take("[0-9A-Fa-f]" * _HEX_LENGTH[char])[0], 16))
        if char == "N":
            return unicodedata.lookup(self._take(r"\{([^}]*)\}")[1])
        if char in "01234567":
            return chr(int(char + self._take("[0-7]{0,2}")[0], 8))
        return _ESCAPED_CHARS.get(char, char)

    def _class(self) -> str:
        negated, pool, first = bool(self._take(r"\^")), "", True
        while first or self._text[self._at] != "]":
            first, low = False, self._member()
            if len(low) == 1 and self._take(r"-(?!\])"):
                low = "".join(map(chr, range(ord(low), ord(self._member()) + 1)))
            pool += low
        self._next()
        if negated:
            pool = "".join(c for c in string.printable if c not in pool)
        if not pool:
            raise SpecError("A regular expression class matches no printable character")
        return pool

    def _member(self) -> str:
        char = self._next()
        if char != "\\":
            return char
        char = self._next()
        return "\b" if char == "b" else self._escaped(char)


def _open_ended(nodes: tuple) -> tuple:
    """Without the anchors at either end, which hold for a whole match anyway."""
    nodes = tuple(nodes)
    while nodes and nodes[0] == Edge("start"):
        nodes = nodes[1:]
    while nodes and nodes[-1] in (Edge("end"), Edge("stop")):
        nodes = nodes[:-1]
    if len(nodes) == 1 and isinstance(nodes[0], Branch):
        return (Branch(tuple(_open_ended(option) for option in nodes[0].options)),)
    if len(nodes) == 1 and isinstance(nodes[0], Group):
        return (Group(nodes[0].number, _open_ended(nodes[0].body)),)
    return nodes


def _holds(nodes, kinds) -> bool:
    """Whether a node of one of the kinds is anywhere in the nodes."""
    for node in nodes:
        if isinstance(node, kinds):
            return True
        parts = node.options if isinstance(node, Branch) else (getattr(node, "body", ()),)
        if any(_holds(part, kinds) for part in parts):
            return True
    return False


@lru_cache(maxsize=256)
def read_pattern(pattern: str, most: int = UNBOUNDED_REPEAT) -> tuple | am.Automaton:
    """What the pattern is drawn from: its nodes or, with assertions inside, its automaton."""
    nodes = _open_ended(parse_pattern(pattern))
    if not _holds(nodes, (Edge, Look)):
        return nodes
    if _holds(nodes, (Same,)):
        raise SpecError(f"A back-reference beside an assertion is not supported: {pattern!r}")
    return _Terms(nodes, most).automaton(pattern)


class _Terms:
    """Turns nodes into terms of an automaton, each with what may follow it."""

    def __init__(self, nodes: tuple, most: int) -> None:
        self._nodes, self._most, self._trackers = nodes, most, []
        asserted = frozenset("".join(self._pools(nodes, True)))
        self._alphabet = frozenset("".join(self._pools(nodes, False))) | asserted
        self._asserted = asserted

    def automaton(self, pattern: str) -> am.Automaton:
        term = self._sequence(self._nodes, am.EMPTY, False)
        return am.Automaton(term, self._trackers, self._alphabet, pattern)

    def _pools(self, nodes, asserted: bool, within: bool = False):
        """The pools of the characters inside, or outside, assertions."""
        for node in nodes:
            if isinstance(node, Chars) and within is asserted:
                yield node.pool
            parts = node.options if isinstance(node, Branch) else (getattr(node, "body", ()),)
            for part in parts:
                yield from self._pools(part, asserted, within or isinstance(node, Look))

    def _sequence(self, nodes, after: am.Language, exact: bool) -> am.Language:
        for node in reversed(nodes):
            after = self._node(node, after, exact)
        return after

    def _node(self, node, after: am.Language, exact: bool) -> am.Language:
        if isinstance(node, Chars):
            return am.then(am.chars(self._members(node, exact)), after)
        if isinstance(node, Branch):
            return am.either(*(self._sequence(option, after, exact) for option in node.options))
        if isinstance(node, Group):
            return self._sequence(node.body, after, exact)
        if isinstance(node, Repeat):
            return self._repeat(node, after, exact)
        if isinstance(node, Look):
            return self._look(node, after)
        return self._edge(node.kind, after)

    def _members(self, node: Chars, exact: bool) -> frozenset[str]:
        """Outside assertions a class yields its pool, and what assertions name if it matches that."""
        known = self._alphabet if exact else frozenset(node.pool) | self._asserted
        return am.exact_members(node.source, "" if exact else node.pool, known)

    def _repeat(self, node: Repeat, after: am.Language, exact: bool) -> am.Language:
        high = node.high
        if high is None and not exact:
            high = max(node.low, self._most)
        if not _holds(node.body, (Edge, Look)):
            return am.then(am.repeated(self._sequence(node.body, am.EMPTY, exact), node.low, high), after)
        rounds = max(node.low, self._most) if high is None else high
        term = after
        for done in range(rounds - 1, -1, -1):
            term = self._sequence(node.body, term, exact)
            term = am.either(term, after) if done >= node.low else term
        return term

    def _look(self, node: Look, after: am.Language) -> am.Language:
        if not node.ahead:
            if _holds(node.body, (Edge, Look)):
                raise SpecError("An assertion inside a look-behind is not supported")
            prefix = am.then(am.ANY, self._sequence(node.body, am.EMPTY, True))
            return am.then(self._behind(prefix, node.wanted), after)
        follows = self._sequence(node.body, am.ANY, True)
        return am.both(follows if node.wanted else am.none_of(follows), after)

    def _behind(self, prefix: am.Language, wanted: bool) -> am.Language:
        if prefix not in self._trackers:
            self._trackers.append(prefix)
        return am.behind(self._trackers.index(prefix), wanted)

    def _edge(self, kind: str, after: am.Language) -> am.Language:
        if kind == "start":
            return am.then(self._behind(am.EMPTY, True), after)
        if kind == "stop":
            return am.both(am.EMPTY, after)
        if kind == "end":
            return am.both(am.either(am.EMPTY, am.chars(frozenset("\n"))), after)
        word = am.chars(am.exact_members(r"\w", "", self._alphabet))
        before, follows = am.then(am.ANY, word), am.then(word, am.ANY)
        ways = []
        for here in (True, False):
            next_is = here if kind == "inside" else not here
            ways.append(am.then(self._behind(before, here), am.both(follows if next_is else am.none_of(follows), after)))
        return am.either(*ways)


def pattern_text(stages: Stages, pattern: str, key: int, row: Term, most: int = UNBOUNDED_REPEAT) -> Term:
    found = read_pattern(pattern, most)
    if isinstance(found, am.Automaton):
        return am.drawn_text(found, key, row)
    return _PatternWriter(stages, key, most).sequence(found, [row])


class _PatternWriter:
    def __init__(self, stages: Stages, key: int, most: int) -> None:
        self._stages = stages
        self._most = most
        self._key = key
        self._groups: dict[int, tuple[int, Term]] = {}

    def _next_key(self) -> int:
        self._key += 1 << 20
        return self._key

    def sequence(self, nodes, scope: list[Term]) -> Term:
        parts = [self._node(node, scope) for node in nodes]
        if not parts:
            return combine(lambda *_: F.lit(""), *scope)
        return parts[0] if len(parts) == 1 else combine(lambda *texts: F.concat(*texts), *parts)

    def _node(self, node, scope: list[Term]) -> Term:
        if isinstance(node, Chars):
            return self._characters(node.pool, 1, scope)
        if isinstance(node, Branch):
            options = [self.sequence(branch, scope) for branch in node.options]
            key = self._next_key()
            return combine(
                lambda *cols: pick(list(cols[len(scope):]), key, *cols[: len(scope)]), *scope, *options
            )
        if isinstance(node, Group):
            text = self.sequence(node.body, scope)
            if len(scope) == 1:
                text = self._stages.let(text)
            self._groups[node.number] = (len(scope), text)
            return text
        if isinstance(node, Same):
            level, text = self._groups[node.number]
            if level > len(scope):
                raise SpecError("A back-reference to a group inside a repeat is not supported")
            return text
        return self._repeat(node.low, node.high, node.body, scope)

    def _characters(self, pool: str, length: int, scope: list[Term]) -> Term:
        if len(pool) == 1:
            return combine(lambda *_: F.lit(pool * length), *scope)
        key = self._next_key()
        if len(scope) == 1:
            return random_text(self._stages, pool, length, key, scope[0])
        return combine(
            lambda *ids: F.concat(
                *(
                    F.get(pool_array(pool), draw_below(len(pool), key + 2 * n, *ids).cast("int"))
                    for n in range(length)
                )
            ),
            *scope,
        )

    def _repeat(self, low: int, high: int | None, body: tuple, scope: list[Term]) -> Term:
        high = max(low, self._most) if high is None else high
        if high == 0:
            return combine(lambda *_: F.lit(""), *scope)
        pool = body[0].pool if len(body) == 1 and isinstance(body[0], Chars) else None
        unrolled = _UNROLLED_DIGITS if pool == string.digits else _UNROLLED_CHARS
        if pool is not None and low == high and (len(pool) == 1 or high <= unrolled):
            return self._characters(pool, high, scope)

        count_key = self._next_key()
        count = combine(
            lambda *ids: (draw_below(high - low + 1, count_key, *ids) + bigint(low)).cast("int"), *scope
        )
        if pool is not None and (len(pool) == 1 or high <= unrolled):
            whole = self._characters(pool, high, scope)
            return combine(lambda text, size: F.left(text, size), whole, count)

        if len(scope) == 1:
            count = self._stages.let(count)
        # The lambda body must see only columns, so its own terms are not staged.
        depth = max(term.depth for term in (*scope, count))
        groups = dict(self._groups)

        def body_text(position: Column) -> Column:
            return self.sequence(body, [*scope, Term(position.cast("bigint"), depth)]).column

        text = F.when(count.column == 0, F.lit("")).otherwise(
            F.array_join(F.transform(F.sequence(F.lit(1), count.column), body_text), "")
        )
        inner = max((t.depth for n, (_, t) in self._groups.items() if n not in groups), default=0)
        return Term(text, max(depth, inner))
