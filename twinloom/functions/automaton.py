"""Finite automata of patterns with anchors, word boundaries and look-around.

What may follow a place in a pattern is a term: a language built from characters by
concatenation, union, repetition, intersection and complement. Looking ahead intersects what
follows with the wanted (or the complement of the unwanted) language; looking behind asks an
automaton that runs along over the prefix. The states of the product are terms and their
successors are Brzozowski derivatives, so only states that are reached are ever built. Repeats
are bounded, hence the automaton has no cycles, and the number of strings from each state is exact.

A string is drawn by unranking. Up to ``EXACT`` strings, one index names a string in code point
order. From states with more, each character is drawn on its own, in proportion to the strings
behind it (a share is rounded to 2^-50), until few enough are left.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import functions as F

from twinloom.errors import SpecError, UnsatisfiableError
from twinloom.functions.draws import SINGLE_DRAW_LIMIT, bigint, draw_below
from twinloom.functions.stages import Term, combine

EXACT = SINGLE_DRAW_LIMIT
#: States that a pattern may need; the table of all states is part of the query plan.
MOST_STATES = 20_000

class Language:
    """A term; equal terms are one object, so they are compared and stored by identity."""

    __slots__ = ("kind", "parts")


_made: dict[tuple, Language] = {}


def _term(kind: str, *parts) -> Language:
    found = _made.get((kind, *parts))
    if found is None:
        found = _made[(kind, *parts)] = Language()
        found.kind, found.parts = kind, parts
    return found


NOTHING, EMPTY = _term("nothing"), _term("empty")
ANY = _term("any")  # all strings


def chars(members: frozenset[str]) -> Language:
    return _term("chars", members) if members else NOTHING


def then(first: Language, rest: Language) -> Language:
    if NOTHING in (first, rest):
        return NOTHING
    if first is EMPTY:
        return rest
    if rest is EMPTY:
        return first
    if first.kind == "then":
        return _term("then", first.parts[0], then(first.parts[1], rest))
    return _term("then", first, rest)


def _merged(kind: str, parts) -> frozenset:
    out = set()
    for part in parts:
        out |= part.parts[0] if part.kind == kind else {part}
    return frozenset(out)


def either(*parts: Language) -> Language:
    members = _merged("either", parts) - {NOTHING}
    if ANY in members:
        return ANY
    return _term("either", members) if len(members) > 1 else next(iter(members), NOTHING)


def both(*parts: Language) -> Language:
    members = _merged("both", parts) - {ANY}
    if NOTHING in members:
        return NOTHING
    return _term("both", members) if len(members) > 1 else next(iter(members), ANY)


def none_of(part: Language) -> Language:
    if part.kind == "none_of":
        return part.parts[0]
    return {NOTHING: ANY, ANY: NOTHING}.get(part) or _term("none_of", part)


def repeated(body: Language, low: int, high: int | None) -> Language:
    """``high`` None repeats without limit."""
    if high == 0 or body is EMPTY:
        return EMPTY
    if body is NOTHING:
        return EMPTY if low == 0 else NOTHING
    return body if (low, high) == (1, 1) else _term("repeated", body, low, high)


def behind(number: int, wanted: bool) -> Language:
    """Nothing, provided that the prefix so far is (or is not) in the language of a tracker."""
    return _term("behind", number, wanted)


@dataclass(frozen=True)
class State:
    """One state: strings from it, whether it accepts, and its ordered steps (characters, next state)."""

    count: int
    accepts: bool
    steps: tuple[tuple[str, int], ...]


class Automaton:
    """Of a term and the prefix languages that its ``behind`` terms name; state 0 comes first."""

    def __init__(self, term: Language, trackers: list[Language], alphabet: frozenset[str], pattern: str):
        self._classes = _classes([term, *trackers], alphabet)
        self._derived: dict[tuple, Language] = {}
        found: dict[tuple, int] = {}
        steps: list[list[tuple[str, int]]] = []
        accepts: list[bool] = []
        waiting = [(term, tuple(trackers))]
        found[waiting[0]] = 0
        while waiting:
            here, past = waiting.pop()
            while len(steps) < len(found):
                steps.append([])
                accepts.append(False)
            own = found[here, past]
            truths = tuple(_nullable(t, ()) for t in past)
            accepts[own] = _nullable(here, truths)
            for members in self._classes:
                following = self._after(here, members[0], truths)
                if following == NOTHING:
                    continue
                state = (following, tuple(self._after(t, members[0], ()) for t in past))
                if state not in found:
                    if len(found) >= MOST_STATES:
                        raise SpecError(f"The pattern {pattern!r} needs more than {MOST_STATES} states")
                    found[state] = len(found)
                    waiting.append(state)
                steps[own].append((members, found[state]))
        self.states = _counted(steps, accepts)
        if not self.states:
            raise UnsatisfiableError(f"No string matches {pattern!r}")

    @property
    def count(self) -> int:
        return self.states[0].count

    def _after(self, term: Language, char: str, truths: tuple) -> Language:
        """What may follow ``char`` where the term may stand."""
        kind = term.kind
        if kind in ("nothing", "empty", "behind"):
            return NOTHING
        if kind == "any":
            return ANY
        if kind == "chars":
            return EMPTY if char in term.parts[0] else NOTHING
        key = (term, char, truths)
        if key not in self._derived:
            if kind == "then":
                out = then(self._after(term.parts[0], char, truths), term.parts[1])
                if _nullable(term.parts[0], truths):
                    out = either(out, self._after(term.parts[1], char, truths))
            elif kind == "either":
                out = either(*(self._after(part, char, truths) for part in term.parts[0]))
            elif kind == "both":
                out = both(*(self._after(part, char, truths) for part in term.parts[0]))
            elif kind == "none_of":
                out = none_of(self._after(term.parts[0], char, truths))
            else:
                body, low, high = term.parts
                rest = repeated(body, max(low - 1, 0), None if high is None else high - 1)
                out = then(self._after(body, char, truths), rest)
            self._derived[key] = out
        return self._derived[key]

    def unrank(self, index: int) -> str:
        """The string of this index in code point order."""
        state, text = self.states[0], ""
        while True:
            if state.accepts:
                if index == 0:
                    return text
                index -= 1
            for members, number in state.steps:
                size = self.states[number].count
                if index < len(members) * size:
                    text += members[index // size]
                    index, state = index % size, self.states[number]
                    break
                index -= len(members) * size


def _nullable(term: Language, truths: tuple) -> bool:
    kind = term.kind
    if kind in ("empty", "any"):
        return True
    if kind == "then":
        return _nullable(term.parts[0], truths) and _nullable(term.parts[1], truths)
    if kind == "either":
        return any(_nullable(part, truths) for part in term.parts[0])
    if kind == "both":
        return all(_nullable(part, truths) for part in term.parts[0])
    if kind == "none_of":
        return not _nullable(term.parts[0], truths)
    if kind == "repeated":
        return term.parts[1] == 0 or _nullable(term.parts[0], truths)
    return kind == "behind" and truths[term.parts[0]] is term.parts[1]


def _classes(terms: list[Language], alphabet: frozenset[str]) -> list[str]:
    """Characters that no part of the terms tells apart, together."""
    sets, waiting, seen = [], list(terms), set()
    while waiting:
        term = waiting.pop()
        if term in seen:
            continue
        seen.add(term)
        if term.kind == "chars":
            sets.append(term.parts[0])
        for part in term.parts:
            if isinstance(part, frozenset) and term.kind != "chars":
                waiting += part
            elif isinstance(part, Language):
                waiting.append(part)
    alike: dict[tuple, str] = {}
    for char in sorted(alphabet):
        key = tuple(char in members for members in sets)
        alike[key] = alike.get(key, "") + char
    return list(alike.values())


def _counted(steps: list[list[tuple[str, int]]], accepts: list[bool]) -> tuple[State, ...]:
    """States from which a string can be completed, renumbered, with runs of characters in order."""
    counts: dict[int, int] = {}
    stack = [0]
    while stack:
        own = stack[-1]
        open_ = [number for _, number in steps[own] if number not in counts]
        if open_:
            stack += open_
            continue
        stack.pop()
        counts[own] = int(accepts[own]) + sum(len(members) * counts[number] for members, number in steps[own])
    if not counts[0]:
        return ()
    alive = [number for number in range(len(steps)) if counts.get(number)]
    renumbered = {number: place for place, number in enumerate(alive)}
    states = []
    for number in alive:
        target = {char: renumbered[to] for members, to in steps[number] if counts[to] for char in members}
        runs: list[tuple[str, int]] = []
        for char in sorted(target):
            if runs and runs[-1][1] == target[char]:
                runs[-1] = (runs[-1][0] + char, target[char])
            else:
                runs.append((char, target[char]))
        states.append(State(counts[number], accepts[number], tuple(runs)))
    return tuple(states)


def _longest(states: tuple[State, ...]) -> int:
    depth: dict[int, int] = {}
    stack = [0]
    while stack:
        own = stack[-1]
        open_ = [number for _, number in states[own].steps if number not in depth]
        if open_:
            stack += open_
            continue
        stack.pop()
        depth[own] = max((1 + depth[number] for _, number in states[own].steps), default=0)
    return depth[0]


_TABLE = "array<struct<starts:array<bigint>,units:array<bigint>,nexts:array<int>,runs:array<string>,wide:boolean,size:bigint>>"


def _table(states: tuple[State, ...]) -> list[dict]:
    """For each state the places where its choices start, what one character of each is worth, and where it leads."""
    rows = []
    for state in states:
        shift = max(0, state.count.bit_length() - (EXACT.bit_length() - 1))
        starts, units, nexts, runs, at = [], [], [], [], 0
        choices = [("", -1, 1)] if state.accepts else []
        choices += [(members, number, states[number].count) for members, number in state.steps]
        for members, number, worth in choices:
            unit = max(1, worth >> shift)
            starts.append(at)
            units.append(unit)
            nexts.append(number)
            runs.append(members)
            at += unit * max(1, len(members))
        rows.append({"starts": starts, "units": units, "nexts": nexts, "runs": runs, "wide": shift > 0, "size": at})
    return rows


def drawn_text(automaton: Automaton, key: int, row: Term) -> Term:
    """A string of the automaton for each row."""
    rows = _table(automaton.states)
    steps = _longest(automaton.states) + 1
    any_wide = any(row_["wide"] for row_ in rows)
    table = F.from_json(F.lit(json.dumps(rows)), _TABLE)

    def build(row_id):
        start = F.struct(
            F.lit(0).alias("state"), draw_below(rows[0]["size"], key, row_id).cast("bigint").alias("rest"), F.lit("").alias("text")
        )

        def step(so_far, number):
            here = F.get(table, so_far["state"])
            choice = F.size(F.filter(here["starts"], lambda at: at <= so_far["rest"])) - 1
            unit, following = F.get(here["units"], choice), F.get(here["nexts"], choice)
            offset = so_far["rest"] - F.get(here["starts"], choice)
            place = F.call_function("div", offset, unit)
            rest = offset % unit
            if any_wide:
                fresh = F.pmod(F.xxhash64(bigint(key ^ 1), row_id, number), F.greatest(F.get(table, following)["size"], bigint(1)))
                rest = F.when(here["wide"] & (following >= 0), fresh).otherwise(rest)
            char = F.substring(F.get(here["runs"], choice), (place + 1).cast("int"), F.lit(1))
            moved = F.struct(following.alias("state"), rest.alias("rest"), F.concat(so_far["text"], char).alias("text"))
            return F.when(so_far["state"] < 0, so_far).otherwise(moved)

        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)["text"]

    return combine(build, row)


def exact_members(source: str, pool: str, alphabet: frozenset[str]) -> frozenset[str]:
    """The characters of the alphabet that a one-character expression matches."""
    form = re.compile(source)
    return frozenset(char for char in alphabet if char in pool or form.fullmatch(char))

