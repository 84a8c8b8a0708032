"""Named intermediate columns.

A permutation round or a long draw is used several times by the expression above it.
Inlining it would multiply the expression tree; giving it a name in an earlier ``select``
keeps the tree linear. Catalyst keeps such a select when its output is used more than
once and fuses all of them into one whole-stage-codegen span, so no data moves.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Term:
    """A column expression and the select it can be evaluated in."""

    column: Column
    depth: int
    name: str | None = None


def combine(build: Callable[..., Column], *terms: Term) -> Term:
    return Term(build(*(term.column for term in terms)), max(term.depth for term in terms))


class Stages:
    def __init__(self) -> None:
        self._layers: list[list[Column]] = []
        self._count = 0

    def let(self, term: Term, pinned: bool = False) -> Term:
        """Evaluate the term once, under a name, and return a reference to it.

        A filter above is normally rewritten in terms of the columns below, which would
        inline the term again, once per use in every round of a permutation. A pinned
        integer term also reads the partition id (times zero): the value is unchanged, but
        Catalyst does not move or copy an expression that it must treat as stateful.
        """
        if pinned:
            term = Term(term.column + F.spark_partition_id() * F.lit(0), term.depth)
        while len(self._layers) <= term.depth:
            self._layers.append([])
        name = f"__step{self._count}"
        self._count += 1
        self._layers[term.depth].append(term.column.alias(name))
        return Term(F.col(name), term.depth + 1, name)

    def apply(self, rows: DataFrame) -> DataFrame:
        for layer in self._layers:
            if layer:
                rows = rows.select("*", *layer)
        return rows
