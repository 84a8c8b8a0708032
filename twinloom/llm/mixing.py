"""Mixing sources to target weights by temperature.

A source's share of all words is raised to an exponent and normalised. The exponent in [0, 1]
(1: natural shares, 0: equal ones) is found by bisection: the largest one that reaches a target
entropy, given as a fraction of the entropy of equal shares, but not below the smallest one that
keeps every source within a limit of repetitions. The limit wins. With no budget given, the
budget is the smallest one that uses every document at least once; a given budget B gives source
s w(s) * B words.

Each source's words are then realised as whole passes over the source and one partial pass. A
pass is a permutation by blocks: a keyed hash deals each document of each pass into a block of
the source, another orders blocks and documents in them. Of the partial pass, documents are taken
in this order as long as the words before them are below the budget that is left. The number of
blocks grows with the source, so a running total needs the totals of blocks and one block at a
time, never a whole source in a task.

Only one row a source reaches the driver. Defined cases: a null text has no words; a null source
is a source of its own; sources without words are kept once; repeated rows count each; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinloom.llm.rows import written

#: Documents of a block, on average.
BLOCK = 1_000


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def tempered(shares: list[float], exponent: float) -> list[float]:
    top = max(shares)
    raised = [(s / top) ** exponent for s in shares]
    return [r / sum(raised) for r in raised]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def bisect(good: Callable[[float], bool], bad_at: float, good_at: float, steps: int = 60) -> float:
    """The end of the good range next to ``bad_at``."""
    if good(bad_at):
        return bad_at
    for _ in range(steps):
        middle = (bad_at + good_at) / 2
        bad_at, good_at = (bad_at, middle) if good(middle) else (middle, good_at)
    return good_at


def solve(words: list[int], target_entropy: float, max_repetition: float, budget: int | None) -> tuple[float, list[float], float]:
    """Exponent, weights and budget for the word counts of the sources, all positive."""
    total = sum(words)
    shares = [w / total for w in words]

    def spent(weights: list[float]) -> float:
        return budget if budget is not None else max(n / w for n, w in zip(words, weights, strict=True))

    def reaches(exponent: float) -> bool:
        return entropy(tempered(shares, exponent)) >= target_entropy * math.log(len(words)) - 1e-12

    def repeats(exponent: float) -> bool:
        weights = tempered(shares, exponent)
        return max(w * spent(weights) / n for n, w in zip(words, weights, strict=True)) <= max_repetition * (1 + 1e-12)

    wanted = bisect(reaches, 1.0, 0.0)
    exponent = wanted if repeats(wanted) else bisect(repeats, wanted, 1.0)
    weights = tempered(shares, exponent)
    return exponent, weights, spent(weights)


def plan(docs: DataFrame, target_entropy: float, max_repetition: float, budget: int | None) -> list[dict]:
    """One dictionary a source: its words, weight and the passes and words it is given."""
    found = docs.groupBy("source").agg(F.sum("n_words").alias("words"), F.count("*").alias("rows")).collect()
    found.sort(key=lambda r: (r.source is not None, r.source or ""))
    full = [r for r in found if r.words]
    out = [{"source": r.source, "passes": 1, "left": 0.0, "weight": 0.0, "blocks": 1 + r.rows // BLOCK} for r in found if not r.words]
    if full:
        _, weights, spent = solve([r.words for r in full], target_entropy, max_repetition, budget)
        for r, weight in zip(full, weights, strict=True):
            passes = int(weight * spent / r.words + 1e-9)
            left = max(0.0, weight * spent - passes * r.words)
            out.append({"source": r.source, "passes": passes, "left": left if left > 1e-6 * r.words else 0.0, "weight": weight, "blocks": 1 + r.rows // BLOCK})
    return out


def mix(
    docs: DataFrame, target_entropy: float = 0.95, max_repetition: float = 2.0, budget: int | None = None, seed: int = 42
) -> DataFrame:
    """Rows (doc, source, n_words, weight, pass, block, place); doc holds all columns of ``docs``.

    ``docs`` is read more than once and must be reproducible, as a table is.
    """
    spark = docs.sparkSession
    source, words = F.col("source").cast("string"), word_count(F.col("text"))
    given = plan(docs.select(source.alias("source"), words.alias("n_words")), target_entropy, max_repetition, budget)
    schema = "source string, passes bigint, left double, weight double, blocks bigint"
    sources = spark.createDataFrame([tuple(g[f.split()[0]] for f in schema.split(", ")) for g in given], schema)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
        source.alias("own_source"),
        words.alias("n_words"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
    )
    rows = rows.join(F.broadcast(sources), F.col("own_source").eqNullSafe(F.col("source")))
    last = F.when(F.col("left") > 0, F.col("passes")).otherwise(F.col("passes") - 1)
    dealt = rows.where(last >= 0).withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    key = [F.lit(seed), "pass", "doc_id", "text_key"]
    dealt = dealt.withColumns(
        {"block": F.pmod(F.xxhash64(F.lit("block"), *key), "blocks"), "place": F.xxhash64(F.lit("place"), *key)}
    )

    partial = F.col("pass") == F.col("passes")
    identity = ["source", "block", "place", "doc_id", "text_key"]
    light = dealt.where(partial).groupBy(*identity, "left").agg(F.sum("n_words").alias("n_words"))
    light = written(light, "partial-passes")
    blocks = light.groupBy("source", "block").agg(F.sum("n_words").alias("total"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    above = Window.partitionBy("source", "block").orderBy("place", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    light = light.withColumn("within", F.coalesce(F.sum("n_words").over(above), F.lit(0)))
    taken = light.join(blocks, _equal(light, blocks, ["source", "block"]))
    taken = taken.where(F.col("before") + F.col("within") < F.col("left")).select(*(light[c] for c in identity))
    taken = written(taken, "taken")

    some = dealt.where(partial)
    some = some.join(taken, _equal(some, taken, identity), "left_semi")
    out = dealt.where(~partial).unionByName(some)
    return out.select("doc", "source", "n_words", "weight", "pass", "block", "place")


def _equal(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[n].eqNullSafe(right[n]) for n in names))


def mixed_corpus(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents with the columns of ``docs``, repeated ones as repeated rows."""
    return mix(docs, **options).select("doc.*")
