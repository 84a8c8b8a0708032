"""Hierarchical Pitman-Yor language model, seated by Gibbs sampling and scored by mean predictions.

The root restaurant holds all words; its base is diffuse, so it has one table a word, and the mass
of its new tables is the probability of the one unknown word. Below it is one restaurant for each
previous word, known by its 64-bit hash, so that the model grows with the corpus; all share the root
as parent: a customer who opens a table there becomes a customer of the root.

Words are dealt to shards by hash, so that all restaurants' customers of a word, and its customers
at the root, are in one shard. Words that would fill two shards or more are dealt by word and
context to pieces of half a shard, and their number at the root is kept centrally; there are at most half
as many of them as shards. What couples shards are the totals of the restaurants. Each shard sends its restaurants' sums
in packed ranges of the hash; a task sums a range over all shards and returns to each of them the
totals of its own restaurants, in its order. Shards sweep with the totals of the round before, as in
distributed topic models, corrected by what they changed themselves. In a sweep all customers of each cell (restaurant, word) sit anew: predictions
need the number of a cell's tables only, so who sits where is summed out (generalised Stirling
numbers) and the number is drawn given all others, whatever the cell's size. The seating is written
after each of ``ROUNDS`` exchanges and the next one goes on from there. The predictive
probabilities of several sweeps are averaged before the logarithm is taken.

Texts are tokenised once for the words that fill much and once for the shards. A map task emits its
tokens by partition in packed arrays (4 bytes a token, 12 a distinct word and 8 a distinct context).
A cell that a step has often is one token there, with its number of customers and a text number of
its own; how often each text has it stays with the step's documents, whose sums it joins at the end.
So no shard holds a common pair of words token by token. The arrays are shuffled once, split into shards and written in buckets; later rounds read these where
they lie, and only the seating and the totals travel. Scores come back as sparse sums by document.

Defined cases: a null or empty text is the end token alone; a null doc_id belongs to training
unless the caller's condition says otherwise; repeated rows count each; other columns are ignored;
without training texts every word is unknown; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinloom.llm.rows import written
from twinloom.llm.words import Words, mixed, rolling, steps, text_bytes
from twinloom.session import session_conf, shared_folder

#: Tokens up to which a word is never dealt over several shards.
WHOLE = 1 << 18
STEP_BYTES, STEP_TEXTS = 3 << 20, 1 << 14
#: A cell goes through a step as one token if the step has MANY of it, and the corpus HEAVY at this rate.
HEAVY, MANY = 1 << 16, 32
#: Shards of each shuffle partition; one is held in memory at a time.
SHARDS = 12
#: What a round shuffles goes when its result is written.
_CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Ranges of restaurants: one for so many entries of shards, but each shard sends to RANGES and one for SHARDS partitions at most.
ENTRIES, RANGES = 1 << 20, 256
END, START = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)
HELD = np.uint16(1 << 15)
#: Text numbers of a step from which on they mean such cells.
OFTEN = np.uint16(STEP_TEXTS)
#: Exchanges of totals, sweeps before each of them, sweeps before samples are taken, and samples.
ROUNDS, EXCHANGE, BURN_IN, SAMPLES = 3, 2, 1, 3
#: Cells up to ENUMERATED customers draw their tables from all numbers, larger ones by STEPS Metropolis steps.
ENUMERATED, STEPS = 64, 12
#: Customers up to which Stirling numbers are tabulated; beyond, a saddle point gives them.
TABULATED = 1024


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, Words]]:
    """Texts of a batch by steps of bounded bytes and number."""
    data, offsets = text_bytes(batch.column(column))
    for a, b in steps(offsets, STEP_BYTES):
        for i in range(a, b, STEP_TEXTS):
            j = min(b, i + STEP_TEXTS)
            yield i, j, Words(data, offsets[i : j + 1], lower=True)


def _frequent(docs: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Words of many tokens that would fill two shards, about how often they occur, and the number of all tokens.

    This decides where words are counted only.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in _pieces(batch, 0):
                values, counts = np.unique(words.hashes(), return_counts=True)
                total = len(words.starts) + b - a
                many = counts >= total / shards
                values, counts = np.append(values[many], np.array([0, END], np.uint64)), np.append(counts[many], [total, b - a])
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["word", "n"])

    found = docs.select("text").mapInArrow(work, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = written(found, "frequent")
    total = found.where("word = 0").agg(F.sum("n")).first()[0] or 0
    kept = found.where(f"word <> 0 AND n >= {max(WHOLE, 2 * total / shards)}").collect()
    words, counts = np.array([row.word for row in kept], np.int64).view(np.uint64), np.array([row.n for row in kept], np.int64)
    order = np.argsort(words)
    return words[order], counts[order], total


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _homes(docs: DataFrame, shards: int, partitions: int) -> np.ndarray:
    """For each shard the first one of its partition, under which Spark's hash sends tokens there."""
    numbers = docs.sparkSession.range(shards).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(partitions)).alias("at"), "id")
    at = np.array([r.at for r in numbers.orderBy("id").collect()])  # as many as shards
    _, first, which = np.unique(at, return_index=True, return_inverse=True)
    return first[which].astype(np.int32)


@dataclass
class Deal:
    """Which shard a token goes to, and the first shard of its partition.

    A frequent word goes to as many pieces as it would fill half shards, so that shards tell each other of few words.
    """

    homes: np.ndarray
    frequent: np.ndarray
    counts: np.ndarray
    tokens: int
    heavy: int = HEAVY

    def __post_init__(self):
        self.pieces = np.ceil(2 * len(self.homes) * self.counts / max(self.tokens, 1)).astype(np.uint64)

    def shard(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        place = mixed(word)
        if len(self.frequent):
            spread = np.flatnonzero(_is_in(word, self.frequent))
            piece = context[spread] % self.pieces[np.searchsorted(self.frequent, word[spread])]
            place[spread] = mixed(word[spread] + piece)
        return ((place >> np.uint64(32)) % np.uint64(len(self.homes))).astype(np.int32)

    def often(self, tokens: int) -> int:
        """Tokens of a cell from which on it is one token of a step of so many tokens."""
        return max(MANY, -(-self.heavy * tokens // max(self.tokens, 1)), -(-tokens // int(HELD - OFTEN)))


def _often(word: np.ndarray, context: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of cells that occur so many times: their places, the cell's number, and a token of each cell."""
    pair = word + context
    values = np.sort(pair)
    values = values[least - 1 :][values[least - 1 :] == values[: max(len(values) - least + 1, 0)]]
    values = values[np.diff(values, prepend=~values[:1]) != 0]
    place = np.flatnonzero(_is_in(pair, values))
    cell = np.searchsorted(values, pair[place])
    first = np.zeros(len(values), np.int64)
    first[cell[::-1]] = place[::-1]
    same = (word[place] == word[first[cell]]) & (context[place] == context[first[cell]])  # not by the sum only
    return place[same], cell[same], first


def _cells_by_text(cell: np.ndarray, text: np.ndarray, cells: int) -> bytes:
    """How many texts have each cell, how often each of them, and which."""
    pairs, counts = np.unique(cell << 16 | text, return_counts=True)
    sizes = np.bincount(pairs >> 16, minlength=cells)
    return b"".join(np.asarray(x).astype(k).tobytes() for x, k in ((cells, np.uint32), (sizes, np.uint32), (counts, np.uint32), (pairs & 0xFFFF, np.uint16)))


def _add_cells(sums: np.ndarray, texts: int, packed: bytes) -> None:
    """Add the sums of often met cells, at ``OFTEN`` and after, to those of the texts that have them."""
    cells = int(np.frombuffer(packed, np.uint32, 1)[0])
    sizes = np.frombuffer(packed, np.uint32, cells, 4)
    entries = int(sizes.sum())
    counts = np.frombuffer(packed, np.uint32, entries, 4 + 4 * cells)
    text = np.frombuffer(packed, np.uint16, entries, 4 + 4 * cells + 4 * entries)
    for row in sums:
        row[:texts] += np.bincount(text, counts * np.repeat(row[OFTEN : OFTEN + cells], sizes), texts)


def _packed(docs: DataFrame, deal: Deal) -> DataFrame:
    """Tokens by partition (its first shard) and step; rows of shards below 0 describe the documents of a step."""
    shards = len(deal.homes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = TaskContext.get().partitionId() << 32
        for batch in batches:
            held = np.asarray(batch.column(2).fill_null(False))
            for a, b, words in _pieces(batch, 1):
                texts = b - a
                ends = words.bounds[1:] + np.arange(texts)
                word = np.insert(words.hashes(), words.bounds[1:], END)
                text = np.insert(words.texts(), words.bounds[1:], np.arange(texts))
                before = np.empty_like(word)
                before[1:] = word[:-1]
                before[np.append(0, ends[:-1] + 1)] = START
                context = mixed(before)
                place, cell, first = _often(word, context, deal.often(len(word)))
                cells = _cells_by_text(cell, text[place], len(first))
                weights = np.bincount(cell, ~held[a:b][text[place]], len(first)).astype(np.uint32)
                text = text.astype(np.uint16) | np.where(held[a:b], HELD, np.uint16(0))[text]
                if len(place):
                    single = np.ones(len(word), bool)
                    single[place] = False
                    word, context = (np.append(x[single], x[first]) for x in (word, context))
                    text = np.append(text[single], OFTEN + np.arange(len(first), dtype=np.uint16))
                home = deal.homes[deal.shard(word, context)]
                order = np.lexsort((word, home))
                home, word, context, text = home[order], word[order], context[order], text[order]
                cut = np.flatnonzero(np.diff(home, prepend=-1))
                place = np.flatnonzero(_is_often(text))
                weights, until = weights[text[place] - OFTEN], np.searchsorted(place, np.append(cut, len(home)))
                ids = np.asarray(batch.column(0).slice(a, texts).fill_null(0)).astype(np.int64)
                null = np.asarray(batch.column(0).slice(a, texts).is_null())
                rows = [(-1 - (step + (step >> 32)) % shards, step, ids, null, (words.counts + 1).astype(np.int64), held[a:b], np.frombuffer(cells, np.uint8), weights[:0])]
                for s, e, i, j in zip(cut, np.append(cut[1:], len(home)), until, until[1:], strict=False):
                    new = np.flatnonzero(word[s:e] != np.append(~word[s : s + 1], word[s : e - 1]))
                    counts = np.diff(np.append(new, e - s)).astype(np.uint32)
                    restaurants, at = np.unique(context[s:e], return_inverse=True)
                    at = at.astype(np.uint16 if len(restaurants) <= 1 << 16 else np.uint32)
                    rows.append((int(home[s]), step, word[s:e][new], counts, at, text[s:e], restaurants, weights[i:j]))
                columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())]
                columns += [pa.array([np.ascontiguousarray(r[i]).tobytes() for r in rows], pa.binary()) for i in range(2, 8)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "step", "words", "counts", "contexts", "texts", "restaurants", "weights"])
                step += 1

    schema = "shard int, step bigint, words binary, counts binary, contexts binary, texts binary, restaurants binary, weights binary"
    return docs.select("doc_id", "text", "held_out").mapInArrow(work, schema)


_ARRAYS = {"word": np.uint64, "cells": np.uint32, "context": np.uint32, "trained": np.uint32, "used": np.uint32, "step": np.int64, "of_step": np.uint32, "text": np.uint16, "restaurant": np.uint64}
#: A row with ``about`` describes the documents of that step instead: ids, nulls, token counts, held out, and as ``step`` the cells met often.
_SHARD = "shard int, about bigint, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def _is_often(text: np.ndarray) -> np.ndarray:
    return (text & (HELD - np.uint16(1))) >= OFTEN


def _shards(packed: DataFrame, deal: Deal, partitions: int) -> DataFrame:
    """One row a shard: its words, each word's cells by context, each cell's counts and uses, and its restaurants."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for home, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if home >= 0:
                    for shard, part in _split(rest, deal):
                        held.setdefault(shard, []).append(part)
                else:
                    yield _shard_batch([home, *rest[:5], None, rest[5], None, None, None])
        for shard in sorted(held):
            parts = held.pop(shard)
            counts = np.concatenate([p[2] for p in parts])
            word = np.repeat(np.concatenate([p[1] for p in parts]), counts)
            restaurant, at = np.unique(np.concatenate([p[5] for p in parts]), return_inverse=True)
            ends = np.cumsum([len(p[5]) for p in parts])
            context = np.concatenate([at[e - len(p[5]) : e][p[3]] for p, e in zip(parts, ends, strict=True)])
            text = np.concatenate([p[4] for p in parts])
            of_step = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p[4]) for p in parts])
            weight = (text < HELD).astype(np.uint32)
            weight[_is_often(text)] = np.concatenate([p[6] for p in parts])
            order = np.lexsort((context, word))
            word, context, text, of_step, weight = word[order], context[order], text[order], of_step[order], weight[order]
            new_word = np.diff(word, prepend=~word[:1]) != 0
            new_cell = new_word | (np.diff(context, prepend=-1) != 0)
            first = np.flatnonzero(new_cell)
            used = np.diff(np.append(first, len(word)))
            trained = np.add.reduceat(weight, first)
            cells = np.diff(np.append(np.flatnonzero(new_word[first]), len(first)))
            step = np.array([p[0] for p in parts], np.int64)
            arrays = dict(word=word[new_word], cells=cells, context=context[first], trained=trained, used=used, step=step, of_step=of_step, text=text, restaurant=restaurant)
            yield _shard_batch([shard, None, *(np.ascontiguousarray(arrays[n], t).tobytes() for n, t in _ARRAYS.items())])

    return packed.repartition(partitions, "shard").mapInArrow(work, _SHARD)


def _split(row: list, deal: Deal) -> Iterator[tuple[int, tuple]]:
    """A step's tokens of one partition by shard: step, words, counts, contexts, texts, restaurants, weights."""
    step, words, counts, contexts, texts, restaurants, weights = row
    words, counts, text, restaurants, weights = (np.frombuffer(x, t) for x, t in ((words, np.uint64), (counts, np.uint32), (texts, np.uint16), (restaurants, np.uint64), (weights, np.uint32)))
    context = np.frombuffer(contexts, f"u{2 * len(contexts) // len(texts)}")
    word = np.repeat(np.arange(len(words), dtype=np.uint32), counts)
    shard = deal.shard(words[word], restaurants[context])
    order = np.argsort(shard, kind="stable")
    place = np.cumsum(_is_often(text))[order] - 1
    shard, word, context, text = shard[order], word[order], context[order], text[order]
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    often = np.flatnonzero(_is_often(text))
    weights, until = weights[place[often]], np.searchsorted(often, np.append(cut, len(shard)))
    for s, e, i, j in zip(cut, np.append(cut[1:], len(shard)), until, until[1:], strict=False):
        new = np.flatnonzero(np.diff(word[s:e].astype(np.int64), prepend=-1))
        own, at = np.unique(context[s:e], return_inverse=True)
        at = at.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32)
        yield int(shard[s]), (step, words[word[s:e][new]], np.diff(np.append(new, e - s)).astype(np.uint32), at, text[s:e], restaurants[own], weights[i:j])


def _bucketed(frame: DataFrame, purpose: str, partitions: int) -> DataFrame:
    """A written copy in buckets by shard, which joins by shard read where they lie.

    The table needs a name while it is written; its files stay like those of other written frames.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark, purpose)
    name = f"twinloom_{purpose}_{uuid.uuid4().hex}"
    try:
        frame.write.bucketBy(partitions, "shard").option("path", folder).option("compression", "zstd").saveAsTable(name, format="parquet")
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _shard_batch(row: list) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), *[pa.binary()] * len(_ARRAYS)]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], ["shard", "about", *_ARRAYS])


@dataclass
class Totals:
    """What all shards need of each other, of fixed size; a shard adds the totals of its restaurants."""

    frequent: np.ndarray
    round: int = 0
    ranges: int = 1
    customers: np.ndarray = field(default_factory=lambda: np.zeros(1 << 16))
    tables: np.ndarray = field(default_factory=lambda: np.zeros(1 << 16))
    frequent_counts: np.ndarray | None = None
    frequent_tables: np.ndarray | None = None
    tokens: int = 0
    words: int = 0
    root: float = 0.0
    discount: float = 0.5
    root_discount: float = 0.5
    strength: float = 1.0
    root_strength: float = 1.0


def _discount(ones: float, twos: float) -> float:
    """The usual estimate from how many things are met once and twice."""
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers."""
    y, shift = x, 0.0
    low = x < 8
    if low.any():
        y = np.where(low, x + 8, x)
        small = np.where(low, x, 1.0)
        shift = np.where(low, np.log(np.prod([small + i for i in range(8)], axis=0)), 0.0)
    square = 1 / (y * y)
    series = (1 / 12 - (1 / 360 - square / 1260) * square) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


@lru_cache(2)
def _tabulated(discount: float) -> np.ndarray:
    """log S(n, t), in how many weighted ways n customers fill t tables, for n and t up to TABULATED."""
    table = np.full((TABULATED + 1, TABULATED + 1), -np.inf)
    table[0, 0] = 0.0
    t = np.arange(TABULATED + 1)
    with np.errstate(divide="ignore"):
        for n in range(TABULATED):
            stay = table[n] + np.log(np.maximum(n - discount * t, 0.0))
            table[n + 1, 1:] = np.logaddexp(table[n, :-1], stay[1:])
    return table


def _saddle(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(n, t) by the saddle point of t * log(1 - (1 - x)^discount) - n * log(x)."""
    low, high = np.full(len(n), -30.0), np.full(len(n), np.log(700.0))
    for _ in range(50):  # of log(-log(1 - x))
        middle = (low + high) / 2
        u = -np.exp(middle)
        slope = np.log(-np.expm1(u)) + (discount - 1) * u - np.log(-np.expm1(discount * u))
        below = slope < np.log(n / (t * discount))
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    u = -np.exp((low + high) / 2)
    x = -np.expm1(u)
    bend = np.maximum(n * (1 + (1 - discount) * x * np.exp(-u) - n / t), 1e-9)
    top = t * np.log(-np.expm1(discount * u)) - n * np.log(x)
    return _lgamma(n + 1.0) - _lgamma(t + 1.0) - t * np.log(discount) + top - 0.5 * np.log(2 * np.pi * bend)


@lru_cache(2)
def _correction(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """What the saddle point lacks, by log(t / n ** discount), on which alone it depends for many customers."""
    t = np.arange(1, TABULATED // 2 + 1)
    lacking = _tabulated(discount)[TABULATED, t] - _saddle(np.full(len(t), TABULATED), t, discount)
    at = np.log(t) - discount * np.log(TABULATED)
    slope = (1 - 2 * discount) / (2 - 2 * discount)  # towards few tables
    return np.append(at[0] - 50, at), np.append(lacking[0] - 50 * slope, lacking)


def log_stirling(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(n, t) for 1 <= t <= n."""
    out = _tabulated(discount)[np.minimum(n, TABULATED), np.minimum(t, TABULATED)]
    large = np.flatnonzero(n > TABULATED)
    if len(large):
        n, t = n[large], t[large]
        lacking = np.interp(np.log(t) - discount * np.log(n), *_correction(discount))
        out[large] = np.where(t < n, _saddle(n, np.minimum(t, n - 1), discount) + lacking, 0.0)
    return out


class Shard:
    """The seating of the words of one shard: each cell's number of tables."""

    def __init__(self, row: dict, totals: Totals, seed: int):
        for name, kind in _ARRAYS.items():
            if row.get(name) is not None:
                setattr(self, name, np.frombuffer(row[name], kind))
        self.context = np.frombuffer(row["context"], f"u{len(row['context']) // len(self.trained)}")
        if row.get("totals") is not None:
            known = {n: [r[n] for r in row["totals"]] for n in ("customers", "tables")}
            known = {n: np.concatenate([np.frombuffer(x, np.int64) for x in v]).astype(float) for n, v in known.items() if None not in v}
            totals = replace(totals, **known)
        self.totals, self.random = totals, np.random.default_rng((seed, int(row["shard"]), totals.round))
        self.of_word = np.repeat(np.arange(len(self.word)), self.cells)
        self.count = np.bincount(self.of_word, self.trained, len(self.word))
        self.many = np.flatnonzero(self.trained > 1)
        self.spread = _is_in(self.word, totals.frequent)
        self.central = np.searchsorted(totals.frequent, self.word[self.spread])

    def known(self) -> np.ndarray:
        """Training tokens of each word in the whole corpus."""
        counts = self.count.copy()
        counts[self.spread] = self.totals.frequent_counts[self.central]
        return counts

    def seat(self) -> None:
        """A first seating: about the expected number of tables."""
        many = self.many
        self._begin((self.trained > 0).astype(np.int64))
        size = self.trained[many].astype(np.int64)
        open_rate = np.maximum(self._opening(self._root())[many], 1e-12)
        self.tables[many] = np.clip(np.rint(open_rate * np.log1p(size / open_rate)), 1, size).astype(np.int64)

    def go_on(self, seating: bytes | None) -> None:
        """From the seating that the round before left and told the others; without one, from a first seating."""
        if seating is None:
            self.seat()
        else:
            self._begin(np.frombuffer(seating, np.uint32).astype(np.int64))

    def _begin(self, tables: np.ndarray) -> None:
        self.tables, self.told = tables, tables.copy()

    @property
    def cell(self) -> np.ndarray:
        """Of each table in cells of two customers or more, the cell."""
        return np.repeat(np.arange(len(self.many)), self.tables[self.many])

    @property
    def size(self) -> np.ndarray:
        """One seating with these numbers of tables, evenly filled; nothing else depends on it."""
        size, tables = self.trained[self.many].astype(np.int64), self.tables[self.many]
        number = np.arange(tables.sum()) - np.repeat(np.cumsum(tables) - tables, tables)
        return np.repeat(size // tables, tables) + (number < np.repeat(size % tables, tables))

    def _root(self) -> np.ndarray:
        """The root's probability of each word."""
        t = self.totals
        tables = np.bincount(self.of_word, self.tables, len(self.word))
        tables[self.spread] = t.frequent_tables[self.central]
        new = t.root_strength + t.root_discount * t.words
        return np.where(tables > 0, tables - t.root_discount, new) / (t.root_strength + t.root)

    def _opening(self, root: np.ndarray) -> np.ndarray:
        """Of each cell, the weight of a new table."""
        t = self.totals
        return (t.strength + t.discount * t.tables[self.context]) * root[self.of_word]

    def sweep(self) -> None:
        """All customers of each cell of two or more sit anew, one random half of the cells after the other."""
        first = self.random.random(len(self.many)) < 0.5
        for part in (self.many[first], self.many[~first]):
            if len(part):
                self._draw(part)

    def _draw(self, part: np.ndarray) -> None:
        """Numbers of tables of some cells, each given all others."""
        t = self.totals
        own, n = self.tables[part], self.trained[part].astype(np.int64)
        moved = np.bincount(self.context, self.tables - self.told, len(t.tables))
        here = np.maximum(t.tables[self.context[part]] + moved[self.context[part]] - own, 0.0) + t.strength / t.discount
        of_word = np.bincount(self.of_word, self.tables, len(self.word))
        known = np.bincount(self.of_word, self.told, len(self.word))[self.spread]
        everywhere = np.maximum(t.root + of_word.sum() - self.told.sum() - own, 0.0) + t.root_strength
        of_word[self.spread] += t.frequent_tables[self.central] - known
        dish = np.maximum(of_word[self.of_word[part]] - own, 0.0) - t.root_discount
        few = n <= ENUMERATED
        for draw, at in ((self._enumerated, few), (self._metropolis, ~few)):
            if at.any():
                own[at] = draw(own[at], n[at], here[at], dish[at], everywhere[at])
        self.tables[part] = own

    def _enumerated(self, own, n, here, dish, everywhere) -> np.ndarray:
        first = np.cumsum(n) - n
        cell = np.repeat(np.arange(len(n)), n)
        number = np.arange(len(cell)) - first[cell]  # tables beside the first
        t = number.astype(float)
        # the weight of t + 1 tables over that of t, summed up within each cell
        step = np.log(self.totals.discount * (here[cell] + t) * (dish[cell] + t) / (everywhere[cell] + t), where=number > 0, out=np.zeros(len(t)))
        weight = np.cumsum(step)
        weight += _tabulated(self.totals.discount)[n[cell], number + 1] - weight[first][cell]
        upto = np.cumsum(np.exp(weight - np.maximum.reduceat(weight, first)[cell]))
        below, last = np.append(0.0, upto[first[1:] - 1]), first + n - 1
        chosen = np.searchsorted(upto, below + self.random.random(len(n)) * (upto[last] - below), "right")
        return np.clip(chosen, first, last) - first + 1

    def _metropolis(self, own, n, here, dish, everywhere) -> np.ndarray:
        discount = self.totals.discount

        others = np.stack((here, dish, everywhere))

        def weight(t: np.ndarray) -> np.ndarray:
            rising = _lgamma(others + t)
            return log_stirling(n, t, discount) + t * np.log(discount) + rising[0] + rising[1] - rising[2]

        spread, now = n ** (discount / 2), weight(own)
        for i in range(STEPS):  # strides from a quarter of the tables' usual spread to many times as much
            stride = np.rint(self.random.normal(size=len(n)) * np.maximum(1.0, spread * 2.0 ** (4 - i % 6))).astype(np.int64)
            to = own + stride
            to = np.where((to >= 1) & (to <= n), to, own)
            then = weight(to)
            taken = np.log(self.random.random(len(n))) < then - now
            own, now = np.where(taken, to, own), np.where(taken, then, now)
        return own

    def catch_up(self) -> None:
        """Add what this shard has moved since the last exchange to the totals, so that predictions sum to one."""
        t, moved = self.totals, self.tables - self.told
        frequent = t.frequent_tables.copy()
        frequent[self.central] += np.bincount(self.of_word, moved, len(self.word))[self.spread]
        here = t.tables + np.bincount(self.context, moved, len(t.tables))
        self.totals = replace(t, tables=here, root=t.root + moved.sum(), frequent_tables=frequent)
        self.told = self.tables.copy()

    def predictions(self) -> np.ndarray:
        """The probability of each cell's word after its context."""
        t = self.totals
        own = np.maximum(self.trained - t.discount * self.tables, 0.0)
        return (own + self._opening(self._root())) / (t.strength + t.customers[self.context])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _sums(kinds: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate([np.full(len(k), kind) for kind, k, _, _ in kinds]), *(np.concatenate([np.asarray(x[i], float) if i > 1 else x[i] for x in kinds]) for i in (1, 2, 3))]


def _returned(keys: DataFrame, parts: DataFrame, ranges: int, customers: bool) -> DataFrame:
    """Totals of each shard's restaurants, by ranges, from all shards' restaurants and tables: rows (shard, totals).

    Sweeps need the tables only; the customers, which never change, are returned for the predictions.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, list]] = {}
        for batch in batches:
            for part, shard, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = held.setdefault(part, {}).setdefault(shard, [shard, None, None, None])
                row[1:] = [new if new is not None else old for new, old in zip(rest, row[1:], strict=True)]
        for part in sorted(held):
            rows = list(held.pop(part).values())
            keys, at = np.unique(np.concatenate([np.frombuffer(r[1], np.uint64) for r in rows]), return_inverse=True)
            upto = np.cumsum([0, *(len(r[1]) // 8 for r in rows)])
            packed = []
            for i in (2, 3):
                if i == 2 and not customers:
                    packed.append([None] * len(rows))
                    continue
                sums = np.bincount(at, np.concatenate([np.frombuffer(r[i], np.int64) for r in rows]), len(keys)).astype(np.int64)[at]
                packed.append([sums[s:e].tobytes() for s, e in zip(upto, upto[1:], strict=False)])
            for i in range(0, len(rows), 1000):
                columns = [pa.array([r[0] for r in rows[i : i + 1000]], pa.int32()), pa.array([part] * len(rows[i : i + 1000]), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(p[i : i + 1000], pa.binary()) for p in packed)], ["shard", "range", "customers", "tables"])

    none = F.lit(None).cast("binary")
    known = F.col("customers") if customers else none
    keys = keys.select("range", "shard", "restaurants", known.alias("customers"), none.alias("tables"))
    parts = parts.select("range", "shard", none.alias("restaurants"), none.alias("customers"), "tables")
    found = keys.union(parts).repartitionById(ranges, "range").mapInArrow(work, "shard int, range int, customers binary, tables binary")
    return found.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("range", "customers", "tables"))).alias("totals"))


def _gathered(shards: DataFrame, totals: Totals, seed: int, seating: DataFrame | None = None, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Count, or sweep from the written seating on, and sum up restaurants over shards.

    Gives rows (shard, seating, totals), and the restaurants of each shard, which are written when counted only.
    """
    columns = ["shard", "word", "cells", "context", "trained", "restaurant"]
    shared = shards.sparkSession.sparkContext.broadcast(totals)
    counted = seating is None
    ranges = totals.ranges

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = Shard(row, shared.value, seed)
            if counted:
                shard.tables = (shard.trained > 0).astype(np.int64)
            else:
                shard.go_on(row["seating"])
                for _ in range(EXCHANGE):
                    shard.sweep()
            own = len(shard.restaurant)
            kept = {"tables": np.bincount(shard.context, shard.tables, own).astype(np.int64)}
            if counted:
                kept |= {"restaurants": shard.restaurant, "customers": np.bincount(shard.context, shard.trained, own).astype(np.int64)}
            part = ((shard.restaurant >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            cut = np.flatnonzero(np.diff(part, prepend=-1))
            pieces = list(zip(cut, np.append(cut[1:], own), strict=True))
            of_word = np.bincount(shard.of_word, shard.tables, len(shard.word))
            light, spread = ~shard.spread & (shard.count > 0), shard.spread
            plain = [
                (0, light.sum(), shard.count[light].sum()),
                (1, (shard.trained == 1).sum(), (shard.trained == 2).sum()),
                (2, (of_word[light] == 1).sum(), (of_word[light] == 2).sum()),
                (3, shard.tables.sum(), 0),
            ]
            few = _sums([(1, shard.word[spread].view(np.int64), shard.count[spread], of_word[spread]), (2, *(np.array(c) for c in zip(*plain, strict=True)))])
            state = None if counted else shard.tables.astype(np.uint32).tobytes()
            yield told(1, shard=[row["shard"]], seating=[state])
            yield told(len(pieces), shard=[row["shard"]] * len(pieces), range=part[cut], **{n: [x[s:e].tobytes() for s, e in pieces] for n, x in kept.items()})
            yield told(len(few[0]), **dict(zip(("kind", "key", "x", "y"), few, strict=True)))

    types = {"shard": pa.int32(), "seating": pa.binary(), "range": pa.int32(), "restaurants": pa.binary(), "customers": pa.binary(), "tables": pa.binary(), "kind": pa.int32(), "key": pa.int64(), "x": pa.float64(), "y": pa.float64()}

    def told(size: int, **values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values[n]).cast(t) if n in values else pa.nulls(size, t) for n, t in types.items()], list(types))

    rows = shards.where("about IS NULL").select(columns)
    rows = rows if counted else rows.join(seating, "shard")
    after = written(rows.mapInArrow(work, "shard int, seating binary, range int, restaurants binary, customers binary, tables binary, kind int, key bigint, x double, y double"), "seating")
    rows = after.where("kind IS NOT NULL").groupBy("kind", "key").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).collect()  # of fixed size
    by_kind = {k: {r.key: (r.x, r.y) for r in rows if r.kind == k} for k in (1, 2)}
    pairs = [by_kind[1].get(int(w), (0.0, 0.0)) for w in totals.frequent.view(np.int64)]
    totals.frequent_counts, totals.frequent_tables = (np.array([p[i] for p in pairs]) for i in (0, 1))
    plain = by_kind[2] or {i: (0.0, 0.0) for i in range(4)}
    totals.words = int(plain[0][0] + (totals.frequent_counts > 0).sum())
    totals.tokens = int(plain[0][1] + totals.frequent_counts.sum())
    totals.root = plain[3][0]
    totals.round += 1
    if counted:
        totals.discount, totals.root_discount = _discount(*plain[1]), _discount(*plain[2])
    seated = after.where("shard IS NOT NULL AND range IS NULL").select("shard", "seating")
    parts = after.where("range IS NOT NULL")
    keys = parts if counted else keys
    return seated.join(_returned(keys, parts, ranges, customers=totals.round > ROUNDS), "shard"), keys


#: How partial sums of scores (means of samples, good to a few digits), base scores and known tokens travel.
_SUMS = (np.float32, np.float64, np.uint32)


class _Sums:
    """Partial sums by step and text over a task's shards, given away when they fill their room."""

    ROOM = 2_000_000

    def __init__(self):
        self.held: dict[int, list[tuple[np.ndarray, list[np.ndarray]]]] = {}
        self.entries = 0

    def add(self, step: int, texts: np.ndarray, sums: list[np.ndarray]) -> None:
        self.held.setdefault(step, []).append((texts, sums))
        self.entries += len(texts)

    def _merge(self) -> None:
        self.entries = 0
        for step, parts in self.held.items():
            texts, at = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
            sums = [np.bincount(at, np.concatenate([s[i] for _, s in parts]), len(texts)) for i in range(3)]
            self.held[step] = [(texts, sums)]
            self.entries += len(texts)

    def full(self) -> Iterator[pa.RecordBatch]:
        if self.entries > self.ROOM:
            self._merge()
            if self.entries > self.ROOM // 2:
                yield from self.taken()

    def taken(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        rows = [(step, t.tobytes(), *(x.astype(k).tobytes() for x, k in zip(sums, _SUMS, strict=True))) for step, [(t, sums)] in self.held.items()]
        self.held, self.entries = {}, 0
        if rows:
            types = [pa.int64(), *[pa.binary()] * 4]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["step", "texts", "score", "base", "known"])


def _scored(shards: DataFrame, totals: Totals, seed: int, seating: DataFrame) -> DataFrame:
    """Sparse sums by step: texts, log10 probabilities, base scores and known tokens."""
    shared = shards.sparkSession.sparkContext.broadcast(totals)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Sums()
        for row in _rows(batches):
            shard = Shard(row, shared.value, seed)
            shard.go_on(row["seating"])
            for _ in range(BURN_IN):
                shard.sweep()
            mean = np.zeros(len(shard.context))
            for _ in range(SAMPLES):
                shard.sweep()
                shard.catch_up()
                mean += shard.predictions() / SAMPLES
            known = shard.known()
            base = np.log10((known + 1) / (totals.tokens + totals.words + 1))
            of_cell = np.repeat(np.arange(len(mean)), shard.used)
            of_word = shard.of_word[of_cell]
            key = shard.of_step.astype(np.int64) << 16 | (shard.text & (HELD - np.uint16(1)))
            keys, at = np.unique(key, return_inverse=True)
            sums = [np.bincount(at, w, len(keys)) for w in (np.log10(mean)[of_cell], base[of_word], (known > 0)[of_word].astype(float))]
            cut = np.flatnonzero(np.diff(keys >> 16, prepend=-1))
            for s, e in zip(cut, np.append(cut[1:], len(keys)), strict=True):
                held.add(int(shard.step[keys[s] >> 16]), (keys[s:e] & 0xFFFF).astype(np.uint16), [x[s:e] for x in sums])
            yield from held.full()
        yield from held.taken()

    return shards.where("about IS NULL").drop("about").join(seating, "shard").mapInArrow(work, "step bigint, texts binary, score binary, base binary, known binary")


def _by_document(shards: DataFrame, sums: DataFrame, totals: Totals) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps_of: dict[int, dict] = {}
        for batch in batches:
            for step, texts, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = steps_of.setdefault(step, {"about": None, "sums": []})
                if texts is None:
                    held["about"] = rest[3:]
                    continue
                held["sums"].append((np.frombuffer(texts, np.uint16), *(np.frombuffer(x, t) for x, t in zip(rest[:3], _SUMS, strict=True))))
        for held in steps_of.values():
            ids, null, tokens, out = (np.frombuffer(x, t) for x, t in zip(held["about"][:4], (np.int64, bool, np.int64, bool), strict=True))
            sums = np.zeros((3, max(len(ids), int(HELD))))
            for texts, *values in held["sums"]:
                for i, value in enumerate(values):
                    sums[i, texts] += value
            _add_cells(sums, len(ids), held["about"][4])
            sums = sums[:, : len(ids)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=null),
                    pa.array(out),
                    pa.array(tokens),
                    pa.array(np.rint(sums[2]).astype(np.int64)),
                    pa.array(np.full(len(ids), totals.tokens)),
                    pa.array(sums[1]),
                    pa.array(sums[0]),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    told, summed = ["word", "cells", "context", "trained", "cells_often"], ["texts", "score", "base", "known"]
    about = shards.where("about IS NOT NULL").select(F.col("about").alias("step"), *(F.lit(None).cast("binary").alias(c) for c in summed), *told[:4], F.col("step").alias(told[4]))
    sums = sums.select("step", *summed, *(F.lit(None).cast("binary").alias(c) for c in told))
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return about.unionByName(sums).repartition("step").mapInArrow(work, schema)


def score(docs: DataFrame, held_out: Column, seed: int = 42) -> DataFrame:
    """One row a document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), held_out.alias("held_out"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with session_conf(docs.sparkSession, _CLEANED):
        deal = Deal(_homes(docs, SHARDS * partitions, partitions), *_frequent(docs, SHARDS * partitions), HEAVY)
        totals = Totals(deal.frequent)
        shards = _bucketed(_shards(_packed(docs, deal), deal, partitions), "shards", partitions)
        entries = (shards.agg(F.sum(F.octet_length("restaurant"))).first()[0] or 0) // 8
        totals.ranges = min(1 + entries // ENTRIES, RANGES + partitions // SHARDS)
        seating, keys = _gathered(shards, totals, seed)
        for _ in range(ROUNDS):
            seating, _ = _gathered(shards, totals, seed, seating, keys)
        seating = _bucketed(seating, "seating", partitions)
    return _by_document(shards, _scored(shards, totals, seed, seating), totals)
