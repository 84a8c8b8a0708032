"""Near duplicates by HyperMinHash: compressed registers, banding, corrected estimates, exact checks.

A document is the set of its different word shingles, as 64-bit hashes. Equal sets form a class,
of which one member goes on. A set's hashes fall into ``BUCKETS`` buckets; of the smallest in each
a register keeps the number of leading zeros and ``MANTISSA`` further bits, 16 bits in all. Bands of
``ROWS`` registers are candidate keys: at Jaccard 0.8 a pair shares none of the 40 bands with a
probability of 5e-6, at 0.85 of 6e-9. Sets so small that most registers are empty share bands by
their common shingles.

Candidates are never emitted as all pairs of a bucket. Each member is first paired with the smallest
member only; pairs that pass a bound by set sizes and an estimate from the registers, corrected for
registers that agree by chance and lowered by 4.5 standard deviations, join members to families.
Buckets in which more than one family is left are compared by registers in blocks of bounded size,
which emit only pairs that join families, a forest. So families are exactly the components of all
plausible candidate pairs. Then each family's full sets meet once, large families in pairs of
blocks: plausible pairs that are not connected yet are confirmed on full sets, and again only the
links that connect are emitted. Every pair in a bucket is linked, tested, implausible by a proven
margin, or connected already.

Defined cases: texts without words have an empty set and are linked with nothing; a text with
fewer words than a shingle is one shingle; a null doc_id counts as larger than any other; repeated
rows are equal sets, of which the first read is kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinloom.llm.graph import components
from twinloom.llm.rows import matching, numbered, written
from twinloom.llm.words import Words, mixed, rolling, steps, text_bytes, windows

BANDS, ROWS = 40, 6
BUCKETS = BANDS * ROWS
MANTISSA = 10
#: Members of a bucket that are compared with each other at once.
BLOCK = 1024
#: Pairs that are looked at in one step of array work.
PAIRS = 1 << 16
_SECOND = np.uint64(0xE7037ED1A0B428DB)


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """Of each text, the sorted different hashes of its shingles."""
    hashes = words.hashes()
    starts, text = windows(words.bounds, size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    begin = np.concatenate((starts, words.bounds[short]))
    end = np.concatenate((starts + size, words.bounds[short + 1]))
    values = rolling(hashes, begin, end)
    at = np.searchsorted(text, np.arange(len(words.bounds)))
    out = [np.unique(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    for i, value in zip(short.tolist(), values[len(starts) :], strict=True):
        out[i] = np.array([value], np.uint64)
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BUCKETS registers a set; 0 where no hash fell."""
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    if not len(sets):
        return out
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    scaled = (flat >> np.uint64(32)) * np.uint64(BUCKETS)
    bucket, rest = (scaled >> np.uint64(32)).astype(np.int64), (scaled & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cell = row * BUCKETS + bucket  # sets are sorted, so cells are, and the first of a cell is its smallest
    first = np.diff(cell, prepend=-1) > 0
    cell, rest = cell[first], rest[first]
    zeros = 32 - np.frexp(rest.astype(float))[1]
    after = np.where(rest > 0, (rest << np.minimum(zeros + 1, 33)) & 0xFFFFFFFF, 0)
    out.reshape(-1)[cell] = (zeros << MANTISSA | after >> (32 - MANTISSA)) + 1
    return out


def bands(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of each band that has a register."""
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for i in range(ROWS):
        key = mixed(key * _SECOND + parts[:, :, i])
    row, band = np.nonzero(parts.any(axis=2))
    return row, key[row, band].astype(np.int64)


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """How often registers of two sets without common elements agree."""
    zeros = np.arange(33)[:, None]

    def cells(n: np.ndarray) -> np.ndarray:
        rate = n[None, :] / BUCKETS
        filled = -np.expm1(-rate[0])
        return (np.exp(-rate * 2.0 ** -(zeros + 1)) - np.exp(-rate * 2.0**-zeros)) / np.maximum(filled, 1e-12)

    return (cells(n_a) * cells(n_b)).sum(axis=0) / (1 << MANTISSA)


def _near_enough(same: np.ndarray, filled: np.ndarray, threshold: float, estimate: np.ndarray | None = None) -> np.ndarray:
    """Whether an estimate, at most the share of registers that agree, is within the margin."""
    filled = np.maximum(filled, 1)
    margin = 4.5 * np.sqrt(threshold * (1 - threshold) / filled)
    return (same / filled if estimate is None else estimate) >= threshold - margin


def possible(n_a: np.ndarray, n_b: np.ndarray, same: np.ndarray, filled: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sizes and the corrected estimate leave room for a link."""
    by_chance = chance(n_a.astype(float), n_b.astype(float))
    estimate = (same / np.maximum(filled, 1) - by_chance) / (1 - by_chance)
    sizes = np.minimum(n_a, n_b) >= (threshold - 1e-9) * np.maximum(n_a, n_b)
    return sizes & _near_enough(same, filled, threshold, estimate)


def _sketched(docs: DataFrame, size: int, given: str | None) -> DataFrame:
    """Numbered texts with their sets' sizes, 128-bit identities and registers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in steps(offsets):
                sets = shingles(Words(data, offsets[a : b + 1], lower=True), size)
                ends = np.cumsum([len(s) for s in sets])
                flat = np.concatenate([np.zeros(0, np.uint64), *sets])
                identity = [rolling(f, ends - [len(s) for s in sets], ends) for f in (flat, mixed(flat ^ _SECOND))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(2).slice(a, b - a) if given else pa.array(np.arange(row, row + b - a)),
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        *(pa.array(i.astype(np.int64)) for i in identity),
                        pa.array([r.tobytes() for r in registers(sets)], pa.binary()),
                        batch.column(1).slice(a, b - a),
                    ],
                    ["row", "doc_id", "n_shingles", "set_a", "set_b", "registers", "text"],
                )
                row += b - a

    own = [F.col(given).cast("bigint")] if given else []
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *own)
    schema = "row bigint, doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, registers binary, text string"
    return written(rows.mapInArrow(work, schema), "sketches")


def _buckets(sketches: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            row, key = bands(regs)
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(batch.column(0))[row]), pa.array(key)], ["id", "key"])

    return sketches.select("id", "registers").mapInArrow(work, "id bigint, key bigint")


def _full_sets(texts: DataFrame, size: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in steps(offsets):
                sets = shingles(Words(data, offsets[a : b + 1], lower=True), size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "members"]
                )

    return written(texts.select("id", "text").mapInArrow(work, "id bigint, members binary"), "sets")


def _beside(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the column of a and of b. Rows of a frequent b are dealt over salted copies."""
    often = pairs.groupBy("b").count()
    often = written(often.select("b", F.ceil(F.col("count") / 256).cast("int").alias("copies")).where("copies > 1"), "frequent")
    salted = pairs.join(often, "b", "left").withColumn("salt", F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).cast("int"))
    right = table.select(F.col("id").alias("b"), F.col(column).alias(f"{column}_b")).join(often, "b", "left")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    left = table.select(F.col("id").alias("a"), F.col(column).alias(f"{column}_a"))
    return salted.join(left, "a").join(right, ["b", "salt"]).select("a", "b", f"{column}_a", f"{column}_b")


def _plausible(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([x for x in batch.column(i).to_pylist()] for i in (2, 3))
            regs = [np.frombuffer(b"".join(x["registers"] for x in side), np.uint16).reshape(-1, BUCKETS) for side in (a, b)]
            n = [np.array([x["n"] for x in side], np.int64) for side in (a, b)]
            same = ((regs[0] == regs[1]) & (regs[0] > 0)).sum(axis=1)
            filled = ((regs[0] > 0) | (regs[1] > 0)).sum(axis=1)
            good = pa.array(possible(n[0], n[1], same, filled, threshold))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], ["a", "b"])

    sketches = sketches.select("id", F.struct("registers", F.col("n_shingles").alias("n")).alias("sketch"))
    return _beside(pairs, sketches, "sketch").mapInArrow(work, "a bigint, b bigint")


class _Forest:
    """Union-find over positions."""

    def __init__(self, labels: np.ndarray):
        _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
        self.parent = first[inverse].tolist()

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.parent))])

    def join(self, i: int, j: int) -> bool:
        """Whether the two were apart."""
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def _pairs(ends: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions i < j with j before the end of i's group, some at a time."""
    counts = ends - np.arange(len(ends)) - 1
    upto, start = np.cumsum(counts), 0
    while start < len(ends):
        done = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, done + limit, "right")))
        left = np.repeat(np.arange(start, stop), counts[start:stop])
        first = upto[start:stop] - counts[start:stop] - done
        yield left, left + 1 + np.arange(len(left)) - np.repeat(first, counts[start:stop])
        start = stop


def _grouped(table: pa.Table, wanted: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Columns sorted by group, each position's end of group, and whether a group has two blocks."""
    columns = {c: table.column(c).to_numpy() for c in wanted}
    order = np.lexsort((columns["id"], columns["group"]))
    columns = {c: v[order] for c, v in columns.items()}
    cut = np.flatnonzero(np.diff(columns["group"], prepend=columns["group"][:1] - 1))
    sizes = np.diff(np.append(cut, len(order)))
    blocks = columns["block"].astype(np.int64)
    mixed_blocks = np.minimum.reduceat(blocks, cut) != np.maximum.reduceat(blocks, cut)
    columns["order"] = order
    return columns, np.repeat(cut + sizes, sizes), np.repeat(mixed_blocks, sizes)


def _dealt(members: DataFrame, key: str, size: str) -> DataFrame:
    """Members by group: a key's, or for a key of more than BLOCK members each pair of its blocks."""
    split = members.withColumn("blocks", F.ceil(F.col(size) / BLOCK).cast("int"))
    split = split.withColumn("block", F.pmod(F.xxhash64("id", key), F.col("blocks")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return split.withColumn("group", F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other")))


def _plausible_pairs(
    columns: dict[str, np.ndarray], ends: np.ndarray, two: np.ndarray, regs: np.ndarray, threshold: float, apart: Callable[[], np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of different labels (looked up anew for each step) whose sizes and registers allow a link, best first."""
    n, block, some = columns["n_shingles"], columns["block"], regs > 0
    for i, j in _pairs(ends, PAIRS):
        labels = apart()
        good = (labels[i] != labels[j]) & (~two[i] | (block[i] != block[j]))
        good &= np.minimum(n[i], n[j]) >= (threshold - 1e-9) * np.maximum(n[i], n[j])
        i, j = i[good], j[good]
        same = ((regs[i] == regs[j]) & some[i]).sum(axis=1)
        filled = (some[i] | some[j]).sum(axis=1)
        good = np.flatnonzero(_near_enough(same, filled, threshold))
        if len(good):
            good = good[possible(n[i[good]], n[j[good]], same[good], filled[good], threshold)]
            good = good[np.argsort(-same[good] / filled[good], kind="stable")]
            yield i[good], j[good]


def _joining(members: DataFrame, threshold: float) -> DataFrame:
    """Plausible pairs that join families within buckets; of each block a forest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns, ends, two = _grouped(table, ["group", "id", "family", "n_shingles", "block"])
        regs = _stacked(table, columns["order"])
        # a family has one label in each group: forests of different buckets are not mixed
        forest = _Forest(mixed(columns["family"].astype(np.uint64) * _SECOND + columns["group"].astype(np.uint64)))
        found = []
        for i, j in _plausible_pairs(columns, ends, two, regs, threshold, forest.roots):
            found += [(x, y) for x, y in zip(i.tolist(), j.tolist(), strict=True) if forest.join(x, y)]
        yield _links(columns["id"], found)

    wanted = ["group", "id", "family", "n_shingles", "block", "registers"]
    return _dealt(members, "key", "size").select(wanted).repartition("group").mapInArrow(work, "a bigint, b bigint").distinct()


def _stacked(table: pa.Table, order: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(-1, BUCKETS)[order]


def _links(ids: np.ndarray, found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = ids[np.array(found, np.int64).reshape(-1, 2)]
    return pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=1)), pa.array(pairs.min(axis=1))], ["a", "b"])


def _confirmed(members: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links that connect: den * intersection >= num * union on full sets, within families."""
    num, den = similar

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns, ends, two = _grouped(table, ["group", "id", "n_shingles", "block"])
        regs, sets = _stacked(table, columns["order"]), table.column("members").combine_chunks()
        order, forest, found = columns["order"].tolist(), _Forest(np.arange(len(columns["id"]))), []
        full: dict[int, np.ndarray] = {}

        def members_of(x: int) -> np.ndarray:
            if x not in full:
                if len(full) > 4 * BLOCK:
                    full.clear()
                full[x] = np.frombuffer(sets[order[x]].as_py(), np.uint64)
            return full[x]

        for i, j in _plausible_pairs(columns, ends, two, regs, num / den, forest.roots):
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if forest.root(x) != forest.root(y):
                    a, b = members_of(x), members_of(y)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if den * common >= num * (len(a) + len(b) - common) and forest.join(x, y):
                        found.append((x, y))
        yield _links(columns["id"], found)

    wanted = ["group", "id", "n_shingles", "block", "registers", "members"]
    return _dealt(members, "family", "size").select(wanted).repartition("group").mapInArrow(work, "a bigint, b bigint")


def _linked(classes: DataFrame, texts: DataFrame, size: int, similar: tuple[int, int]) -> DataFrame:
    """Rows (id, component) for all classes that have a link."""
    threshold = similar[0] / similar[1]
    buckets = written(_buckets(classes), "buckets")
    shared = buckets.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("centre")).where("size > 1")
    members = written(buckets.join(written(shared, "shared-buckets"), "key"), "bucket-members")
    sketches = written(matching(classes, written(members.select("id").distinct(), "candidates"), ["id"]), "candidate-sketches")
    pairs = members.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    joined = written(_plausible(written(pairs, "pairs"), sketches, threshold), "joined")
    families = written(components(joined), "families")
    named = members.select("key", "id", "size").join(families, "id", "left")
    named = written(named.select("key", "id", "size", F.coalesce("component", "id").alias("family")), "named-members")
    several = named.groupBy("key").agg(F.min("family").alias("x"), F.max("family").alias("y")).where("x <> y").select("key")
    several = named.join(written(several, "open-buckets"), "key", "left_semi")
    joined = joined.unionByName(written(_joining(several.join(sketches.select("id", "n_shingles", "registers"), "id"), threshold), "joined"))
    families = written(components(joined), "families").withColumnRenamed("component", "family")
    sizes = families.groupBy("family").agg(F.count("*").alias("size"))
    families = families.join(written(sizes, "family-sizes"), "family")
    families = written(families, "families")
    sets = _full_sets(matching(texts.select(F.col("row").alias("id"), "text"), families.select("id"), ["id"]), size)
    full = families.join(sketches.select("id", "n_shingles", "registers"), "id").join(sets, "id")
    return written(components(written(_confirmed(full, similar), "links")), "components")


def near_duplicates(
    docs: DataFrame, size: int = 5, similar: tuple[int, int] = (80, 100), row: str | None = None
) -> DataFrame:
    """One row a document: (row, doc_id, n_shingles, component_id, kept).

    ``row`` names a column of different numbers for the rows; without it they are numbered as read.
    """
    texts = _sketched(docs, size, row)
    full = texts.where("n_shingles > 0")
    classes = full.groupBy("set_a", "set_b").agg(F.min("row").alias("id"), F.first("n_shingles").alias("n_shingles"))
    classes = written(classes, "classes")
    sketches = matching(texts.select(F.col("row").alias("id"), "registers"), classes.select("id"), ["id"])
    sketches = written(sketches.join(classes, "id"), "class-sketches")
    labels = _linked(sketches, texts, size, similar)
    named = classes.join(labels, "id", "left").select("set_a", "set_b", F.coalesce("component", "id").alias("component"))
    narrow = texts.select("row", "doc_id", "n_shingles", "set_a", "set_b")
    narrow = narrow.join(written(named, "named-classes"), ["set_a", "set_b"], "left")
    narrow = narrow.withColumn("component", F.when(F.col("n_shingles") > 0, F.col("component")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
    firsts = narrow.where("component IS NOT NULL").groupBy("component").agg(first)
    firsts = written(firsts.select("component", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("kept_row")), "firsts")
    alone = F.col("kept_row").isNull()
    return narrow.join(firsts, "component", "left").select(
        F.col("row").alias(row or "row"),
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("kept_row"))).alias("kept"),
    )


def deduplicated(docs: DataFrame, size: int = 5, similar: tuple[int, int] = (80, 100)) -> DataFrame:
    """The documents, with all their columns, of which one of each group of near duplicates stays."""
    number = "_row"
    while number in docs.columns:
        number += "_"
    rows = numbered(docs, number)
    texts = rows.select(F.col(number).alias("given"), "doc_id", "text")
    found = near_duplicates(texts, size, similar, "given")
    dropped = written(found.where("not kept").select(F.col("given").alias(number)), "dropped")
    return matching(rows, dropped, [number], "left_anti").select(docs.columns)
