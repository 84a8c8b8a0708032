"""Source divergence audit by chunk factorization.

White-space chunks are counted per document in blocks of texts, so that one row stands for all
documents of a block that hold a chunk, by group (language and source). Every globally distinct chunk is
tokenized once; its terms are joined back to the counts and aggregated.

A term belongs to a language's vocabulary if enough distinct documents hold it. The documents of
the chunk that is the bare term, or those of a block and another chunk, are a lower bound, the
sum over all its chunks an upper one.
Only where they leave the answer open are documents themselves compared, by the numbers that the
blocks carry with each chunk. A block lists no documents of a chunk and group that has ``min_docs``
of them there, since these alone put the chunk's terms into the vocabulary.

Proportions are integers, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), by long division in steps
of a thousand, which is exact up to 9 * 10^15 occurrences.
The sum of |p - q| over a whole vocabulary is taken for blocks of sources and buckets of
terms, so a task holds ``BUCKET`` terms of two blocks of sources; a term that none of them holds
adds the same amount for each, so it is counted and never listed.

Defined cases: null lang, source or text are empty strings; a group without terms takes part
with count 0 everywhere; a language without vocabulary has pairs of value 0 and no terms;
repeated rows are documents of their own; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinloom.llm.rows import numbered, written
from twinloom.llm.runs import LOWER, distinct, gathered, kind, runs

#: White space is 0x20 and 0x09-0x0D.
CHUNK_BYTES = ~kind((0x09, 0x0D), (0x20, 0x20))
#: A term is a maximal run of ASCII letters and characters outside ASCII.
TERM_PATTERN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text of a block.
BLOCK = 32 << 20
#: Terms that a task compares at once, and sources of a block.
BUCKET, SOURCES = 20_000, 256
#: (language, term) rows that are sent to all tasks; beyond, the same join shuffles.
BROADCAST_TERMS = 500_000
COUNTS = "block bigint, chunk string, groups array<bigint>, n array<int>, d array<int>, docs array<array<int>>"


def _filled(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text")))


def _few(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_TERMS else frame


def chunk_counts(texts: DataFrame, min_docs: int) -> DataFrame:
    """Of (group, text) rows, one row for each block and chunk.

    For each group that holds the chunk: its occurrences, its documents, and which if fewer than ``min_docs``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for rows, data, offsets in gathered(batches, BLOCK):
            yield from _counted(block, rows.column(0).to_numpy(), data, offsets, min_docs)
            block += 1

    return texts.select("group", "text").mapInArrow(work, COUNTS)


def _counted(block: int, group: np.ndarray, data: np.ndarray, offsets: np.ndarray, min_docs: int) -> Iterator[pa.RecordBatch]:
    data = LOWER[data]
    starts, ends, bounds = runs(data, offsets, CHUNK_BYTES)
    codes, names = distinct(data, starts, ends, CHUNK_BYTES)
    del data, starts, ends
    names = names.cast(pa.string())
    by_name = pc.sort_indices(names)  # neighbours alike, so that rows compress well where they are shuffled
    names, rank = names.take(by_name), np.empty(len(names), np.int64)
    rank[by_name.to_numpy()] = np.arange(len(names))
    codes = rank[codes]
    number, count = max(len(group), 1), np.diff(bounds)
    by_group = np.argsort(group, kind="stable")  # documents renumbered so that a group's lie together
    place = np.empty(len(group), np.int64)
    place[by_group] = np.arange(len(group))
    group = group[by_group]
    pairs = codes * number
    pairs += np.repeat(place, count)
    pairs.sort()
    at = np.flatnonzero(np.diff(pairs, prepend=-1))  # where each (chunk, document) starts
    times = np.diff(np.append(at, len(pairs)))
    pairs = pairs[at]
    code, doc = pairs // number, pairs % number
    held = group[doc]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (held[1:] != held[:-1])
    first = np.flatnonzero(new)  # of each (chunk, group)
    n = np.add.reduceat(times, first) if len(first) else first
    d = np.diff(np.concatenate((first, [len(code)])))
    few = d < min_docs
    listed = pa.array(doc[np.repeat(few, d)], pa.int32())
    listed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(few, d, 0)))), pa.int32()), listed)
    of_chunk = np.searchsorted(code[first], np.arange(len(names) + 1))
    groups, n, d = pa.array(held[first], pa.int64()), pa.array(n, pa.int32()), pa.array(d, pa.int32())
    for a in range(0, len(names), 50_000):
        at = pa.array(of_chunk[a : a + 50_001], pa.int32())
        columns = [pa.array(np.full(len(at) - 1, block), pa.int64()), names.slice(a, 50_000)]
        columns += [pa.ListArray.from_arrays(at, values) for values in (groups, n, d, listed)]
        yield pa.RecordBatch.from_arrays(columns, ["block", "chunk", "groups", "n", "d", "docs"])


@dataclass(frozen=True)
class Vocabulary:
    """Written tables: the groups (group, lang, source), and of kept terms the occurrences by group and by language."""

    groups: DataFrame
    by_group: DataFrame
    by_lang: DataFrame


def vocabulary(docs: DataFrame, min_docs: int = 30) -> Vocabulary:
    """The terms that at least ``min_docs`` documents of a language hold."""
    docs = _filled(docs)
    groups = numbered(docs.select("lang", "source").distinct(), "group")
    counts = written(chunk_counts(docs.join(_few(groups), ["lang", "source"]), min_docs), "chunks")
    tokens = F.regexp_extract_all("chunk", F.lit(TERM_PATTERN), F.lit(0))
    chunks = counts.select("chunk").distinct().select("chunk", tokens.alias("terms"))
    chunks = written(chunks.where(F.size("terms") > 0), "tokenized")
    entries = counts.select("chunk", "groups", "n", "d").join(chunks, "chunk")  # flat arrays travel in half the bytes of zipped ones
    single = entries.select("chunk", "terms", F.explode(F.array_distinct("terms")).alias("term"), "groups", "n", "d")
    times = F.when(F.size("terms") == 1, F.lit(1)).otherwise(F.size(F.filter("terms", lambda x: x == F.col("term"))))
    single = single.select("term", times.alias("times"), (F.col("chunk") == F.col("term")).alias("bare"), F.explode(F.arrays_zip("groups", "n", "d")).alias("e"))
    by_group = single.groupBy(F.col("e.groups").alias("group"), "term").agg(
        F.sum(F.col("e.n").cast("bigint") * F.col("times")).alias("n"),
        F.greatest(F.sum(F.when(F.col("bare"), F.col("e.d")).otherwise(0)), F.max("e.d")).alias("low"),
        F.sum("e.d").alias("high"),
    )
    by_group = written(by_group, "by-group").join(_few(groups.select("group", "lang")), "group")
    bounds = by_group.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    bounds = written(bounds.where(F.col("high") >= min_docs), "bounds")
    unsettled = bounds.where(F.col("low") < min_docs).select("lang", "term")
    # Documents of the open terms: their chunks' rows list all documents, or a bound would have settled them.
    suspects = chunks.select("chunk", F.explode(F.array_distinct("terms")).alias("term")).join(_few(unsettled), "term")
    suspects = written(suspects.select("lang", "term", "chunk"), "suspects")
    holders = counts.select("block", "chunk", "groups", "docs").join(_few(suspects.select("chunk").distinct()), "chunk", "left_semi")
    holders = holders.select("block", "chunk", F.explode(F.arrays_zip("groups", "docs")).alias("e"))
    holders = holders.select("block", "chunk", F.col("e.groups").alias("group"), F.explode("e.docs").alias("doc"))
    holders = holders.join(_few(groups.select("group", "lang")), "group").join(_few(suspects), ["lang", "chunk"])
    exact = holders.select("lang", "term", "block", "doc").distinct().groupBy("lang", "term").count()
    exact = exact.where(F.col("count") >= min_docs)
    settled = bounds.where(F.col("low") >= min_docs).select("lang", "term", "n")
    more = bounds.where(F.col("low") < min_docs).join(exact, ["lang", "term"]).select("lang", "term", "n")
    by_lang = written(settled.unionByName(more), "vocabulary")
    kept = by_group.join(_few(by_lang.select("lang", "term")), ["lang", "term"], "left_semi").select("group", "term", "n")
    return Vocabulary(groups, written(kept, "kept"), by_lang)


def _proportion(count: Column, total: str, size: str) -> Column:
    """1 + floor(10^9 * count / (total + 5 * size)) for a count that is at most the divisor."""
    below = F.col(total) + 5 * F.col(size)
    quotient, rest = F.lit(0).cast("bigint"), count
    for _ in range(3):
        rest = rest * 1000
        quotient, rest = quotient * 1000 + F.call_function("div", rest, below), rest % below
    return quotient + 1


def audit(docs: DataFrame, min_docs: int = 30, shown: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: distances between sources, terms above their language."""
    found = vocabulary(docs, min_docs)
    sizes = found.by_lang.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    totals = found.by_group.groupBy("group").agg(F.sum("n").alias("total"))
    groups = found.groups.join(totals, "group", "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "v", "lang_total"])
    # One number for each source of a language, in blocks; a language has as many rows here as sources.
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("number", number).withColumn("part_of", F.floor(F.col("number") / SOURCES))
    groups = groups.withColumn("parts", F.max("part_of").over(Window.partitionBy("lang")) + 1)
    base = F.when(F.col("v") > 0, _proportion(F.lit(5).cast("bigint"), "total", "v"))
    groups = written(groups.withColumn("base", base), "groups")
    own = found.by_group.join(_few(groups), "group").withColumn("p", _proportion(F.col("n") + 5, "total", "v"))
    return _above(own, found, shown).unionByName(_distances(own, groups, found))


def _above(own: DataFrame, found: Vocabulary, shown: int) -> DataFrame:
    whole = found.by_lang.select("lang", "term", F.col("n").alias("lang_n"))
    value = F.col("p") - _proportion(F.col("lang_n") + 5, "lang_total", "v")
    above = own.join(_few(whole), ["lang", "term"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return above.where("value > 0").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= shown)


def _distances(own: DataFrame, groups: DataFrame, found: Vocabulary) -> DataFrame:
    buckets = max(1, -(-found.by_lang.count() // BUCKET))
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")
    columns = ["lang", "bucket", "part_of", "parts", "number", "term", "p"]
    listed = own.select("*", bucket).select(columns)
    roster = groups.where("v > 0").select("*", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    roster = roster.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).select(columns)
    dealt = listed.unionByName(roster)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(
        "lang", "bucket", F.least("part_of", "other").alias("a"), F.greatest("part_of", "other").alias("b"), "number", "term", "p"
    )
    block = SOURCES
    partial = dealt.groupBy("lang", "bucket", "a", "b").applyInArrow(
        lambda rows: _compared(rows, block), "lang string, g int, h int, value bigint, seen bigint"
    )
    summed = partial.groupBy("lang", "g", "h").agg(F.sum("value").alias("summed"), F.sum("seen").alias("seen"))
    left = groups.select("lang", "source", F.col("number").alias("g"), "v", F.col("base").alias("own_base"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("h"), F.col("base").alias("other_base"))
    pairs = left.join(right, "lang").where("g <> h").join(summed, ["lang", "g", "h"], "left")
    unseen = (F.col("v") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("own_base") - F.col("other_base"))
    value = F.coalesce("summed", F.lit(0)) + F.coalesce(unseen, F.lit(0))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(by))


def _compared(rows: pa.Table, block: int) -> pa.Table:
    """Sums of |p - q| over the listed terms, for each two sources of two blocks in either order."""
    lang = rows.column("lang")[0].as_py()
    a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
    number, p = rows.column("number").to_numpy(), rows.column("p").to_numpy()
    term = rows.column("term").combine_chunks().dictionary_encode()
    listed = term.indices.is_valid().to_numpy(zero_copy_only=False)
    code = term.indices.fill_null(0).to_numpy()[listed]
    seen = len(term.dictionary)
    sides = []
    for part in (a, b):
        of_part = number // block == part
        sources, at = np.unique(number[of_part & ~listed], return_index=True)
        matrix = np.repeat(p[of_part & ~listed][at][:, None], seen, 1)
        chosen = of_part[listed]
        matrix[np.searchsorted(sources, number[listed][chosen]), code[chosen]] = p[listed][chosen]
        sides.append((sources, matrix))
    (left, first), (right, second) = sides
    out = [[], [], []]
    for g, row in zip(left.tolist(), first, strict=True):
        value = np.abs(second - row).sum(1)
        ways = ((np.full(len(right), g), right), (right, np.full(len(right), g)))[: 1 if a == b else 2]
        for one, other in ways:
            out[0].append(one)
            out[1].append(other)
            out[2].append(value)
    g, h, value = (np.concatenate(x) for x in out)
    apart = g != h
    count = int(apart.sum())
    return pa.table(
        {
            "lang": pa.array([lang] * count, pa.string()),
            "g": pa.array(g[apart], pa.int32()),
            "h": pa.array(h[apart], pa.int32()),
            "value": pa.array(value[apart], pa.int64()),
            "seen": pa.array(np.full(count, seen), pa.int64()),
        }
    )
