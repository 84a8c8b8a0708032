"""Ranked lexical search over a length-stratified index.

A document's normaliser m grows with its number of terms; documents of equal m form a stratum,
in which a term's contribution depends on tf alone. The index holds, for each shard (documents
of about ``SHARD`` bytes of text, sorted by m) and term, the groups of equal (m, tf) with their
documents. So an impact is computed once for each (term, m, tf), and the largest tf of a term in
a stratum bounds what the term can add to any of its documents. For each item the strata of a
shard are visited in descending order of the sum of these bounds, until the k-th best score
found exceeds the next bound; equal bounds are still visited, since a smaller doc_id wins a tie.

Building reads the texts twice (totals, then postings) and shuffles nothing. A search joins
the items' terms to the postings and deals what matches by shard, with items in blocks; no task
holds more than the matches of one shard and one block, and what a shard sends on is at most k
rows an item. No document, stratum or candidate is skipped unless its bound proves it too low.

Defined cases: a null or empty text has no terms, so it is neither counted nor found; an item
without known terms has no rows; repeated documents and items are ranked each on their own; a
null doc_id sorts after all others at a tie; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinloom.llm.rows import numbered, written
from twinloom.llm.runs import LOWER, distinct, gathered, kind, runs, spread

#: A term is a maximal run of ASCII letters, ASCII digits and characters outside ASCII.
TERM_BYTES = kind((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text of a shard.
SHARD = 16 << 20
#: Items that one group of matches serves.
ITEM_BLOCK = 256
#: (term, item) entries that are sent to all tasks; beyond, the same join shuffles.
BROADCAST_ENTRIES = 1_000_000
POSTINGS = "shard bigint, term string, m array<bigint>, tf array<bigint>, size array<bigint>, place array<int>, doc_ids array<bigint>"


@dataclass(frozen=True)
class Index:
    """Written postings and the corpus totals that scores need."""

    postings: DataFrame
    documents: int
    terms: int


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = terms = 0
    for _, data, offsets in gathered(batches, 1 << 20):
        counts = np.diff(runs(data, offsets, TERM_BYTES)[2])
        documents, terms = documents + int((counts > 0).sum()), terms + int(counts.sum())
    yield pa.RecordBatch.from_pydict({"documents": pa.array([documents]), "terms": pa.array([terms])})


def _nested(values: np.ndarray, starts: np.ndarray, kind_of) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind_of))


def _postings(shard: int, doc_ids: pa.Array, data: np.ndarray, offsets: np.ndarray, documents: int, terms: int) -> pa.RecordBatch:
    """The directory row (no term) and one row for each distinct term of a shard."""
    data = LOWER[data]
    starts, ends, bounds = runs(data, offsets, TERM_BYTES)
    counts = np.diff(bounds)
    codes, names = distinct(data, starts, ends, TERM_BYTES)
    m = np.array([25 + 75 * n * documents // max(terms, 1) for n in counts.tolist()], np.int64)
    known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
    ids = doc_ids.fill_null(0).to_numpy()
    order = np.lexsort((ids, ~known, m))  # place within the shard: by stratum, then doc_id, null last
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    size = max(len(order), 1)
    pairs, tf = np.unique(codes.astype(np.int64) * size + np.repeat(place, counts), return_counts=True)
    term, place = pairs // size, pairs % size
    stratum = m[order][place] if len(place) else place
    by = np.lexsort((tf, stratum, term))  # stable, so doc_id order stays within equal tf
    term, place, stratum, tf = term[by], place[by], stratum[by], tf[by]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]) | (tf[1:] != tf[:-1])
    group = np.flatnonzero(new)
    of_term = np.searchsorted(term[group], np.arange(len(names) + 1))
    of_posting = np.searchsorted(term, np.arange(len(names) + 1))
    lengths = np.diff(np.concatenate((group, [len(term)])))

    def with_directory(starts: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], starts))

    columns = [
        pa.array(np.full(len(names) + 1, shard), pa.int64()),
        pa.concat_arrays([pa.nulls(1, pa.string()), names.cast(pa.string())]),
        _nested(stratum[group], with_directory(of_term), pa.int64()),
        _nested(tf[group], with_directory(of_term), pa.int64()),
        _nested(lengths, with_directory(of_term), pa.int64()),
        _nested(place, with_directory(of_posting), pa.int32()),
        pa.ListArray.from_arrays(
            pa.array([0] + [len(order)] * (len(names) + 1), pa.int32()), doc_ids.take(pa.array(order))
        ),
    ]
    return pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in POSTINGS.split(", ")])


def build(docs: DataFrame) -> Index:
    """The index of all rows of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    totals = texts.select("text").mapInArrow(_totals, "documents bigint, terms bigint")
    documents, terms = totals.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for rows, data, offsets in gathered(batches, SHARD):
            yield from _sliced(_postings(shard, rows.column(0), data, offsets, documents, terms))
            shard += 1

    return Index(written(texts.mapInArrow(work, POSTINGS), "lexical"), documents, terms)


def _sliced(batch: pa.RecordBatch, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, block, term, count) of rows with ``_row`` and ``text``, read like the documents."""
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOW)
    found = items.select(
        F.col("_row").alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM_PATTERN), F.lit(0))).alias("term")
    )
    return found.groupBy("item", "term").count().withColumn("block", F.floor(F.col("item") / ITEM_BLOCK))


class _Matches:
    """The matching postings of one shard and one block of items."""

    def __init__(self, rows: pa.Table):
        def flat(name):
            lists = rows.column(name).combine_chunks()
            return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())

        m, groups = flat("m")
        tf, _ = flat("tf")
        size, _ = flat("size")
        self.place, _ = flat("place")
        weight = rows.column("weight").to_numpy()
        term = np.repeat(np.arange(len(groups)), groups)
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        self.impact = np.repeat(impact, size)
        start = np.cumsum(size) - size
        # Entries: one for each (term, stratum); its last group has the largest tf, so the bound.
        self.strata, stratum = np.unique(m, return_inverse=True)
        new = np.ones(len(m), bool)
        new[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(m)])) - 1
        self.stratum, self.bound = stratum[first], impact[last]
        self.start, self.length = start[first], start[last] + size[last] - start[first]
        self.of_term = np.searchsorted(term[first], np.arange(len(groups) + 1))
        items, per_term = flat("items")
        counts, _ = flat("counts")
        by = np.argsort(items, kind="stable")
        self.item_term = np.repeat(np.arange(len(groups)), per_term)[by]
        self.item_count = counts[by]
        self.items, at = np.unique(items[by], return_index=True)
        self.of_item = np.concatenate((at, [len(items)]))

    def best(self, number: int, documents: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents of the k best scores for one item, ties included."""
        own = slice(self.of_item[number], self.of_item[number + 1])
        terms = self.item_term[own]
        entries = spread(self.of_term[terms], self.of_term[terms + 1] - self.of_term[terms])
        count = np.repeat(self.item_count[own], self.of_term[terms + 1] - self.of_term[terms])
        stratum, start, length = self.stratum[entries], self.start[entries], self.length[entries]
        bounds = np.zeros(len(self.strata), np.int64)
        np.add.at(bounds, stratum, self.bound[entries] * count)
        order = np.argsort(-bounds, kind="stable")
        scores, visited, take, least = np.zeros(documents, np.int64), 0, 4, 1
        while visited < len(order) and bounds[order[visited]] >= least:
            chosen = np.zeros(len(bounds), bool)
            chosen[order[visited : visited + take]] = True
            chosen &= bounds >= least
            now = chosen[stratum]
            at = spread(start[now], length[now])
            np.add.at(scores, self.place[at], self.impact[at] * np.repeat(count[now], length[now]))
            visited, take = visited + take, 4 * take
            found = scores[scores > 0]
            if len(found) >= k:
                least = max(least, int(np.partition(found, len(found) - k)[len(found) - k]))
        place = np.flatnonzero(scores >= least)
        return place, scores[place]


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """For each row of ``items`` (item_id, text) its k best documents: item_id, rank, doc_id, score."""
    spark = items.sparkSession
    items = numbered(items.select("item_id", "text"))
    asked = written(
        item_terms(items).groupBy("term", "block").agg(F.collect_list(F.struct("item", "count")).alias("asks")), "asked"
    )
    few = asked.agg(F.sum(F.size("asks"))).first()[0] or 0
    send = F.broadcast if few <= BROADCAST_ENTRIES else (lambda frame: frame)
    postings = index.postings
    held = postings.where("term IS NOT NULL")
    frequency = (
        held.select("term", F.size("place").cast("bigint").alias("df"))
        .join(send(asked.select("term").distinct()), "term")
        .groupBy("term")
        .agg(F.sum("df").alias("df"))
    )
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * index.documents + 2) / (2 * F.col("df") + 1).cast("double")))
    asked = written(
        asked.join(frequency, "term").select(
            "term", "block", F.col("asks.item").alias("items"), F.col("asks.count").alias("counts"), weight.cast("bigint").alias("weight")
        ),
        "weighted",
    )
    nothing = [F.lit(None).cast("bigint").alias("block"), F.array().cast("array<bigint>").alias("items")]
    nothing += [F.array().cast("array<bigint>").alias("counts"), F.lit(0).cast("bigint").alias("weight")]
    columns = ["shard", "block", "weight", "items", "counts", "m", "tf", "size", "place", "doc_ids"]
    matched = held.join(send(asked), "term").withColumn("doc_ids", F.array().cast("array<bigint>")).select(columns)
    directory = postings.where("term IS NULL").select("*", *nothing).select(columns)
    dealt = matched.unionByName(directory).repartition("shard").sortWithinPartitions("shard", F.asc_nulls_first("block"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids = pa.array([], pa.int64())
        for key, rows in _by_key(batches):
            if key[1] is None:
                doc_ids = rows.column("doc_ids").combine_chunks().flatten()
                continue
            matches = _Matches(rows)
            out = [[], [], []]
            for number, item in enumerate(matches.items.tolist()):
                place, scores = matches.best(number, len(doc_ids), k)
                keep = np.lexsort((place, -scores))
                if len(keep) > k:  # places follow doc_id within a stratum only, so ties are settled by doc_id
                    ids = doc_ids.take(pa.array(place))
                    unknown = ids.is_null().to_numpy(zero_copy_only=False)
                    keep = np.lexsort((ids.fill_null(0).to_numpy(), unknown, -scores))[:k]
                out[0].append(np.full(len(keep), item))
                out[1].append(place[keep])
                out[2].append(scores[keep])
            item, place, score = (np.concatenate(part) for part in out)
            found = [pa.array(item, pa.int64()), doc_ids.take(pa.array(place)), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(found, ["item", "doc_id", "score"])

    found = dealt.mapInArrow(work, "item bigint, doc_id bigint, score bigint")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    named = items.select(F.col("_row").alias("item"), "item_id")
    if few <= BROADCAST_ENTRIES and items.count() <= BROADCAST_ENTRIES:
        named = F.broadcast(named)
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of equal (shard, block), which come one after the other, laid together."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = batch.column(0).to_numpy()
        block = batch.column(1).fill_null(-1).to_numpy()
        cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            key = (int(shard[a]), None if block[a] < 0 else int(block[a]))
            if waiting and key != last:
                yield last, pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
            last = key
    if waiting:
        yield last, pa.Table.from_batches(waiting)
