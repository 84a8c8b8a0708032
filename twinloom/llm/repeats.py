"""Removal of long repeated passages by suffix trees partitioned by prefix.

A window of ``size`` words is repeated if its word sequence also starts anywhere else, which is an
internal node at depth ``size`` of the corpus' suffix tree. Only suffixes that can lie below such
a node are looked at: the smallest hash among a window's ``GRAM``-word sequences is the same in
equal windows, so a window whose smallest hash is met once in the corpus is unique. This sieve
works on about one position in fifteen.

The suffixes left are dealt to subtrees by a prefix of variable length: it grows until it holds
``DISTINCT`` different words, so that monotonous text, whose short prefixes are shared by very many
suffixes, is split deeper. In a subtree suffixes are sorted by prefix and by their first ``size``
words; equal neighbours share a deep node, and touching windows join to maximal repeats. Suffixes
that meet in one batch are resolved there, and one witness of them travels, so a passage in a third
of all documents sends one row a batch. A prefix and a window are compared by 128 bits of hashes.

Defined cases: a null text has no words; repeated rows repeat each other's windows; texts shorter
than a window stay whole; columns other than doc_id and text are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinloom.llm.rows import matching, written
from twinloom.llm.words import Words, joined, mixed, rolling, steps, text_bytes, windows

SIZE = 35
GRAM = 8
DISTINCT = 6
_TWO = np.uint64(0xA0761D6478BD642F)


def smallest(words: Words, hashes: np.ndarray, size: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first word of each window, where its smallest gram begins (the first of equal ones), and its hash."""
    starts, _ = windows(words.bounds, size)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    place = np.arange(len(hashes) - gram + 1)
    values = rolling(hashes, place, place + gram)
    covered = 1
    while covered < size - gram + 1:  # runs of twice the length, from two that overlap or touch
        step = min(covered, size - gram + 1 - covered)
        left, right = place[:-step], place[step:]
        place = np.where(values[left] <= values[right], left, right)
        covered += step
    return starts, place[starts], values[place[starts]]


def prefixes(hashes: np.ndarray, starts: np.ndarray, size: int, distinct: int = DISTINCT) -> np.ndarray:
    """Of each window, the hash of the shortest prefix with so many different words, or of the window.

    Word i is new in a window that begins after the word's previous occurrence.
    """
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    previous = np.full(len(hashes), -1, np.int64)
    previous[order[1:][same]] = order[:-1][same]
    length = np.full(len(starts), size, np.int64)
    count = np.zeros(len(starts), np.int64)
    for i in range(size):
        count += previous[starts + i] < starts
        length = np.where((count == distinct) & (length == size), i + 1, length)
    return rolling(hashes, starts, starts + length)


def _read_words(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """The texts, numbered, with what needs no other text: word counts, the hash of all words, smallest hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in steps(offsets):
                words = Words(data, offsets[a : b + 1])
                starts, place, least = smallest(words, words.hashes(), size, gram)
                new = np.diff(place, prepend=-1) > 0  # places never fall from one window to the next
                at = np.searchsorted(starts[new], words.bounds)
                met = [least[new][s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + b - a)),
                        batch.column(0).slice(a, b - a),
                        pa.array(words.counts),
                        pa.array([hashlib.sha256(text).hexdigest() for text in joined(words, offsets[a : b + 1])]),
                        pa.array(met, pa.binary()),
                        batch.column(1).slice(a, b - a),
                    ],
                    ["row", "doc_id", "n_words", "whole_sha256", "met", "text"],
                )
                row += b - a

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    schema = "row bigint, doc_id bigint, n_words bigint, whole_sha256 string, met binary, text string"
    return written(rows.mapInArrow(work, schema), "texts")


def _sieved(texts: DataFrame, gram: int, size: int) -> DataFrame:
    """Rows (row, shared): of each text, the smallest hashes that are met at two places or more."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(met, np.int64) for met in batch.column(1).to_pylist()]
            rows = np.repeat(np.asarray(batch.column(0)), [len(v) for v in values])
            values = np.concatenate([np.zeros(0, np.int64), *values])
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(values)], ["row", "value"])

    met = texts.select("row", "met").mapInArrow(spread, "row bigint, value bigint")
    shared = written(met.groupBy("value").count().where("count > 1").select("value"), "shared-hashes")
    return met.join(shared, "value", "left_semi").groupBy("row").agg(F.collect_set("value").alias("shared"))


def _ranges(row: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches of words covered by windows, from windows sorted by row and start."""
    if not len(row):
        return row, start, start
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + size)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], start[first], start[last] + size


_PACKED = {"prefix": np.uint64, "window": np.uint64, "row": np.int64, "start": np.int32, "end": np.int32}


def _packed_schema(names: Iterable[str]) -> str:
    return "shard int, " + ", ".join(f"{name} binary" for name in names)


def _packed(columns: Sequence[np.ndarray], hashes: np.ndarray, shards: int, names: list[str]) -> pa.RecordBatch:
    """The columns cut into shards by hash, one row a shard."""
    shard = (hashes >> np.uint64(32)).astype(np.int64) % shards
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    some = np.flatnonzero(np.diff(cut))
    packed = [pa.array([c[order[cut[i] : cut[i + 1]]].tobytes() for i in some], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *packed], ["shard", *names])


def _unpacked(batches: list[pa.RecordBatch], kinds: dict[str, type]) -> Iterator[np.ndarray]:
    for name, kind in kinds.items():
        yield np.concatenate([np.frombuffer(x, kind) for batch in batches for x in batch.column(name).to_pylist()])


def _suffixes(texts: DataFrame, size: int, gram: int, shards: int) -> DataFrame:
    """Suffixes (prefix, window, row, start), and what their batch resolved as stretches (row, start, end).

    They are dealt to shards by prefix and travel as packed arrays, half the size of rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in steps(offsets, 4 << 20):
                rows = np.asarray(batch.column("row").slice(a, b - a))
                words = Words(data, offsets[a : b + 1])
                hashes = words.hashes()
                starts, _, least = smallest(words, hashes, size, gram)
                text = words.texts()[starts]
                wanted = _wanted(batch.column("shared").slice(a, b - a), text, least)
                starts, text = starts[wanted], text[wanted]
                prefix, window = prefixes(hashes, starts, size), rolling(hashes, starts, starts + size)
                window = mixed(window ^ _TWO)
                order = np.lexsort((starts, window, prefix))
                prefix, window, starts, text = prefix[order], window[order], starts[order], text[order]
                new = np.ones(len(starts), bool)
                new[1:] = (prefix[1:] != prefix[:-1]) | (window[1:] != window[:-1])
                group = np.cumsum(new) - 1
                many = np.bincount(group, minlength=len(new))[group] > 1 if len(new) else new
                local = starts - words.bounds[text]
                done = np.flatnonzero(many)
                done = done[np.lexsort((local[done], text[done]))]
                row, begin, end = _ranges(rows[text[done]], local[done], size)
                count = len(row)
                columns = (
                    np.concatenate((mixed(row.astype(np.uint64)), prefix[new])),
                    np.concatenate((np.zeros(count, np.uint64), window[new])),
                    np.concatenate((row, rows[text[new]])),
                    np.concatenate((begin, local[new])).astype(np.int32),
                    np.concatenate((end, np.where(many[new], -1, 0))).astype(np.int32),
                )
                yield _packed(columns, columns[0], shards, list(_PACKED))

    schema = _packed_schema(_PACKED)
    return texts.select("row", "text", "shared").mapInArrow(work, schema)


def _wanted(shared: pa.Array, text: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether each window's smallest hash is among the shared ones of its text."""
    values = [np.asarray(v.values if v.values is not None else [], np.int64).view(np.uint64) for v in shared]
    at = np.searchsorted(text, np.arange(len(values) + 1))
    out = np.zeros(len(text), bool)
    for i, known in enumerate(values):
        out[at[i] : at[i + 1]] = np.isin(least[at[i] : at[i + 1]], known)
    return out


_STRETCHES = {name: _PACKED[name] for name in ("row", "start", "end")}


def _subtrees(suffixes: DataFrame, size: int, shards: int) -> DataFrame:
    """Stretches (row, start, end) below the deep nodes, dealt to shards by row and packed.

    ``end`` of a suffix is -1 for a witness, else 0.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        prefix, window, row, start, end = _unpacked(held, _PACKED)
        stretch = end > 0
        done = [a[stretch] for a in (row, start, end)]
        prefix, window, row, start, end = (a[~stretch] for a in (prefix, window, row, start, end))
        order = np.lexsort((window, prefix))
        prefix, window, row, start, end = (a[order] for a in (prefix, window, row, start, end))
        same = (prefix[1:] == prefix[:-1]) & (window[1:] == window[:-1])
        deep = np.zeros(len(row), bool)
        deep[1:] |= same
        deep[:-1] |= same
        deep &= end == 0
        row, start = row[deep], start[deep]
        order = np.lexsort((start, row))
        found = _ranges(row[order], start[order], size)
        columns = [np.concatenate(pair).astype(kind) for *pair, kind in zip(done, found, _STRETCHES.values(), strict=True)]
        yield _packed(columns, mixed(columns[0].astype(np.uint64)), shards, list(_STRETCHES))

    return suffixes.repartition("shard").mapInArrow(work, _packed_schema(_STRETCHES))


def _maximal(stretches: DataFrame) -> DataFrame:
    """Rows (row, spans): each text's stretches joined to maximal ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        row, start, end = _unpacked(held, _STRETCHES)
        order = np.lexsort((end, start, row))
        row, start, end = row[order], start[order], end[order]
        rows = np.unique(row)
        for i in range(0, len(rows), 10_000):
            at = np.searchsorted(row, rows[i : i + 10_000], "left")
            stop = np.searchsorted(row, rows[min(len(rows), i + 10_000) - 1], "right")
            bounds = np.append(at, stop)
            spans = [_joined(start[a:b], end[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s, _ in spans]))).astype(np.int32)
            values = [pa.array(np.concatenate([span[k] for span in spans]), pa.int32()) for k in (0, 1)]
            lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, ["start", "end"]))
            yield pa.RecordBatch.from_arrays([pa.array(rows[i : i + 10_000]), lists], ["row", "spans"])

    return stretches.repartition("shard").mapInArrow(work, "row bigint, spans array<struct<start:int,end:int>>")


def _joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches sorted by start, those that touch or overlap made one."""
    reach = np.maximum.accumulate(end)
    first = np.append(True, start[1:] > reach[:-1])
    at = np.flatnonzero(first)
    return start[at], reach[np.append(at[1:], len(start)) - 1]


def _without(texts: DataFrame) -> DataFrame:
    """Texts without the words of their stretches: (row, n_removed, kept_sha256, kept_text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in steps(offsets):
                words = Words(data, offsets[a : b + 1])
                change = np.zeros(len(words.starts) + 1, np.int64)
                for base, spans in zip(words.bounds.tolist(), batch.column("spans").slice(a, b - a).to_pylist(), strict=False):
                    for span in spans:
                        change[base + span["start"]] += 1
                        change[base + span["end"]] -= 1
                keep = np.cumsum(change[:-1]) == 0
                kept = joined(words, offsets[a : b + 1], keep)
                gone = np.concatenate(([0], np.cumsum(~keep)))[words.bounds]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(a, b - a),
                        pa.array(np.diff(gone)),
                        pa.array([hashlib.sha256(text).hexdigest() for text in kept]),
                        pa.array([text.decode() for text in kept]),
                    ],
                    ["row", "n_removed", "kept_sha256", "kept_text"],
                )

    schema = "row bigint, n_removed bigint, kept_sha256 string, kept_text string"
    return texts.select("row", "text", "spans").mapInArrow(work, schema)


def without_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row a document: (row, doc_id, n_words, n_removed, kept_sha256, kept_text).

    ``kept_text`` is null where nothing is removed: the text is as it was.
    """
    gram = min(GRAM, size)
    texts = _read_words(docs, size, gram)
    sieved = written(_sieved(texts, gram, size), "sieved")
    some = matching(texts.select("row", "text"), sieved.select("row"), ["row"]).join(sieved, "row")
    some = written(some, "texts-to-split")
    shards = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = _maximal(_subtrees(_suffixes(some, size, gram, shards), size, shards))
    changed = _without(some.select("row", "text").join(spans, "row"))
    kept = texts.select("row", "doc_id", "n_words", "whole_sha256").join(changed, "row", "left")
    return kept.select(
        "row",
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        "kept_text",
    )
