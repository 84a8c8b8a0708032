"""Quality classifier: hashed word n-grams, logistic regression learned by FTRL-proximal.

Features of a text are its word n-grams (words as they are, n = 1 and 2) hashed into a fixed
number of slots, and scaled to unit length. A 2-gram that repeats its word is one feature
whatever the word, so repetition is seen in words never met before. A score is the logistic of a
sparse dot product.

Learning takes a bounded sample: the ``sample`` labelled documents with the smallest hash of
their id. Their features are made in parallel; only hashed features travel to the one task that
applies the sequential FTRL updates. Weights have a fixed size and go to all tasks, which score
all texts without a shuffle.

Defined cases: a null or empty text has the bias feature only; a document with several labels has
the rounded mean, a tie counting as 1; null labels and null ids are not learned from; without any
labelled row all scores are 0.5; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinloom.llm.rows import written
from twinloom.llm.words import Words, mixed, steps, text_bytes, windows

SLOTS = 1 << 18
#: Labelled documents that learning takes at most.
SAMPLE = 12_000
#: Passes over the sample at least; a small sample has more, up to this many updates.
PASSES, UPDATES = 3, 10_000
_REPEAT = np.uint64(0x5851F42D4C957F2D)
_SECOND = np.uint64(0xD1342543DE82EF95)


def features(data: np.ndarray, offsets: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of all texts end to end, and where each text's begin. Slot 0 is the bias."""
    words = Words(data, offsets)
    hashes, texts = words.hashes(), len(offsets) - 1
    pairs, pair_text = windows(words.bounds, 2)
    left, right = hashes[pairs], hashes[pairs + 1] if len(pairs) else hashes[:0]
    grams = np.where(left == right, _REPEAT, mixed(left * _SECOND + right))
    slot = np.concatenate((hashes, grams)) % np.uint64(slots - 1) + np.uint64(1)
    text = np.concatenate((words.texts(), pair_text)).astype(np.uint64)
    keys, counts = np.unique(text * np.uint64(slots) + slot, return_counts=True)
    text, slot = (keys // np.uint64(slots)).astype(np.int64), (keys % np.uint64(slots)).astype(np.int32)
    norm = np.sqrt(np.bincount(text, counts.astype(float) ** 2, texts))
    values = counts / norm[text]
    bounds = np.searchsorted(text, np.arange(texts + 1))
    return np.insert(slot, bounds[:-1], 0), np.insert(values, bounds[:-1], 1.0), bounds + np.arange(texts + 1)


class FollowTheLeader:
    """FTRL-proximal with a learning rate for each coordinate."""

    def __init__(self, slots: int = SLOTS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(slots), np.zeros(slots)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def learn(self, slot: np.ndarray, value: np.ndarray, label: int) -> None:
        weights = self.weights(slot)
        gradient = (1 / (1 + np.exp(-np.clip(weights @ value, -35, 35))) - label) * value
        total = self.n[slot] + gradient**2
        self.z[slot] += gradient - (np.sqrt(total) - np.sqrt(self.n[slot])) / self.alpha * weights
        self.n[slot] = total


def _sampled(docs: DataFrame, labels: DataFrame, learn_from: Column | str, sample: int) -> DataFrame:
    """Hashed features of the sample: (place, label, slots, value bytes)."""
    known = labels.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("double")).dropna().where(learn_from)
    known = known.groupBy("doc_id").agg(F.when(F.avg("quality") >= 0.5, 1).otherwise(0).alias("label"))
    chosen = written(known.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(sample), "labelled")
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in steps(offsets):
                slot, value, bounds = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ends = list(zip(bounds[:-1], bounds[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("place").slice(a, b - a),
                        batch.column("label").slice(a, b - a),
                        pa.array([slot[s:e].tobytes() for s, e in ends], pa.binary()),
                        pa.array([value[s:e].astype(np.float32).tobytes() for s, e in ends], pa.binary()),
                    ],
                    ["place", "label", "slots", "amounts"],
                )

    return texts.select("place", "label", "text").mapInArrow(work, "place bigint, label int, slots binary, amounts binary")


def learned(docs: DataFrame, labels: DataFrame, learn_from: Column | str, sample: int = SAMPLE, passes: int = PASSES) -> np.ndarray:
    """Weights for each slot, learned in the order of the documents' hashed ids."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        rows.sort()
        model = FollowTheLeader()
        for _ in range(max(passes, UPDATES // max(1, len(rows)))):
            for _, label, slots, amounts in rows:
                model.learn(np.frombuffer(slots, np.int32), np.frombuffer(amounts, np.float32).astype(float), label)
        out = io.BytesIO()
        np.save(out, model.weights().astype(np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["weights"])

    sampled = written(_sampled(docs, labels, learn_from, sample), "labelled-features")
    (model,) = sampled.coalesce(1).mapInArrow(fit, "weights binary").collect() or (None,)
    return np.load(io.BytesIO(model.weights)) if model else np.zeros(SLOTS, np.float32)


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """The documents with their score in [0, 1], whatever columns they have."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(place))
            out = [np.zeros(0)]
            for a, b in steps(offsets):
                slot, value, bounds = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                out.append(np.add.reduceat(shared.value[slot] * value, bounds[:-1]))
            scores = 1 / (1 + np.exp(-np.clip(np.concatenate(out), -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, name])

    types = docs.select("*", F.lit(0.5).alias(name)).schema
    return docs.mapInArrow(work, types)
