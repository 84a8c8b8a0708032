"""Exact duplicates by composable polynomial fingerprints.

A text, with each run of white space replaced by one space, is the number
``sum(byte[i] * B^i)`` modulo two primes. Chunks are hashed independently of each other and
combined by arithmetic shifted by length, ``H(a + b) = H(a) + H(b) * B^len(a)``, so a huge
document needs no sequential pass. Only fingerprints are grouped, with partial counts before the
shuffle. Texts that share a fingerprint and a length are then compared chunk by chunk: distinct
(group, chunk number, chunk) triples are formed on the map side, so copies that meet in a task
travel once, and a group is confirmed if each chunk number has one content. A group that is not
confirmed is split by the SHA-256 of its whole texts.

Defined cases: a null text is empty, and empty texts are equal; of equal texts the smallest
doc_id stays, null ids come last, and of repeated rows with that id one stays; columns other
than doc_id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinloom.llm.rows import matching, numbered, written
from twinloom.llm.words import steps, text_bytes

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_103_515_245, 1_566_083_941)
CHUNK = 1024
COMPARED = 1 << 16


def normalized(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one space for each run of white space."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    keep[edge] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return np.where(space, np.uint8(32), data)[keep], kept[offsets]


class Polynomial:
    """Fingerprints modulo one prime."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime = base, prime
        self.within = np.array([pow(base, i, prime) for i in range(CHUNK)], np.uint64)
        self.shifts = np.ones(1, np.uint64)

    def shifted(self, n: int) -> np.ndarray:
        """``B^(CHUNK * k)`` for k below n."""
        if n > len(self.shifts):
            step, out = pow(self.base, CHUNK, self.prime), [1]
            for _ in range(2 * n):
                out.append(out[-1] * step % self.prime)
            self.shifts = np.array(out, np.uint64)
        return self.shifts[:n]

    def combined(self, left: int, left_length: int, right: int) -> int:
        return (left + right * pow(self.base, left_length, self.prime)) % self.prime

    def of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The fingerprint of each text, from the hashes of its chunks."""
        prime, chunks = np.uint64(self.prime), -(-np.diff(offsets) // CHUNK)
        out = np.zeros(len(chunks), np.uint64)
        if not len(data):
            return out
        first = np.concatenate(([0], np.cumsum(chunks)))
        number = np.arange(first[-1]) - np.repeat(first[:-1], chunks)
        begins = np.repeat(offsets[:-1], chunks) + number * CHUNK
        place = np.arange(len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data))))
        hashes = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * self.within[place], begins) % prime
        moved = hashes * self.shifted(int(chunks.max()))[number] % prime
        filled = chunks > 0
        out[filled] = np.add.reduceat(moved, first[:-1][filled]) % prime
        return out


def fingerprints(data: np.ndarray, offsets: np.ndarray, polynomials: list[Polynomial]) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, np.uint64)
    for polynomial in polynomials:
        out = (out << np.uint64(31)) | polynomial.of(data, offsets)
    return out.astype(np.int64)


def _fingerprinted(docs: DataFrame, primes: tuple[int, ...], bodies: bool) -> DataFrame:
    """Rows (row, doc_id, fingerprint, n_bytes, text_sha256), or (fingerprint, n_bytes, body)."""
    head = [("row", pa.int64()), ("doc_id", pa.int64())]
    key = [("fingerprint", pa.int64()), ("n_bytes", pa.int64())]
    schema = pa.schema(key + [("body", pa.binary())] if bodies else head + key + [("text_sha256", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        polynomials = [Polynomial(b, p) for b, p in zip(BASES, primes, strict=False)]
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for a, b in steps(offsets):
                plain, ends = normalized(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                texts = [plain[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)]
                keys = [pa.array(fingerprints(plain, ends, polynomials)), pa.array(np.diff(ends))]
                if bodies:
                    columns = [*keys, pa.array(texts, pa.binary())]
                else:
                    shas = pa.array([hashlib.sha256(text).hexdigest() for text in texts])
                    columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *keys, shas]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    return docs.mapInArrow(work, ", ".join(f"{f.name} {ddl[f.type]}" for f in schema))


def _collided(docs: DataFrame, groups: DataFrame, primes: tuple[int, ...]) -> DataFrame:
    """Groups of equal fingerprint and length whose texts differ in some chunk."""
    key = ["fingerprint", "n_bytes"]
    bodies = matching(_fingerprinted(docs, primes, True), groups.select(key), key)
    number = F.sequence(F.lit(0), F.ceil(F.col("n_bytes") / COMPARED).cast("int"))
    chunks = bodies.select(*key, "body", F.explode(number).alias("chunk_no")).select(
        *key, "chunk_no", F.substring("body", F.col("chunk_no") * COMPARED + 1, F.lit(COMPARED)).alias("chunk")
    )
    return chunks.distinct().groupBy(*key, "chunk_no").count().where("count > 1").select(*key).distinct()


def decisions(docs: DataFrame, row: str | None = None, primes: tuple[int, ...] = PRIMES) -> DataFrame:
    """One row a document: (row, doc_id, keep_id, group_size, kept, text_sha256, fingerprint).

    ``row`` names a column that numbers the rows; without it the rows are numbered in the order
    in which they are first read.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    docs = docs.select(number.alias("row"), F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    marks = written(_fingerprinted(docs, primes, False), "fingerprints")
    key = ["fingerprint", "n_bytes"]
    shared = written(marks.groupBy(key).count().where("count > 1").select(key), "shared-fingerprints")
    collided = written(_collided(docs, shared, primes).withColumn("split", F.lit(True)), "collided-fingerprints")
    marks = matching(marks, collided, key, "left").withColumn("part", F.when(F.col("split"), F.col("text_sha256")).otherwise(""))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    groups = marks.groupBy(*key, "part").agg(F.count("*").alias("group_size"), first.alias("first")).where("group_size > 1")
    groups = written(groups.select(*key, "part", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")), "groups")
    alone = F.col("group_size").isNull()
    return marks.join(groups, [*key, "part"], "left").select(
        "row",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
        "fingerprint",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, of which one of each group of equal texts stays."""
    number = "_row"
    while number in docs.columns:
        number += "_"
    rows = numbered(docs, number)
    dropped = written(decisions(rows, number).where("not kept").select(F.col("row").alias(number)), "dropped")
    return matching(rows, dropped, [number], "left_anti").select(docs.columns)
