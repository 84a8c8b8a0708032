"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit a dimension, set where the component is positive. A code is cut into
m segments, about as long as the binary logarithm of the number of codes. Codes within distance d
agree with the query up to r bits in some segment once ``d < m * (r + 1)``; so buckets are looked
up segment by segment with growing radius, candidates are verified by their full distance, and a
query ends when its k-th verified distance is within what the segments searched so far cover:
``m * r + j`` after segment j (from 0) at radius r. Ties at the k-th distance are covered too, so
the smallest ids win. Where a step would look up more buckets than there are codes, the remaining
codes are verified directly.

On Spark, all rows are dealt by hash into blocks of bounded size, and so are the distinct query
codes; each pair of blocks is one group with its own index, and the k best of all blocks are
merged. Of equal codes only the k + 1 smallest ids can be among the results, so a code with a
third of all rows is cut to these before the shuffle.

Defined cases: a vector never finds itself; repeated (id, code) rows count once; rows with a null
id or vector are neither searched nor found; a missing or null component gives an unset bit,
components beyond ``bits`` are an error; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinloom.llm.rows import written

BITS = 64
BLOCK = 16_384
QUERIES_AT_ONCE = 256


def binary_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", bits: int = BITS) -> DataFrame:
    """Rows (vec_id, code), the code as a 64-bit integer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat, lengths = column.flatten(), np.asarray(column.value_lengths())
            if lengths.max(initial=0) > bits:
                raise ValueError(f"a vector has more than {bits} components")
            row = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            on = np.nan_to_num(np.asarray(flat.fill_null(0.0))) > 0
            codes = np.zeros(len(lengths), np.uint64)
            np.bitwise_or.at(codes, row[on], np.uint64(1) << place[on].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.astype(np.int64))], ["vec_id", "code"])

    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where("vec_id IS NOT NULL AND v IS NOT NULL").mapInArrow(work, "vec_id bigint, code bigint")


class MultiIndex:
    """Buckets of one block of codes, by segment."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray, bits: int = BITS):
        self.codes, self.ids, self.bits = codes.astype(np.uint64), ids, bits
        self.m = max(1, round(bits / max(1.0, np.log2(max(2, len(codes))))))
        edges = [bits * i // self.m for i in range(self.m + 1)]
        self.segments = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            values = self._segment(self.codes, low, high)
            order = np.argsort(values, kind="stable")
            self.segments.append((low, high, order, values[order]))

    @staticmethod
    def _segment(codes: np.ndarray, low: int, high: int) -> np.ndarray:
        return (codes >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query index, id and distance of the k nearest of each query, ties by id."""
        found = [self._some(queries[i : i + QUERIES_AT_ONCE].astype(np.uint64), k, i) for i in range(0, len(queries), QUERIES_AT_ONCE)]
        return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def _some(self, queries: np.ndarray, k: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(self.codes)
        seen = np.zeros((len(queries), n), bool)
        counts = np.zeros((len(queries), self.bits + 1), np.int64)
        hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        active = np.arange(len(queries))

        def verify(query: np.ndarray, code: np.ndarray) -> None:
            new = ~seen[query, code]
            query, code = query[new], code[new]
            distance = np.bitwise_count(queries[query] ^ self.codes[code]).astype(np.int64)
            seen[query, code] = True
            np.add.at(counts, (query, distance), 1)
            hits.append((query, code, distance))

        radius = 0
        while len(active):
            for j, (low, high, order, values) in enumerate(self.segments):
                width = high - low
                masks = [sum(1 << b for b in chosen) for chosen in combinations(range(width), radius)] if radius <= width else []
                if len(masks) > n:
                    for query in active.tolist():
                        rest = np.flatnonzero(~seen[query])
                        verify(np.full(len(rest), query), rest)
                    active = active[:0]
                    break
                for mask in masks:
                    wanted = self._segment(queries[active], low, high) ^ np.uint64(mask)
                    begin, end = np.searchsorted(values, wanted), np.searchsorted(values, wanted, "right")
                    size = end - begin
                    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
                    verify(np.repeat(active, size), order[at])
                covered = self.m * radius + j
                active = active[counts[active, : covered + 1].sum(axis=1) < min(k, n)]
                if not len(active):
                    break
            radius += 1
        query, code, distance = (np.concatenate(part) for part in zip(*hits, strict=True))
        order = np.lexsort((self.ids[code], distance, query))
        query, code, distance = query[order], code[order], distance[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best = rank < k
        return query[best] + first, self.ids[code[best]], distance[best]


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """Rows (query_id, rank, vec_id, distance) for every query row against all rows."""
    codes = written(binary_codes(vectors, bits=bits).distinct(), "codes")
    few = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    rows = codes.withColumn("nth", few).where(F.col("nth") <= k + 1).drop("nth")
    asking = codes.where(is_query).select(F.col("vec_id").alias("query_id"), "code")
    questions = written(asking.select("code").distinct(), "query-codes")
    row_blocks, query_blocks = (max(1, -(-frame.count() // block)) for frame in (codes, questions))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")

    rows = rows.select("*", dealt(row_blocks).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"))
    questions = questions.select("*", dealt(query_blocks).alias("q"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("r"))

    def search(known: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if known.empty or asked.empty:
            return pd.DataFrame({"code": [], "vec_id": [], "distance": []})
        wanted = asked["code"].to_numpy()
        query, ids, distance = MultiIndex(known["code"].to_numpy(), known["vec_id"].to_numpy(), bits).search(wanted, k + 1)
        return pd.DataFrame({"code": wanted[query], "vec_id": ids, "distance": distance})

    pairs = rows.groupBy("r", "q").cogroup(questions.groupBy("r", "q"))
    found = pairs.applyInPandas(search, "code bigint, vec_id bigint, distance int")
    order = F.row_number().over(Window.partitionBy("code").orderBy("distance", "vec_id"))
    best = found.withColumn("nth", order).where(F.col("nth") <= k + 1)
    lists = best.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("distance", "vec_id"))).alias("near"))
    near = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = asking.join(written(lists, "nearest"), "code").select("query_id", F.posexplode(near).alias("place", "hit"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.distance")
