"""Runs of bytes of a given kind in whole batches of texts, and the distinct strings among them.

A kind is a table of 256 flags. Bytes of 128 and more belong to characters outside ASCII, so a
kind that has all of them or none never splits a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from twinloom.llm.words import steps, text_bytes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def kind(*spans: tuple[int, int]) -> np.ndarray:
    """Flags of the bytes in the given closed spans."""
    flags = np.zeros(256, bool)
    for low, high in spans:
        flags[low : high + 1] = True
    return flags


def runs(data: np.ndarray, offsets: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of flagged bytes, and where each text's runs begin."""
    inside = flags[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each run of flagged bytes the number of its string, and the distinct strings."""
    held = data[flags[data]]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    texts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
    found = texts.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows whose texts (the last column) hold about ``limit`` bytes, or one row, with bytes and offsets.

    Small batches are laid together and large ones cut, so what a caller holds at once depends on
    the limit and the longest text alone.
    """
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        size += batch.column(batch.num_columns - 1).nbytes
        if size >= limit:
            yield from _cut(waiting, limit)
            waiting, size = [], 0
    if waiting:
        yield from _cut(waiting, limit)


def _cut(waiting: list[pa.RecordBatch], limit: int):
    whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()
    for batch in whole:
        data, offsets = text_bytes(batch.column(batch.num_columns - 1))
        parts = max(1, -(-len(data) // limit))  # of about the same size
        for a, b in steps(offsets, -(-len(data) // parts)):
            own = offsets[a : b + 1]
            yield batch.slice(a, b - a), data[own[0] : own[-1]], own - own[0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes ``start, start + 1, ...`` of all ranges, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
