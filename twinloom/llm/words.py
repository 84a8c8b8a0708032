"""Whole batches of texts as arrays: bytes, words and word hashes, without a Python object per word.

A word is a run of bytes other than space and 0x09-0x0D; such bytes never occur inside a
multi-byte character, so this equals ``[^\\x20\\x09-\\x0D]+`` on the text. A null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2)
_BYTES += np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

#: Bytes of text that one step of array work takes at most, a longer single text aside.
STEP = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, modulo 2^64, of the base of rolling hashes and of its inverse."""
    global _powers
    if n > len(_powers[0]):
        size, ladders = 1 << max(12, (n - 1).bit_length()), []
        for base in (_BASE, _INVERSE):
            ladder = np.full(size, base, np.uint64)
            ladder[0] = 1
            ladders.append(np.multiply.accumulate(ladder))
        _powers = tuple(ladders)
    return _powers[0][:n], _powers[1][:n]


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A position-free hash of ``values[start:end]`` for each pair, from one prefix sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.multiply(values, up[:-1], out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    length = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * down[starts] + mixed(length))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets at which each begins and the last ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(offsets: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``limit`` bytes, or one text."""
    start, texts = 0, len(offsets) - 1
    while start < texts:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(texts, max(end, start + 1))
        yield start, end
        start = end


class Words:
    """The words of a range of texts: byte ranges, hashes, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        offsets = np.asarray(offsets)
        data = data[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        inside = (self.data != 32) & ((self.data < 9) | (self.data > 13))
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        first[edge] = inside[edge]
        last[edge - 1] = inside[edge - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: Words of text i: bounds[i]:bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def texts(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """Of each word, the mixed sum of a value drawn for each (place in the word, byte).

        A polynomial would do for short words only: modulo 2^64 there are words of 1024 bytes that
        every polynomial maps to the same value, whatever its base.
        """
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        length = self.ends - self.starts
        total = int(length.sum())
        first = np.cumsum(length) - length
        place = np.arange(total, dtype=np.uint64)
        place -= np.repeat(first.astype(np.uint64), length)
        place *= _BASE
        place += _BYTES[self.data[np.repeat(self.starts - first, length) + np.arange(total)]]
        drawn = np.add.reduceat(mixed(place), first)
        return mixed(drawn + mixed(length.astype(np.uint64)))


def windows(bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each run of ``size`` words within a text, and its text."""
    per_text = np.maximum(np.diff(bounds) - size + 1, 0)
    text = np.repeat(np.arange(len(per_text)), per_text)
    before = np.concatenate(([0], np.cumsum(per_text)))[:-1]
    return np.arange(per_text.sum()) - before[text] + bounds[:-1][text], text


def joined(words: Words, offsets: np.ndarray, keep: np.ndarray | None = None) -> list[bytes]:
    """Of each text, its words, or those kept, joined by one space."""
    keep = slice(None) if keep is None else keep
    offsets = np.asarray(offsets) - offsets[0]
    starts, ends = words.starts[keep], words.ends[keep]
    ends = ends + (ends < np.repeat(offsets[1:], words.counts)[keep])  # with the separator, if one follows
    change = np.zeros(len(words.data) + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8) > 0
    data = words.data[inside]
    data[(data >= 9) & (data <= 13)] = 32
    at = np.concatenate(([0], np.cumsum(inside)))[offsets]
    return [data[s:e].tobytes().rstrip(b" ") for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
