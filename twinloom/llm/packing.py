"""Harmonic packing of token sequences, independently on every worker.

Lengths fall into reciprocal classes of the capacity C: a length l with C // l = j has class j,
and every sequence of class j holds exactly j pieces. A worker keeps one open sequence a class
and needs nothing from other workers. A document is cut so that its pieces nearly fill their
class: whole sequences first, then the exact share of the next smaller class until the rest
leaves at most ``slack`` of its slot unused. What open sequences hold when a worker's input ends
is laid end to end, cut at the capacity, and the last tokens are cut into powers of two, which
need no padding.

Nothing is shuffled; a worker holds only its open sequences, whose size depends on C alone. Ids
of sequences come from the partition, so the input's partitions must be reproducible, as those
of a table are.

Defined cases: a null or empty text is the closing id alone; a null doc_id stays null; repeated
rows are packed each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from twinloom.llm.words import steps, text_bytes

CAPACITY = 4096
CLOSING_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: From this class on, lengths are so short that no further cut pays.
FINE_CLASS = 64
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, padded_to bigint"
)


_SIMPLE = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\xbf])+)([.,;:!?*$%&#]*)")
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
#: Byte-level tokenizers write a byte that is not printable as a character from 256 on.
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def stem(word: bytes) -> tuple[str | None, bytes]:
    """Of Latin-1 letters and closing marks, the letters in lower case and the marks; else (None, word).

    For such words the tokenizer's normal form is the lower case, and the letters and the run of
    marks are one piece each, so their ids follow each other.
    """
    found = _SIMPLE.fullmatch(word)
    if found:
        letters = found[1].decode()
        if letters.isalpha():
            return letters.lower(), found[2]
    return None, word


class WordTokens:
    """Token ids of texts, by words.

    The tokenizer never merges across white space, so a text's ids are those of its words.
    Ids of words are remembered in two generations of bounded size.
    """

    def __init__(self, name: str, remembered: int = 800_000):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        self.remembered = remembered
        self.model = self.tokenizer.model
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Of each text, its ids as unsigned 32-bit integers, little-endian on all machines that Spark supports."""
        split = [text.split() for text in texts]
        words = set().union(*split)
        new = words.difference(self.young)
        if len(self.young) + len(new) > self.remembered and self.young:
            self.old, self.young = self.young, {}
            new = words
        plain, parts = [], []
        for word in new:
            known = self.old.get(word)
            if known is not None:
                self.young[word] = known
                continue
            letters, marks = stem(word)
            if letters is None:
                plain.append(word)
            else:
                parts.append((word, letters, marks))
        plain += {marks for _, _, marks in parts if marks and marks not in self.young}
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in plain], add_special_tokens=False)
        for word, one in zip(plain, encoded, strict=True):
            self.young[word] = array("I", one.ids).tobytes()
        for word, letters, marks in parts:
            shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_BYTE_LEVEL)
            ids = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
            self.young[word] = ids + self.young[marks] if marks else ids
        find = self.young.__getitem__
        return [b"".join(map(find, words)) for words in split]


_tokens: dict[str, WordTokens] = {}


def word_tokens(name: str) -> WordTokens:
    """The tokenizer of this worker process, kept between tasks."""
    if name not in _tokens:
        _tokens[name] = WordTokens(name)
    return _tokens[name]


def pieces(length: int, capacity: int = CAPACITY, slack: float = 1 / 64) -> list[int]:
    """Lengths into which a document of ``length`` ids is cut."""
    out, rest = [capacity] * (length // capacity), length % capacity
    while rest:
        share = capacity // rest
        if share >= FINE_CLASS or capacity // share - rest <= slack * (capacity // share):
            out.append(rest)
            break
        out.append(capacity // (share + 1))
        rest -= out[-1]
    return out


class Packer:
    """Open sequences by class; closed ones become rows."""

    def __init__(self, first_id: int, capacity: int):
        self.next_id, self.capacity = first_id, capacity
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.rows: list[tuple] = []

    def close(self, members: list[tuple], padded_to: int) -> None:
        offset = 0
        for doc_id, start, ids, total in members:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, zlib.crc32(ids), total, self.next_id, offset, padded_to))
            offset += length
        self.next_id += 1

    def add(self, doc_id: int | None, ids: bytes, slack: float) -> None:
        total, start = len(ids) // 4, 0
        for length in pieces(total, self.capacity, slack):
            share = self.capacity // length
            members = self.open[share]
            members.append((doc_id, start, ids[4 * start : 4 * (start + length)], total))
            start += length
            if len(members) == share:
                self.close(members, self.capacity)
                del self.open[share]

    def finish(self) -> None:
        rest = [piece for share in sorted(self.open) for piece in self.open[share]]
        self.open.clear()
        left = sum(len(ids) for _, _, ids, _ in rest) // 4
        room = self._room(left)
        members, filled = [], 0
        for doc_id, start, ids, total in rest:
            while ids:
                take = min(len(ids) // 4, room - filled)
                members.append((doc_id, start, ids[: 4 * take], total))
                start, ids, filled, left = start + take, ids[4 * take :], filled + take, left - take
                if filled == room:
                    self.close(members, room)
                    members, filled, room = [], 0, self._room(left)

    def _room(self, left: int) -> int:
        """The largest power of two that the tokens left fill, or the capacity."""
        return self.capacity if left >= self.capacity else 1 << max(0, left.bit_length() - 1)

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 8
        self.rows = []
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, closing_id: int = CLOSING_ID, slack: float = 1 / 64
) -> DataFrame:
    """One row a piece: where it lies in its document and in which sequence at which offset."""
    closing = np.array([closing_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 40, capacity)
        tokens = word_tokens(tokenizer)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            for a, b in steps(offsets, 1 << 20):
                texts = [data[s:e].tobytes() for s, e in zip(offsets[a:b], offsets[a + 1 : b + 1], strict=True)]
                for doc_id, ids in zip(doc_ids[a:b], tokens.ids(texts), strict=True):
                    packer.add(doc_id, ids + closing, slack)
                yield packer.taken()
        packer.finish()
        yield packer.taken()

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(work, SCHEMA)
