"""Token ids of documents in binary files, in ascending doc_id order.

``write`` tokenizes texts, sorts them by range of doc_id and lets each task write files of
about ``LANES`` blocks; ``read`` gives the documents back from the files. Ids are coded in blocks of
``coder.BLOCK`` ids that start from nothing and carry the crc32 of their ids, so a damaged block is
found when it is read.

A file, little-endian: ``TLID``, then 32-bit numbers of version, lanes of a group, documents,
blocks and bytes of the deflated document table (doc_id, whether it is known, number of ids);
then the 32-bit columns ids, distinct ids, bytes of the id list, bytes of the code and crc32 of
all blocks; then the id list and code of each block. An id list holds the gaps between ascending
ids, a byte each; 255 stands for the next of the 32-bit gaps that follow the bytes.

Files are written beside their place and renamed, under names that follow from range and number.
A task that runs again therefore writes the same files again, and a reader never sees half of one.
The manifest, one row a file, is written last and says which ids came before.

Defined cases: a null or empty text is the closing id alone; null doc_ids come first; rows of
equal doc_id are ordered by text; a string such as ``<|endoftext|>`` in a text is what the
tokenizer makes of it by default, its special id; other columns are ignored; no rows give no files.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinloom.llm import coder
from twinloom.llm.rows import written
from twinloom.llm.runs import gathered, kind, spread
from twinloom.llm.words import mixed, text_bytes
from twinloom.session import shared_folder

TOKENIZER = "byte_bpe_50k.json"
CLOSING_ID = 0
#: Blocks that are coded in lockstep.
LANES = 2048
#: Bytes of text of a range of doc_ids.
RANGE = 40 << 20
#: Bytes of text that are tokenized at once.
STEP = 8 << 20
MAGIC, VERSION = b"TLID", 2
MANIFEST = "range int, number int, file string, n_docs bigint, n_ids bigint, n_bytes bigint"
#: Ids below this are found by flags instead of sorting a block's ids.
FLAGGED = 1 << 17
#: Files of a manifest that is sent to all tasks.
BROADCAST_FILES = 500_000

#: Bytes of text of a call of the tokenizer for pieces laid together.
JOINED = 1 << 10

#: Bytes of remembered pieces beyond which half of them are forgotten.
REMEMBERED_BYTES = 64 << 20
#: Pieces whose ids are laid side by side at once.
SPREAD = 1 << 15

_PLAIN = kind((0x21, 0x7E))
#: First bytes of two-byte characters from U+00C0 to U+07FF, none of which is white space.
_PAIR = kind((0xC3, 0xDF))
_LETTER = kind((0x41, 0x5A), (0x61, 0x7A))
_MARKS = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~<|>"
#: What a byte can be, in bits: white space to cut at, a mark to cut at, an ASCII character other than white space, an
#: ASCII letter, the rest of a character, the first byte of a pair, that of one from U+00C0 to U+024F, which but for the
#: signs of times and division are letters, and either byte of these signs.
_SPACE, _MARK, _ASCII, _ALPHA, _REST, _LEAD, _LATIN, _SIGN = (1 << bit for bit in range(8))
_KINDS = sum(
    bit * flags.astype(np.uint8)
    for bit, flags in (
        (_SPACE, kind((0x20, 0x20), (0x0A, 0x0A))),
        (_MARK, np.isin(np.arange(256), list(_MARKS.encode()))),
        (_ASCII, _PLAIN),
        (_ALPHA, _LETTER),
        (_REST, kind((0x80, 0xBF))),
        (_LEAD, _PAIR),
        (_LATIN, kind((0xC3, 0xC9))),
        (_SIGN, np.isin(np.arange(256), (0xC3, 0x97, 0xB7))),
    )
)


def _keys(pieces: pa.Array) -> np.ndarray:
    """A number for each piece, made of its length, its first 16 and its last 8 bytes."""
    data, at = text_bytes(pieces)
    size = np.diff(at)
    padded = np.concatenate((np.zeros(8, np.uint8), data, np.zeros(16, np.uint8)))
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    bits = (np.clip(8 - size, 0, 7) * 8).astype(np.uint64)  # that lie beyond a short piece
    more = (np.clip(16 - size, 0, 7) * 8).astype(np.uint64)
    key = mixed((eight[at[:-1] + 8] << bits) + mixed(size.astype(np.uint64)))
    key = mixed(key + np.where(size > 8, eight[at[:-1] + 16] << more, 0))
    return mixed(key + (eight[at[1:]] >> bits))


class PieceTokens:
    """Token ids of texts, by pieces that the tokenizer never merges across.

    A byte-level pre-tokenizer starts anew at a space and around a line feed that stand between two
    characters other than white space, and at a mark after a Latin letter, so a text's ids
    are those of the pieces cut there. Only characters that are surely no white space count; elsewhere
    pieces are just longer. Whether the tokenizer is of this kind is checked once; texts of any
    other are taken whole. About ``remembered`` pieces and their ids are kept in arrays; when these are
    full, the half that was used last stays. A piece is looked up by its key and then compared; one whose
    key belongs to another piece is not found again.
    """

    def __init__(self, name: str, remembered: int = 1_200_000):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        about = json.loads(self.tokenizer.to_str())
        before = about.get("pre_tokenizer") or {}
        added = "".join(token["content"] for token in about.get("added_tokens", ()))
        self.cuts = (
            about.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and bool(before.get("use_regex", True))
            and not before.get("add_prefix_space", True)
            and about["model"]["type"] == "BPE"
            and not re.search(r"[\s!),.:;?]", added)
            and not re.fullmatch("[A-Za-z]*", added or "<")
        )
        kinds = _KINDS.copy()
        kinds[list(added.encode())] &= 255 - _MARK  # no cuts inside an added token
        self.kinds = kinds.tobytes()
        if self.cuts:  # bytes of text that an id stands for; a character of a byte-level vocabulary is a byte
            own = {token["id"]: token["content"].encode() for token in about.get("added_tokens", ())}
            sizes = {number: len(own.get(number, token)) for token, number in self.tokenizer.get_vocab().items()}
            self.sizes = np.zeros(max(sizes) + 1, np.int64)
            self.sizes[list(sizes)] = list(sizes.values())
        self.remembered = remembered
        # The empty piece comes first and stays. Keys ascend, each with its piece's number.
        self.pieces = pa.array([b""], pa.large_binary())
        self.keys, self.entry = _keys(self.pieces), np.zeros(1, np.int32)
        # Where a piece's ids start, how many they are, and the last call that needed them.
        self.start, self.count, self.used = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int32)
        self.flat, self.call = np.zeros(0, np.uint32), 0

    def _forget(self) -> None:
        half = (len(self.used) + 1) // 2
        stays = np.zeros(len(self.used), bool)
        stays[np.argpartition(self.used, -half)[-half:]] = True
        stays[0] = True
        self.pieces, count = self.pieces.filter(pa.array(stays)), self.count[stays]
        self.flat = self.flat[spread(self.start[stays], count)]
        self.start, self.count, self.used = np.cumsum(count) - count, count, self.used[stays]
        keyed = stays[self.entry]
        self.keys, self.entry = self.keys[keyed], (np.cumsum(stays, dtype=np.int32) - 1)[self.entry[keyed]]

    def _entries(self, pieces: pa.Array) -> np.ndarray:
        """The numbers of the distinct pieces among the remembered ones; new ones are tokenized."""
        if len(self.pieces) + len(pieces) > self.remembered or self.pieces.nbytes > REMEMBERED_BYTES:
            self._forget()
        self.call += 1
        key = _keys(pieces)
        order = np.argsort(key)
        key = key[order]
        place = np.searchsorted(self.keys, key)
        near = np.minimum(place, len(self.keys) - 1)
        taken = self.keys[near] == key
        entry = np.zeros(len(pieces), np.int64)
        entry[order] = self.entry[near]
        alike = pc.equal(self.pieces.take(pa.array(entry)), pieces).to_numpy(zero_copy_only=False)
        new = ~alike
        if new.any():
            fresh = pieces.filter(pa.array(new))
            entry[new] = len(self.pieces) + np.arange(len(fresh))
            free = new[order] & ~taken
            free[1:] &= key[1:] != key[:-1]
            self.keys = np.insert(self.keys, place[free], key[free])
            self.entry = np.insert(self.entry, place[free], entry[order[free]])
            count, ids = self._encoded(fresh)
            self.pieces = pa.concat_arrays([self.pieces, fresh])
            self.start = np.append(self.start, len(self.flat) + np.cumsum(count) - count)
            self.count, self.flat = np.append(self.count, count), np.append(self.flat, ids)
            self.used = np.append(self.used, np.zeros(len(fresh), np.int32))
        self.used[entry] = self.call
        return entry

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all of them one after the other.

        Pieces that begin with a space before, and end in, a character that is surely no white space may
        follow one another in one text, which is cut between them. Where each one's ids end follows from the
        bytes that the ids stand for; should these not meet the pieces' ends, all are tokenized one by one.
        """
        data, at = text_bytes(pieces)
        first, last, size = at[:-1], at[1:] - 1, np.diff(at)
        fit = np.zeros(len(pieces), bool)
        if self.cuts:
            some = np.flatnonzero((size > 1) & (data[first] == 32))
            second, end = data[first[some] + 1], data[last[some]]
            after = _PLAIN[second] | _PAIR[second]
            fit[some] = after & (_PLAIN[end] | (_PAIR[data[last[some] - 1]] & (end >= 0x80)))
        count, parts = np.zeros(len(pieces), np.int64), []
        if fit.any():
            text, ends = data[np.repeat(fit, size)].tobytes(), np.cumsum(size[fit])
            cuts = ends[np.searchsorted(ends, np.arange(JOINED, len(text), JOINED))].tolist() + [len(text)]
            texts = [text[a:b].decode() for a, b in zip([0, *cuts], cuts) if a < b]
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(one.ids, np.uint32) for one in encoded])
            reached = np.append(np.cumsum(self.sizes[ids]), len(text) + 1)
            stop = np.searchsorted(reached, ends)
            if (reached[stop] == ends).all() and stop[-1] + 1 == len(ids):
                count[fit] = np.diff(stop, prepend=-1)
                parts.append(ids)
            else:
                fit[:] = False
        encoded = self.tokenizer.encode_batch_fast(
            [piece.decode() for piece in pieces.filter(pa.array(~fit)).to_pylist()], add_special_tokens=False
        )
        alone = [array("I", one.ids) for one in encoded]
        count[~fit] = list(map(len, alone))
        ids = np.concatenate([*parts, np.frombuffer(b"".join(one.tobytes() for one in alone), np.uint32)])
        order = np.concatenate((np.flatnonzero(fit), np.flatnonzero(~fit)))
        start = np.zeros(len(pieces), np.int64)
        start[order] = np.cumsum(count[order]) - count[order]
        return count, ids[spread(start, count)]

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        mark = np.zeros(len(data) + 1, bool)
        if self.cuts and len(data) > 2:
            kinds = np.frombuffer(data.tobytes().translate(self.kinds), np.uint8)
            first, second = kinds[:-1], kinds[1:]
            # Whether a character that is surely no white space, or a letter, ends at a byte.
            solid, letter = (kinds & _ASCII) > 0, (kinds & _ALPHA) > 0
            rest = (second & _REST) > 0
            solid[1:] |= ((first & _LEAD) > 0) & rest
            rest &= (first & _LATIN) > 0
            letter[1:] |= rest & ((first & second & _SIGN) == 0)
            space = (kinds[1:-1] & _SPACE) > 0
            space &= solid[:-2]
            space &= (kinds[2:] & (_ASCII | _LEAD)) > 0
            mark[1:-2] = space
            mark[2:-1] |= space & (data[1:-1] == 10)
            mark[1:-1] |= ((second & _MARK) > 0) & letter[:-1]
        mark[offsets[:-1]] = True
        return np.flatnonzero(mark[: len(data)])

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        starts = self._starts(data, offsets)
        texts = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data.tobytes())]
        )
        found = texts.dictionary_encode()
        entry = self._entries(found.dictionary)
        own, start, count = found.indices.to_numpy(), self.start[entry], self.count[entry]
        at = np.zeros(len(own) + 1, np.int64)
        np.cumsum(count[own], out=at[1:])
        ids = np.empty(at[-1], np.uint32)
        for a in range(0, len(own), SPREAD):
            part = own[a : a + SPREAD]
            ids[at[a] : at[a + len(part)]] = self.flat[spread(start[part], count[part])]
        return ids, np.diff(at[np.searchsorted(starts, offsets)])


_tokens: dict[str, PieceTokens] = {}


def piece_tokens(name: str) -> PieceTokens:
    """The tokenizer of this worker process, kept between tasks."""
    if name not in _tokens:
        _tokens[name] = PieceTokens(name)
    return _tokens[name]


def _gaps(ids: np.ndarray) -> bytes:
    gaps = np.diff(ids.astype(np.int64), prepend=-1) - 1
    return np.minimum(gaps, 255).astype(np.uint8).tobytes() + gaps[gaps >= 255].astype("<u4").tobytes()


def _listed(data: bytes, count: int) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint8, count).astype(np.int64)
    gaps[gaps == 255] = np.frombuffer(data, "<u4", offset=count)
    return (np.cumsum(gaps + 1) - 1).astype("<u4")


def to_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, lanes: int = LANES) -> bytes:
    """A file of documents with the given numbers of ids."""
    blocks = -(-len(ids) // coder.BLOCK)
    columns, bodies = np.zeros((5, blocks), "<u4"), []
    held = np.zeros(int(ids.max(initial=0)) + 1, bool) if ids.max(initial=0) < FLAGGED else None
    place = np.zeros(0 if held is None else len(held), np.uint16)
    for first in range(0, blocks, lanes):
        numbers = coder.table(min(lanes, blocks - first), coder.BLOCK)
        lists = []
        for lane in range(len(numbers)):
            own = ids[(first + lane) * coder.BLOCK : (first + lane + 1) * coder.BLOCK]
            if held is None:
                listed, inverse = np.unique(own, return_inverse=True)
            else:  # the same without sorting
                held[own] = True
                listed = np.flatnonzero(held)
                held[listed] = False
                place[listed] = np.arange(len(listed))
                inverse = place[own]
            numbers[lane, : len(own)] = inverse
            lists.append(_gaps(listed))
            columns[:3, first + lane] = len(own), len(listed), len(lists[-1])
            columns[4, first + lane] = zlib.crc32(own.astype("<u4").tobytes())
        part = slice(first, first + len(numbers))
        codes = coder.encode(numbers, columns[0, part].astype(np.int64), columns[1, part].astype(np.int64))
        columns[3, part] = [len(code) for code in codes]
        bodies += [body for pair in zip(lists, codes, strict=True) for body in pair]
    known = np.array([doc_id is not None for doc_id in doc_ids], np.uint8)
    numbers = np.array([doc_id or 0 for doc_id in doc_ids], "<i8")
    table = zlib.compress(np.diff(numbers, prepend=0).astype("<i8").tobytes() + known.tobytes() + counts.astype("<u4").tobytes(), 1)
    head = MAGIC + struct.pack("<5I", VERSION, lanes, len(doc_ids), blocks, len(table))
    return b"".join([head, table, columns.tobytes(), *bodies])


def from_bytes(data: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Documents of a file, a group of blocks at a time: their doc_ids, numbers of ids, and ids."""
    if data[:4] != MAGIC:
        raise ValueError("not a file of token ids")
    version, lanes, docs, blocks, size = struct.unpack_from("<5I", data, 4)
    if version != VERSION:
        raise ValueError(f"version {version} of a file of token ids is not known")
    table = zlib.decompress(data[24 : 24 + size])
    numbers = np.cumsum(np.frombuffer(table, "<i8", docs))
    known = np.frombuffer(table, np.uint8, docs, 8 * docs)
    counts = np.frombuffer(table, "<u4", docs, 9 * docs).astype(np.int64)
    doc_ids = [number if here else None for number, here in zip(numbers.tolist(), known.tolist(), strict=True)]
    at = 24 + size
    length, distinct, listed, coded, crc = np.frombuffer(data, "<u4", 5 * blocks, at).reshape(5, blocks).astype(np.int64)
    at += 20 * blocks
    ends, done, rest = np.cumsum(counts), 0, np.zeros(0, np.uint32)
    for first in range(0, blocks, lanes):
        part = range(first, min(first + lanes, blocks))
        lists, codes = [], []
        for block in part:
            lists.append(_listed(data[at : at + listed[block]], distinct[block]))
            at += listed[block]
            codes.append(data[at : at + coded[block]])
            at += coded[block]
        found = coder.decode(codes, length[first : part.stop], distinct[first : part.stop])
        parts = [rest]
        for lane, block in enumerate(part):
            own = lists[lane][np.minimum(found[lane, : length[block]], int(distinct[block] - 1))]
            if zlib.crc32(own.tobytes()) != crc[block]:
                raise ValueError(f"block {block} of a file of token ids is damaged")
            parts.append(own)
        ids = np.concatenate(parts)
        begun = int(ends[done - 1]) if done else 0
        whole = int(np.searchsorted(ends, begun + len(ids), "right"))
        taken = int(ends[whole - 1]) - begun if whole > done else 0
        yield doc_ids[done:whole], counts[done:whole], ids[:taken]
        rest, done = ids[taken:], whole


def _place(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if folder.startswith("file:/"):
        folder = "/" + folder[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, data: bytes, attempt: int) -> None:
    system, base = _place(folder)
    beside = f"{base}/_{name}.{attempt}"
    with system.open_output_stream(beside) as out:
        out.write(data)
    system.move(beside, f"{base}/{name}")


@dataclass(frozen=True)
class TokenFiles:
    """A folder of files and its manifest: file, documents, ids, bytes, and the ids before it."""

    folder: str
    manifest: DataFrame


def write(docs: DataFrame, tokenizer: str = TOKENIZER, closing_id: int = CLOSING_ID) -> TokenFiles:
    """Files of all rows of ``docs`` (doc_id, text) in the shared folder."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-ids")
    system, base = _place(folder)
    system.create_dir(base)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE))
    ordered = texts.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    full = LANES * coder.BLOCK

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task = piece_tokens(tokenizer), TaskContext.get()
        number, doc_ids, counts, parts, held = 0, [], [], [], 0

        def closed() -> pa.RecordBatch:
            name = f"part-{task.partitionId():06d}-{number:06d}.ids"
            data = to_bytes(doc_ids, np.concatenate(counts), np.concatenate(parts))
            _put(folder, name, data, task.taskAttemptId())
            row = (task.partitionId(), number, name, len(doc_ids), held, len(data))
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

        names = [field.split()[0] for field in MANIFEST.split(", ")]
        for rows, data, offsets in gathered(batches, STEP):
            ids, count = tokens.ids(data, offsets)
            ends = np.cumsum(count)
            ids, count = np.insert(ids, ends, np.uint32(closing_id)), count + 1
            ends = np.cumsum(count)
            begun, own = 0, rows.column(0).to_pylist()
            while begun < len(own):  # as many documents as fill the file, at least one
                before = int(ends[begun - 1]) if begun else 0
                stop = max(begun + 1, int(np.searchsorted(ends, before + full - held, "right")))
                doc_ids += own[begun:stop]
                counts.append(count[begun:stop])
                parts.append(ids[before : int(ends[stop - 1])])
                held += len(parts[-1])
                begun = stop
                if begun < len(own) or held >= full:
                    yield closed()
                    number, doc_ids, counts, parts, held = number + 1, [], [], [], 0
        if doc_ids:
            yield closed()

    manifest = written(ordered.mapInArrow(work, MANIFEST), "manifest")
    earlier = Window.orderBy("range", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return TokenFiles(folder, manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))))


def read(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id, start (ids of all documents before) and ids (32-bit little-endian) of each document."""
    if files.manifest.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, ids binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                before = 0
                for doc_ids, counts, ids in from_bytes(content.as_buffer().to_pybytes()):
                    ends = np.cumsum(counts)
                    for a in range(0, len(doc_ids), 1000):
                        b = min(a + 1000, len(doc_ids))
                        own = ends[a:b] - counts[a:b]
                        data = ids[int(own[0]) : int(ends[b - 1])].astype("<u4").tobytes()
                        at = np.append(own - own[0], ends[b - 1] - own[0]) * 4
                        texts = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(at), pa.py_buffer(data)])
                        columns = [pa.array([name] * (b - a)), pa.array(doc_ids[a:b], pa.int64()), pa.array(before + own), texts.cast(pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "place", "ids"])
                    before += int(counts.sum())

    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(files.folder)
    stored = stored.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    found = stored.mapInArrow(work, "file string, doc_id bigint, place bigint, ids binary")
    starts = files.manifest.select("file", "first_id")
    if starts.count() <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    return found.join(starts, "file").select("doc_id", (F.col("first_id") + F.col("place")).alias("start"), "ids")
