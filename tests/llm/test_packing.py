import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from twinloom.llm.packing import SCHEMA, TOKENIZER, Packer, WordTokens, pack, pieces

PLAIN = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
WORDS = WordTokens(TOKENIZER, remembered=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=30) | st.text(alphabet=" \n\x1c\x85\xa0aé́Σς's<|endoftx>1日​", max_size=40) | st.text(alphabet="ÀßÿµªaZ×.,*$ ", max_size=20) | st.text(alphabet="Hh.,!\u0331<|endoftx >", max_size=20), max_size=6))
def test_ids_by_words_equal_the_tokenizer(texts):
    found = [np.frombuffer(x, "<u4").tolist() for x in WORDS.ids([t.encode() for t in texts])]
    assert found == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 30_000))
def test_pieces_cover_a_document_and_nearly_fill_their_class(length):
    cut = pieces(length)
    assert sum(cut) == length and min(cut) > 0
    for piece in cut:
        share = 4096 // piece
        assert share * piece <= 4096
        assert share >= 64 or 4096 // share - piece <= (4096 // share) / 64


def check_rows(rows, ids_of):
    parts, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset, padded in rows:
        parts[doc].append((start, length, crc, total))
        sequences[sequence].append((offset, length, padded))
    for doc, ids in ids_of.items():
        at = 0
        for start, length, crc, total in sorted(parts[doc]):
            assert start == at and total == len(ids) and length > 0
            assert zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc
            at += length
        assert at == len(ids)
    real = held = 0
    for members in sequences.values():
        at = 0
        for offset, length, padded in sorted(members):
            assert offset == at
            at += length
        assert at <= padded <= 4096 and (padded == 4096 or at == padded and padded & (padded - 1) == 0)
        real, held = real + at, held + padded
    return real / held if held else 1


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=40))
def test_packer_is_gapless_and_whole(lengths):
    packer, docs = Packer(7 << 40, 4096), {i: list(range(i, i + n)) for i, n in enumerate(lengths)}
    for doc, ids in docs.items():
        packer.add(doc, np.array(ids, "<u4").tobytes(), 1 / 64)
    packer.finish()
    check_rows(packer.rows, docs)


def test_edge_rows(spark):
    long = "hard lemon " * 6000
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, long, "x"), (4, "a b", "x")], "doc_id long, text string, sequence_id string")
    ids = {i: PLAIN.encode(t or "", add_special_tokens=False).ids + [2] for i, t, _ in docs.collect()}
    assert check_rows([tuple(r) for r in pack(docs).collect()], ids) > 0.98
    assert pack(docs.limit(0)).collect() == []
    assert pack(docs.limit(0)).columns == [f.split()[0] for f in SCHEMA.split(", ")]


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "x y"), (5, "x y")], "doc_id long, text string").coalesce(1)
    rows = pack(docs).collect()
    assert sum(r.length for r in rows) == sum(len(PLAIN.encode(t, add_special_tokens=False).ids) + 1 for t in ("a b c", "x y", "x y"))
    assert {r.doc_id for r in rows} == {None, 5}


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_padding_of_a_table_is_small(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    ids = {r.doc_id: PLAIN.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.dropDuplicates(["doc_id"]).collect()}
    rows = [tuple(r) for r in pack(docs.dropDuplicates(["doc_id"])).collect()]
    assert check_rows(rows, ids) > 0.98
