import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from twinloom.llm import coder, token_files
from twinloom.llm.queries import op13_token_ids
from twinloom.llm.token_files import TOKENIZER, PieceTokens, from_bytes, read, to_bytes, write

PLAIN = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
PIECES = PieceTokens(TOKENIZER, remembered=50)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


def by_pieces(texts):
    data = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)
    ids, counts = PIECES.ids(np.frombuffer(b"".join(data), np.uint8), offsets)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


ODD = " \n\t\x1c\x85\xa0 　aé́Σs'tllre1日<|endoftext|>.,!)("


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=30) | st.text(alphabet=ODD, max_size=40), min_size=1, max_size=6))
def test_ids_by_pieces_equal_the_tokenizer(texts):
    assert by_pieces(texts) == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_kinds_of_tokenizers_take_texts_whole():
    other = PieceTokens("word_bpe_49k.json")
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert PIECES.cuts and not other.cuts
    texts = ["Hello there, you.\nNew", "", "a b"]
    data = "".join(texts).encode()
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))).astype(np.int64)
    ids, counts = other.ids(np.frombuffer(data, np.uint8), offsets)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def back(data):
    doc_ids, counts, ids = [], [], []
    for d, c, i in from_bytes(data):
        doc_ids += d
        counts += c.tolist()
        ids += i.tolist()
    return doc_ids, counts, ids


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_file_gives_back_what_was_written(data):
    spread = data.draw(st.sampled_from([1, 2, 40, 5000, 50_257, 2**32 - 1]))
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    counts = rng.integers(1, data.draw(st.sampled_from([3, 900])), data.draw(st.integers(1, 40)))
    ids = rng.integers(0, spread, counts.sum(), dtype=np.uint32)
    doc_ids = [None, *rng.integers(-(2**63), 2**63 - 1, len(counts) - 1).tolist()]
    lanes = data.draw(st.sampled_from([1, 2, 2048]))
    assert back(to_bytes(doc_ids, counts, ids, lanes)) == (doc_ids, counts.tolist(), ids.tolist())


@pytest.mark.parametrize("name", ["same", "random", "period"])
def test_blocks_at_their_limits(name):
    n = 3 * coder.BLOCK
    ids = {
        "same": np.zeros(n, np.uint32),
        "random": np.random.default_rng(1).permutation(n).astype(np.uint32),
        "period": (np.arange(n) % 7).astype(np.uint32),
    }[name]
    for size in (n, n - 1, coder.BLOCK + 1, 1):
        data = to_bytes([4], np.array([size]), ids[:size])
        assert back(data) == ([4], [size], ids[:size].tolist())
    if name != "random":
        assert len(to_bytes([4], np.array([n]), ids)) < n / 8


def test_contexts_are_learned():
    """A text that only order 2 can foresee takes fewer bytes than its order-0 entropy."""
    rng = np.random.default_rng(2)
    pairs = {}
    ids = [0, 1]
    for _ in range(coder.BLOCK - 2):
        ids.append(pairs.setdefault((ids[-2], ids[-1]), int(rng.integers(0, 16))))
    assert len(to_bytes([1], np.array([len(ids)]), np.array(ids, np.uint32))) < coder.BLOCK // 4


def test_damage_is_found():
    ids = np.random.default_rng(3).integers(0, 300, 9000, dtype=np.uint32)
    data = bytearray(to_bytes([1], np.array([9000]), ids))
    data[-900] ^= 4
    with pytest.raises(ValueError, match="damaged"):
        back(bytes(data))
    with pytest.raises(ValueError, match="not a file"):
        back(b"x" * 40)


def check(spark, rows, files):
    found = sorted((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in read(spark, files).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, at = [], 0
    for doc_id, text in order:
        expected.append((at, doc_id, ids_of(text)))
        at += len(expected[-1][2])
    assert found == expected


def test_round_trip_over_ranges_and_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE", 3_000)
    monkeypatch.setattr(token_files, "LANES", 1)
    monkeypatch.setattr(token_files, "STEP", 2_000)
    rows = [(int(i), "word and more, " * int(n)) for i, n in zip(np.random.default_rng(5).permutation(60), range(60), strict=True)]
    rows += [(500, "long " * 30_000), (501, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    files = write(docs)
    assert files.manifest.count() > 3
    check(spark, rows, files)


def test_edge_rows(spark):
    rows = [(3, None), (1, ""), (None, "a b"), (7, "same"), (7, "same"), (7, "other"), (2, "! ! <|endoftext|> é"), (-5, "\x00 \x00")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, start long")
    check(spark, rows, write(docs))
    empty = read(spark, write(docs.limit(0)))
    assert empty.columns == ["doc_id", "start", "ids"] and empty.collect() == []


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    expected, at = [], 0
    for doc_id, text in rows:
        ids = np.array(ids_of(text), "<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, op13_token_ids(spark, sf_dir).collect())) == expected


class _Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_new_pieces_are_tokenized_together():
    """Thousands of unseen words take few texts, and none is taken apart differently for its neighbours."""
    words = [f"w{'äöüßéz'[n % 6]}{n:x}{'ñab'[n % 3]}" for n in range(5_000)]
    text = " ".join(words) + " 日本 x  y 　z"
    data = np.frombuffer(text.encode(), np.uint8)
    expected = PLAIN.encode(text, add_special_tokens=False).ids
    for sizes in (None, 7):
        pieces = PieceTokens(TOKENIZER)
        pieces.tokenizer = _Counting(pieces.tokenizer)
        if sizes:  # sizes that do not meet the pieces' ends lead to one text a piece
            pieces.sizes = np.full_like(pieces.sizes, sizes)
        ids, counts = pieces.ids(data, np.array([0, len(data)]))
        assert ids.tolist() == expected and counts.tolist() == [len(expected)]
        assert (pieces.tokenizer.texts < 500) == (sizes is None)
        pieces.ids(data, np.array([0, len(data)]))
        assert len(pieces.pieces) == len(set(pieces.pieces.to_pylist()))


def pieces_of(pieces, text):
    data = np.frombuffer(text.encode(), np.uint8)
    ids, counts = pieces.ids(data, np.array([0, len(data)]))
    assert ids.tolist() == PLAIN.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]


def test_words_are_cut_from_all_marks():
    """A word is tokenized once, whatever marks follow it and whichever Latin letter it ends in."""
    pieces = PieceTokens(TOKENIZER)
    pieces_of(pieces, "".join(f" wordo{end} wordé{end} wordß{end}" for end in ("&&&", "###", "***", "$$$", "'s", ".", "-", "\"", "")))
    words = [piece for piece in pieces.pieces.to_pylist() if b"word" in piece]
    assert len(words) == 3
    pieces_of(pieces, "a<|endoftext|>b é<|endoftext|>é<|é|>é>é <|endoftext|>\u00d7&\u00f7&\u0301& x\u00d7& y\u00f7&")


def test_recent_pieces_survive_a_small_call():
    pieces = PieceTokens(TOKENIZER, remembered=1_000)
    pieces.tokenizer = _Counting(pieces.tokenizer)
    first, second = (" ".join(f"{kind}{n:x}z" for n in range(600)) for kind in ("qa", "qb"))
    for text in (first, "small", second):
        pieces_of(pieces, text)
    known = set(pieces.pieces.to_pylist())
    assert sum(f" qa{n:x}z".encode() in known for n in range(600)) > 250
    for text in (first, second, first):
        pieces_of(pieces, text)
    assert len(pieces.pieces) < 1_300 and (np.diff(pieces.keys.astype(object)) > 0).all()


def test_long_pieces_do_not_pile_up(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_BYTES", 20_000)
    pieces = PieceTokens(TOKENIZER)
    for n in range(40):
        pieces_of(pieces, " ".join(f"{'日' * 300}{n}{k}" for k in range(4)))
    assert pieces.pieces.nbytes < 30_000


def test_pieces_of_equal_keys_stay_apart(monkeypatch):
    monkeypatch.setattr(token_files, "_keys", lambda pieces: np.full(len(pieces), 7, np.uint64))
    pieces = PieceTokens(TOKENIZER, remembered=40)
    for text in ("one two three one", "two three four", " ".join(map(str, range(60))), "one two", ""):
        pieces_of(pieces, text)


def test_keys_take_no_other_piece_in():
    pieces = [b"a" * n + end for n in range(30) for end in (b"", b"x", b"xyz")]
    together = token_files._keys(pa.array(pieces, pa.large_binary()))
    alone = [token_files._keys(pa.array([piece], pa.large_binary()))[0] for piece in pieces if piece]
    assert together[1:].tolist() == [int(key) for key in alone] and len(set(alone)) == len(set(pieces)) - 1
