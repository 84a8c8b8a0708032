"""Each stage on what its predecessor kept, against brute force."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm.test_exact import plain
from tests.llm.test_near import brute as near_brute
from tests.llm.test_packing import check_rows
from twinloom.llm.rows import written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name)
        out.append(docs)
    return [frame.collect() for frame in out], [frame.columns for frame in out]


def test_columns(stages):
    assert [name for name, _ in C.STAGES] == ["quality", "exact", "near", "mixing", "packing"]
    assert all(columns == stages[1][0] for columns in stages[1][1:5])


def test_quality_keeps_good_labelled_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[0][1]}
    assert all(i in kept for i, q in labels.items() if q == 1)
    junk = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in junk) <= 0.2 * len(junk)


def test_one_of_each_group_of_equal_texts_stays(stages):
    least = {}
    for r in stages[0][1]:
        least[plain(r.text)] = min(r.doc_id, least.get(plain(r.text), r.doc_id))
    assert sorted(r.doc_id for r in stages[0][2]) == sorted(least.values())


def test_one_of_each_near_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[0][2]]
    assert sorted(r.doc_id for r in stages[0][3]) == sorted(d for d, _, c in near_brute(rows, 5, 80, 100) if d == c)


def test_mixing_repeats_small_sources_and_keeps_all(stages):
    before, after = Counter(r.doc_id for r in stages[0][3]), Counter(r.doc_id for r in stages[0][4])
    assert set(before) == set(after) and max(after.values()) <= 2
    words = defaultdict(int)
    for r in stages[0][4]:
        words[r.source] += len(r.text.split())
    first = defaultdict(int)
    for r in stages[0][3]:
        first[r.source] += len(r.text.split())
    assert max(words.values()) / min(words.values()) <= max(first.values()) / min(first.values())


def test_packing_of_repeated_documents_is_whole(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    copies = Counter(r.doc_id for r in stages[0][4])
    length = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in stages[0][4]}
    packed = Counter()
    for r in stages[0][5]:
        packed[r.doc_id] += r.length
        assert r.doc_tokens == length[r.doc_id]
    assert packed == {i: n * length[i] for i, n in copies.items()}
    assert check_rows([(i, *tuple(r)[1:]) for i, r in enumerate(stages[0][5])], {}) > 0.9


def test_run_equals_the_stages(spark, stages):
    found = C.run(spark, SF_DIR).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sum(r.length for r in found) == sum(r.length for r in stages[0][5])
    assert {key(r)[0] for r in found} == {key(r)[0] for r in stages[0][5]}


def test_clashing_columns_and_nulls(spark):
    rows = [(1, "a b c d e f", "s", 1, "x", 0.5), (2, None, None, 2, None, None), (None, "a  b c d e f", "s", 3, "y", None), (3, "", "t", 4, "z", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _row long, row string, score double")
    for _, stage in C.STAGES[:4]:
        docs = written(stage(spark, docs, SF_DIR), "clash")
        assert docs.columns == ["doc_id", "text", "source", "_row", "row", "score"]
    assert C.STAGES[4][1](spark, docs, SF_DIR).count() > 0
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
