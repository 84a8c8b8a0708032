import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_words import thue_morse
from twinloom.llm import queries
from twinloom.llm import near as N
from twinloom.llm.graph import components
from twinloom.llm.words import Words, text_bytes


def shingle_set(text, size):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < size:
        return {tuple(words)} - {()}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, num, den):
    sets, parent = [shingle_set(t, size) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [d for d in (least.get(root(i)), doc_id) if d is not None]
        least[root(i)] = min(known, default=None)
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


def near_rows(seed, vocabulary=60):
    rng = random.Random(seed)
    rows, words = [], [f"w{i}" for i in range(vocabulary)]
    for base in range(25):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 4, 7, 30, 120, 300]))]
        for _ in range(rng.randrange(1, 9)):  # chains: each copy is made from the one before
            rows.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randrange(1 + len(text) // 40)):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                text[0] = text[0].upper()
    rows = [(i, t) for i, t in enumerate(rows)]
    rng.shuffle(rows)
    return rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aB \n", max_size=16), max_size=6), st.integers(1, 4))
def test_shingles(texts, size):
    sets = N.shingles(Words(*text_bytes(pa.array(texts, pa.string())), lower=True), size)
    assert [len(s) for s in sets] == [len(shingle_set(t, size)) for t in texts]


def test_estimate_and_chance():
    rng = np.random.default_rng(1)
    a, b, common = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (400, 300, 3000))
    sets = [np.unique(np.concatenate((common, a))), np.unique(np.concatenate((common, b)))]
    regs = N.registers(sets)
    same, filled = (regs[0] == regs[1]).sum(), (regs > 0).any(axis=0).sum()
    assert abs(same / filled - 3000 / 3700) < 0.1
    other = [rng.integers(0, 2**64, 5000, dtype=np.uint64) for _ in range(200)]
    regs = N.registers([np.unique(o) for o in other])
    met = np.mean([(regs[i] == regs[i + 1]).mean() for i in range(0, 200, 2)])
    n = np.array([5000.0])
    assert 0.2 * N.chance(n, n)[0] < met < 5 * N.chance(n, n)[0]


def test_pairs_at_the_threshold_share_a_band():
    rng = np.random.default_rng(2)
    missed = 0
    for n in (1, 2, 5, 8, 20, 60, 200, 1000):
        for _ in range(60):
            base = rng.integers(0, 2**64, n, dtype=np.uint64)
            new = rng.integers(0, 2**64, n // 12, dtype=np.uint64)  # J = (n - d) / (n + d), 0.846 for d = n / 12
            pair = [np.unique(base), np.unique(np.concatenate((base[n // 12 :], new)))]
            regs = N.registers(pair)
            keys = [set(N.bands(regs[i : i + 1])[1].tolist()) for i in (0, 1)]
            missed += not keys[0] & keys[1]
    assert missed == 0


@pytest.mark.parametrize("seed, size, num, block", [(1, 3, 85, 1024), (2, 5, 80, 4), (3, 1, 60, 3)])
def test_components_equal_brute_force(spark, seed, size, num, block, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "PAIRS", 50)
    rows = near_rows(seed) + [(500, None), (501, ""), (502, " \n"), (None, "q q q q"), (None, "r r"), (3, "s t u v"), (3, "s t u v")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, registers string").repartition(3)
    found = N.near_duplicates(docs, size, (num, 100)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == sorted(brute(rows, size, num, 100), key=str)
    ids = [r for r in found if r.doc_id is not None and r.doc_id != 3]
    assert all(r.kept == (r.doc_id == r.component_id) for r in ids)
    assert sum(r.kept for r in found if r.doc_id == 3 and r.n_shingles == len(shingle_set("s t u v", size))) <= 1


def test_sample_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, (85, 100)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute(rows, 3, 85, 100))
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=9), st.integers(1, 12))
def test_pairs_of_groups(sizes, limit):
    ends = np.repeat(np.cumsum(sizes, dtype=np.int64), sizes).astype(np.int64)
    found = [(i, j) for a, b in N._pairs(ends, limit) for i, j in zip(a.tolist(), b.tolist())]
    assert found == [(i, j) for i in range(len(ends)) for j in range(i + 1, int(ends[i]))]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=30))
def test_components(spark, links):
    parent = {i: i for link in links for i in link}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: root(i) for a, b in links if a != b for i in parent if root(i) == root(a)}


def test_words_that_agree_under_every_polynomial(spark):
    texts = [thue_morse(1024), thue_morse(1024, "ba")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = N.near_duplicates(docs, size=3, similar=(85, 100)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(0, 0), (1, 1)]


def test_query_keeps_by_number(spark, tmp_path):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (5, "a b c d e f"), (None, ""), (7, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op5_near_duplicates(spark, str(tmp_path)).collect()
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted(map(tuple, found), key=key) == sorted([(3, 4, 3, True), (3, 4, 3, True), (5, 4, 3, False), (None, 0, None, True), (7, 0, 7, True)], key=key)
