import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinloom.llm import exact
from twinloom.llm.words import text_bytes

POLYNOMIAL = exact.Polynomial(exact.BASES[0], exact.PRIMES[0])


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab \t\n\x0bé\x85", max_size=10), max_size=8))
def test_normalized(texts):
    data, ends = exact.normalized(*text_bytes(pa.array(texts, pa.string())))
    assert [data[s:e].tobytes().decode() for s, e in zip(ends[:-1], ends[1:])] == [plain(t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 4000), min_size=1, max_size=6), st.integers(0, 2**32))
def test_chunk_hashes_combine_to_the_sequential_hash(lengths, seed):
    data = np.random.default_rng(seed).integers(0, 256, sum(lengths), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    expected = []
    for s, e in zip(offsets[:-1], offsets[1:]):
        value = 0
        for byte in data[s:e][::-1].tolist():
            value = (value * POLYNOMIAL.base + byte + 1) % POLYNOMIAL.prime
        expected.append(value)
    assert POLYNOMIAL.of(data, offsets).tolist() == expected
    whole = POLYNOMIAL.of(data, np.array([0, len(data)]))[0]
    left = 0
    for value, length in zip(expected[::-1], lengths[::-1]):
        left = POLYNOMIAL.combined(value, length, left)
    assert left == whole


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[plain(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, left = min(known) if known else None, 1
        for i in ids:
            out.append((i, keep, len(ids), i == keep and left > 0, hashlib.sha256(text.encode()).hexdigest()))
            left -= i == keep
    return sorted(out, key=str)


CASES = [(3, "a  b"), (1, "a b"), (2, " a b"), (4, None), (5, ""), (9, "x" * 200_000 + "y"), (8, "x" * 200_000 + "z"), (7, "x" * 200_000 + "y")]
CASES += [(None, "n"), (6, "n"), (None, "m"), (None, "m"), (11, "r"), (11, "r"), (12, "\t\n"), (13, " ")] + [(100 + i, f"t{i % 9}") for i in range(60)]


@pytest.mark.parametrize("primes", [exact.PRIMES, (7,)])  # with a tiny prime nearly all groups collide
def test_groups_equal_brute_force(spark, primes):
    docs = spark.createDataFrame([(i, t, "x") for i, t in CASES], "doc_id long, text string, fingerprint string").repartition(3)
    found = exact.decisions(docs, primes=primes).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, found.collect()), key=str) == brute(CASES)
    assert exact.decisions(docs.limit(0), primes=primes).collect() == []


def test_deduplicated_keeps_all_columns(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in CASES], "doc_id long, text string, lang string")
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, plain(r.text)) for r in kept.collect() if r.doc_id) == sorted((i, plain(t)) for i, t in {(b[0], b[4]): (b[0], next(t for j, t in CASES if j == b[0])) for b in brute(CASES) if b[3] and b[0]}.values())
