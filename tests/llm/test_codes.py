import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinloom.llm import codes as C


def brute(codes, ids, queries, k):
    out = []
    for i, q in enumerate(queries):
        distance = np.bitwise_count(codes.astype(np.uint64) ^ np.uint64(q)).astype(int)
        order = np.lexsort((ids, distance))[:k]
        out += [(i, int(ids[o]), int(distance[o])) for o in order]
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 30), st.integers(0, 64), st.integers(0, 2**32))
def test_search_equals_brute_force(n, k, noise, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, 3, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (n, noise + 1)).astype(np.uint64), axis=1)
    codes, ids = centres[rng.integers(0, 3, n)] ^ flips, rng.permutation(n)
    queries = np.concatenate((codes[:4], centres, rng.integers(0, 2**64, 2, dtype=np.uint64)))
    found = C.MultiIndex(codes.astype(np.int64), ids).search(queries, k)
    assert list(zip(*(f.tolist() for f in found))) == brute(codes, ids, queries, k)


@pytest.mark.parametrize("block", [7, 10_000])
def test_rows_equal_brute_force(spark, block):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.choice([-1, 1], 12)]) for i in range(150)]
    rows += [(i, [1.0] * 12) for i in range(200, 300)] + [(0, rows[0][1]), (500, None), (None, [1.0]), (550, []), (600, [float("nan"), None, 1.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, code string").repartition(3)
    found = C.nearest(frame, F.col("vec_id") % 50 == 0, k=5, block=block).collect()
    known = {i: sum(1 << b for b, x in enumerate(v) if x is not None and x > 0) for i, v in rows if i is not None and v is not None}
    expected = set()
    for q in (i for i in known if i % 50 == 0):
        near = sorted(((known[q] ^ c).bit_count(), i) for i, c in known.items() if i != q)[:5]
        expected |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert C.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []
