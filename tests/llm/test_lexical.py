import math
import random
import re
from collections import Counter

import pytest

from twinloom.llm import lexical
from twinloom.llm.lexical import build, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def terms_of(text):
    return TERM.findall((text or "").translate(LOW))


def expected(docs, items, k):
    counts = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    lengths = [sum(c.values()) for _, c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, c), length in zip(counts, lengths, strict=True):
            score = 0
            for t in terms_of(text):
                if c[t]:
                    m = 25 + 75 * length * n // total
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += weight * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def found(spark, docs, items, k=10):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search(build(docs), items, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def random_texts(seed, n, most):
    rng = random.Random(seed)
    words = ["Red", "red", "éa", "É", "a1", "1"] + [f"w{int(rng.paretovariate(0.7))}" for _ in range(60)]
    return [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.randrange(most)))) for i in range(n)]


@pytest.mark.parametrize("seed, k", [(1, 10), (3, 3), (4, 500)])
def test_search_equals_brute_force(spark, seed, k):
    docs, items = random_texts(seed, 250, 40), random_texts(seed + 50, 12, 9)
    assert found(spark, docs, items, k) == expected(docs, items, k)


def test_many_shards_blocks_and_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD", 2_000)
    monkeypatch.setattr(lexical, "ITEM_BLOCK", 5)
    monkeypatch.setattr(lexical, "BROADCAST_ENTRIES", 0)
    docs, items = random_texts(7, 300, 60), random_texts(8, 23, 9)
    assert found(spark, docs, items, 4) == expected(docs, items, 4)


def test_ties_go_to_the_smallest_id_over_strata_and_shards(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD", 100)
    docs = [(i, "one two three") for i in range(60, 0, -1)] + [(None, "one two three")] * 2 + [(5, "one two three")]
    items = [(1, "two two one"), (1, "two")]
    assert found(spark, docs, items, 7) == expected(docs, items, 7)
    assert [r[2] for r in found(spark, docs, [(9, "three")], 3)] == [1, 2, 3]


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "-- ??"), (4, "word " * 200_000), (5, "word other"), (6, "word")]
    items = [(1, None), (2, ""), (3, "word WORD"), (None, "other"), (5, "unknown")]
    assert found(spark, docs, items) == expected(docs, items, 10)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x"), (2, "a", 8, "y")], "doc_id long, text string, item long, term string")
    items = spark.createDataFrame([(1, "a b", 0, 0)], "item_id long, text string, score long, _row long")
    assert [tuple(r)[:3] for r in search(build(docs), items).collect()] == [(1, 1, 1), (1, 2, 2)]


def test_visits_stop_early():
    """Strata whose bound is below the k-th best score are not visited."""
    import pyarrow as pa

    rows = pa.table(
        {
            "weight": [10],
            "items": [[0]],
            "counts": [[1]],
            "m": [list(range(30, 60))],
            "tf": [[1] * 30],
            "size": [[1] * 30],
            "place": pa.array([list(range(30))], pa.list_(pa.int32())),
        }
    )
    place, scores = lexical._Matches(rows).best(0, 30, 2)
    assert place.tolist() == [0, 1] and scores[0] > scores[1]
