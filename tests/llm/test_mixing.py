import math
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinloom.llm import mixing as M

COUNTS = st.lists(st.integers(1, 10_000), min_size=2, max_size=8)


@settings(max_examples=200, deadline=None)
@given(COUNTS, st.floats(0, 1), st.floats(1, 6))
def test_solution_meets_entropy_or_the_limit(words, target, limit):
    exponent, weights, spent = M.solve(words, target, limit, None)
    assert abs(sum(weights) - 1) < 1e-9 and 0 <= exponent <= 1
    repeated = [w * spent / n for n, w in zip(words, weights)]
    assert min(repeated) > 1 - 1e-9 and max(repeated) <= limit * (1 + 1e-9)
    if M.entropy(weights) < target * math.log(len(words)) - 1e-6:  # then the limit binds
        assert max(repeated) > limit * (1 - 1e-6)
    elif exponent < 1:  # and no larger exponent reaches the entropy
        looser = M.tempered([n / sum(words) for n in words], min(1, exponent + 1e-3))
        assert M.entropy(looser) <= target * math.log(len(words)) + 1e-6 or max(repeated) > limit * (1 - 1e-6)


def brute(spark, docs, rows, given):
    """The choice of each source's partial pass, by sorting all its documents."""
    taken = Counter()
    for g in given:
        own = [r for r in rows if r[2] == g["source"]]
        keys = docs.sparkSession.createDataFrame(own, docs.schema).selectExpr(
            "doc_id", "text", f"pmod(xxhash64('block', 42, {g['passes']}L, doc_id, xxhash64(text)), {g['blocks']}L) b", f"xxhash64('place', 42, {g['passes']}L, doc_id, xxhash64(text)) p"
        ).collect() if own else []
        before = 0
        for r in sorted(keys, key=lambda r: (r.b, r.p, r.doc_id)):
            taken[r.doc_id] += g["passes"] + (before < g["left"])
            before += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    return taken


@pytest.mark.parametrize("budget", [None, 400, 5])
def test_mix_equals_brute_force(spark, budget, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 5)
    rows = [(i, "w " * (i % 13 + 1), "big" if i % 3 else ("mid" if i % 2 else None), i) for i in range(120)]
    rows += [(500, None, "void", 1), (501, "", "void", 1), (502, " \t", "void", 1), (600, "a\x0bb c", "mid", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight int").repartition(3)
    narrow = docs.select("source", M.word_count(docs["text"]).alias("n_words"))
    given = M.plan(narrow, 0.95, 2.0, budget)
    found = M.mixed_corpus(docs, budget=budget)
    assert found.columns == docs.columns
    counts = brute(spark, docs, rows, given)
    assert Counter(r.doc_id for r in found.collect()) == +counts
    if budget is None:
        assert set(counts) == {r[0] for r in rows} and min(counts.values()) == 1
    words = defaultdict(int)
    for r in found.collect():
        words[r.source] += len((r.text or "").split())
    for g in given:
        if g["weight"]:
            total = sum(len((r[1] or "").split()) for r in rows if r[2] == g["source"])
            assert 0 <= words[g["source"]] - (g["passes"] * total + g["left"]) <= 13


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "x"), (1, "a b", "s", "x"), (None, "c", "t", "x")], "doc_id long, text string, source string, pass string")
    assert Counter((r.doc_id, r["pass"]) for r in M.mixed_corpus(docs, target_entropy=0.0).collect()) == {(1, "x"): 2, (None, "x"): 1}
    assert M.mixed_corpus(docs.limit(0)).collect() == []
