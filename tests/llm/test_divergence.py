import random
import re
from collections import Counter, defaultdict

import pytest

from twinloom.llm import divergence
from twinloom.llm.divergence import audit, vocabulary

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def expected(rows, min_docs, shown):
    rows = [(lang or "", source or "", TERM.findall((text or "").translate(LOW))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        held, own, whole = Counter(), defaultdict(Counter), Counter()
        for _, source, terms in (r for r in rows if r[0] == lang):
            held.update(set(terms))
            own[source].update(terms)
        kept = sorted(t for t in held if held[t] >= min_docs)
        for counts in own.values():
            whole.update({t: counts[t] for t in kept})

        def p(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        q = p(whole)
        shares = {source: p(counts) for source, counts in own.items()}
        for source, mine in shares.items():
            pairs = [(sum(abs(mine[t] - other[t]) for t in kept), name) for name, other in shares.items() if name != source]
            terms = [(mine[t] - q[t], t) for t in kept if own[source][t] and mine[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, shown)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def found(spark, rows, min_docs=3, shown=4):
    return sorted(map(tuple, audit(frame(spark, rows), min_docs, shown).collect()))


def random_rows(seed, n, sources=5):
    rng = random.Random(seed)
    words = ["Red", "red,", "red", "blue", "Blue.", "x-y", "y", "7up", "été", "ÉTÉ", "don't", "t", "--", "12"]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    return [
        (rng.choice(["en", "fr", None]), rng.choice([f"s{i}" for i in range(sources)] + [None]), " \t\n".join(rng.choices(words, k=rng.randrange(12))))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed, min_docs", [(1, 3), (2, 6)])
def test_audit_equals_brute_force(spark, seed, min_docs):
    rows = random_rows(seed, 150)
    assert found(spark, rows, min_docs) == expected(rows, min_docs, 4)


def test_several_blocks_buckets_and_blocks_of_sources(spark, monkeypatch):
    rows = random_rows(9, 260, sources=30)
    monkeypatch.setattr(divergence, "BUCKET", 15)
    monkeypatch.setattr(divergence, "SOURCES", 8)
    monkeypatch.setattr(divergence, "BLOCK", 400)
    monkeypatch.setattr(divergence, "BROADCAST_TERMS", 0)
    assert found(spark, rows, 8) == expected(rows, 8, 4)


def test_documents_of_one_term_in_several_chunks_count_once(spark):
    rows = [("en", "a", "red red, RED (red)")] * 2 + [("en", "b", "red,")] + [("en", "b", "blue")] * 3
    kept = {r.term: r.n for r in vocabulary(frame(spark, rows), 3).by_lang.collect()}
    assert kept == {"red": 9, "blue": 3}
    assert {r.term for r in vocabulary(frame(spark, rows), 4).by_lang.collect()} == set()


def test_a_frequent_chunk_that_is_no_bare_term(spark):
    rows = [("en", "a", "(zeal)")] * 9
    assert {r.term for r in vocabulary(frame(spark, rows), 9).by_lang.collect()} == {"zeal"}
    assert vocabulary(frame(spark, rows), 10).by_lang.collect() == []


def test_edge_rows(spark):
    rows = [("en", "a", None), ("en", "a", ""), ("en", "b", "12 --"), (None, None, "solo"), ("de", "x", "wort " * 60_000), ("de", "y", "ort")]
    assert found(spark, rows, 1) == expected(rows, 1, 4)
    assert found(spark, rows, 5) == expected(rows, 5, 4)
    assert found(spark, [], 1) == []


def test_clashing_names(spark):
    rows = random_rows(5, 40)
    extra = ["group", "term", "chunk", "n", "d", "block", "docs", "value", "rank", "part", "item", "v", "total"]
    docs = frame(spark, rows).selectExpr("*", *(f"1 AS `{name}`" for name in extra))
    assert sorted(map(tuple, audit(docs, 3, 4).collect())) == expected(rows, 3, 4)
