import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinloom.llm import pitman_yor as P

def HELD():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def counted(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [
        (i, h, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for (i, t), h in zip(rows, held)
    ]


@pytest.fixture(scope="module")
def sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return [(r.doc_id, r.text) for r in docs.collect()], P.score(docs, HELD()).collect()


def test_counts_and_base_equal_brute_force(sample):
    rows, found = sample
    found = {r.doc_id: r for r in found}
    for doc_id, *exact, base in counted(rows):
        assert [found[doc_id][c] for c in ("held_out", "n_tokens", "n_known", "train_tokens")] == exact
        assert abs(found[doc_id].base_score - base) < 1e-6 * max(1, abs(base))


def test_model_beats_the_base_on_held_out_texts(sample):
    held = [r for r in sample[1] if r.held_out]
    assert len(held) > 80
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("spread", [False, True])
def test_shards_are_a_distribution_and_valid_seatings(spread, monkeypatch):
    rng = np.random.default_rng(1)
    cells = [(w, c, n) for w in range(1, 30) for c in range(5) if (n := int(rng.integers(0, 4) ** 3))]
    word, context, trained = (np.array(x) for x in zip(*cells))
    totals = P.Totals(np.array([3, 7], np.uint64) if spread else np.zeros(0, np.uint64))
    totals.customers[:5] = np.bincount(context, trained, 5)
    totals.words = len(set(word.tolist()))
    new = np.diff(word, prepend=0) != 0
    row = dict(shard=0, word=word[new].astype(np.uint64).tobytes(), cells=np.bincount(word)[word[new]].astype(np.uint32).tobytes(), context=context.astype(np.uint16).tobytes(), trained=trained.astype(np.uint32).tobytes())
    shard = P.Shard(row, totals, 1)

    def exchange(tables):
        totals.tables[:5] = np.bincount(context, tables, 5)
        totals.root = tables.sum()
        totals.frequent_tables = np.array([tables[word == w].sum() for w in (3, 7)])
        totals.frequent_counts = np.array([trained[word == w].sum() for w in (3, 7)])

    exchange(np.ones(len(word)))
    shard.seat()
    moved = 0
    for _ in range(30):
        before = shard.tables.copy()
        exchange(shard.tables)
        shard.sweep()
        moved += (before != shard.tables).sum()
        assert np.array_equal(np.bincount(shard.cell, shard.size, len(shard.many)), trained[shard.many])
        assert np.array_equal(np.bincount(shard.cell, minlength=len(shard.many)), shard.tables[shard.many])
        assert (shard.size > 0).all() and (shard.tables <= trained).all() and (shard.tables >= 1).all()
    assert moved > 20
    exchange(shard.tables)
    root = shard._root()
    unknown = (totals.root_strength + totals.root_discount * totals.words) / (totals.root_strength + totals.root)
    assert abs(root.sum() + unknown - 1) < 1e-9
    for c in range(5):
        weight = totals.strength + totals.discount * totals.tables[c]
        own = np.bincount(shard.of_word[context == c], (trained - totals.discount * shard.tables)[context == c], len(root))
        total = (own + weight * root).sum() + weight * unknown
        assert abs(total / (totals.strength + totals.customers[c]) - 1) < 1e-9
        assert np.allclose(shard.predictions()[context == c], ((own + weight * root) / (totals.strength + totals.customers[c]))[shard.of_word[context == c]])


@pytest.mark.parametrize("spread", [False, True])
def test_predictions_sum_to_one_after_sweeps_without_an_exchange(spread):
    rng = np.random.default_rng(2)
    word, context = (x.ravel() for x in np.meshgrid(np.arange(1, 40), np.arange(4), indexing="ij"))
    trained = rng.integers(1, 60, len(word))
    totals = P.Totals(np.array([5, 9], np.uint64) if spread else np.zeros(0, np.uint64), round=1, words=39)
    totals.customers[:4], totals.tables[:4] = np.bincount(context, trained, 4), np.bincount(context, minlength=4)
    totals.root = len(word)
    totals.frequent_tables = np.array([4.0, 4.0])[: len(totals.frequent)]
    totals.frequent_counts = np.array([trained[word == w].sum() for w in (5, 9)])[: len(totals.frequent)]
    row = dict(shard=0, word=np.arange(1, 40).astype(np.uint64).tobytes(), cells=np.full(39, 4, np.uint32).tobytes(), context=context.astype(np.uint16).tobytes(), trained=trained.astype(np.uint32).tobytes())
    shard = P.Shard(row, totals, 1)
    shard.go_on(np.ones(len(word), np.uint32).tobytes())
    for _ in range(3):
        shard.sweep()
        shard.catch_up()
        t = shard.totals
        assert t.root == shard.tables.sum() > len(word) and totals.root == len(word)
        unknown = (t.root_strength + t.root_discount * t.words) / (t.root_strength + t.root)
        assert abs(shard._root().sum() + unknown - 1) < 1e-9
        found = np.bincount(context, shard.predictions(), 4)
        opening = (t.strength + t.discount * t.tables[:4]) * unknown / (t.strength + t.customers[:4])
        assert np.allclose(found + opening, 1)


@pytest.mark.parametrize("shards, partitions", [(12, 1), (144, 12), (84, 7)])
def test_tokens_are_sent_to_the_partition_of_their_shard(spark, shards, partitions):
    homes = P._homes(spark.range(1), shards, partitions)
    sent = spark.createDataFrame([(s, int(h)) for s, h in enumerate(homes)], "shard int, home int")
    at = {c: dict(sent.repartition(partitions, c).select("shard", F.spark_partition_id()).collect()) for c in ("shard", "home")}
    assert at["shard"] == at["home"] and (homes <= np.arange(shards)).all() and (homes[homes] == homes).all()


def test_shards_are_joined_in_place(spark, monkeypatch):
    """The only exchanges of a sweep are those of the seating and the totals; names of tables do not stay."""
    plans = []
    bucketed = P._bucketed

    def kept(frame, purpose, partitions):
        plans.append((purpose, frame._jdf.queryExecution().executedPlan().toString()))
        return bucketed(frame, purpose, partitions)

    monkeypatch.setattr(P, "_bucketed", kept)
    before = {t.name for t in spark.catalog.listTables()}
    scored = P.score(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), HELD())
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert [p for p, _ in plans] == ["shards", "seating"]
    assert plan.count("Exchange hashpartitioning") == 1  # by step, of the sums
    assert {t.name for t in spark.catalog.listTables()} == before


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "a B"), (5, "a b c a b"), (5, "a b c a b"), (9, "zz " * 40_000), (10, "\t\n")]
    docs = spark.createDataFrame([(*r, True, "x") for r in rows], "doc_id long, text string, held_out boolean, step string").repartition(3)
    held = F.coalesce(HELD(), F.lit(False))
    found = P.score(docs, held).collect()
    key = lambda r: str((r[0], r[2]))
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(counted(rows), key=key)):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5])) and a[6] <= 0
    assert P.score(docs.limit(0), held).collect() == []
    alone = P.score(docs.where("doc_id = 9"), F.lit(True)).collect()
    assert alone[0].n_known == 0 and alone[0].train_tokens == 0


def test_scores_do_not_depend_on_the_order_of_rows(spark, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(6)
    again = {r.doc_id: r.score for r in P.score(docs, HELD()).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-3 * abs(r.score) for r in sample[1])


def exact_stirling(size, discount):
    rows = [np.array([0.0])]  # log S(n, 0..n)
    with np.errstate(divide="ignore"):
        rows[0] = np.log(np.array([1.0]))
        for n in range(size):
            stay = rows[-1] + np.log(np.maximum(n - discount * np.arange(n + 1), 0))
            rows.append(np.logaddexp(np.append(stay, -np.inf), np.append(-np.inf, rows[-1])))
    return rows


@pytest.mark.parametrize("discount", [0.05, 0.5, 0.8, 0.95])
def test_stirling_numbers_equal_the_recursion(discount):
    rows = exact_stirling(2500, discount)
    for n in (5, 64, 900, 1025, 2500):
        t = np.arange(1, n + 1)
        t = t[rows[n][1:] > rows[n][1:].max() - 60]
        error = P.log_stirling(np.full(len(t), n), t, discount) - rows[n][t]
        assert np.abs(np.diff(error)).max(initial=0) < (1e-8 if n <= P.TABULATED else 0.01)


@pytest.mark.parametrize("size, steps", [(12, 1), (400, 3), (2000, 3)])
def test_a_sweep_seats_all_customers_of_a_cell_anew(size, steps):
    """From one table each, some sweeps reach the exact distribution; with one customer a sweep they cannot."""
    cells = 4000
    totals = P.Totals(np.zeros(0, np.uint64), round=1, frequent_tables=np.zeros(0))
    totals.tables[:] = 50
    totals.customers[:] = size
    totals.root, totals.words = 1e6, cells
    word = np.arange(1, cells + 1, dtype=np.uint64)
    row = dict(shard=0, word=word.tobytes(), cells=np.ones(cells, np.uint32).tobytes(), context=np.arange(cells, dtype=np.uint16).tobytes(), trained=np.full(cells, size, np.uint32).tobytes())
    shard = P.Shard(row, totals, 1)
    shard.go_on(np.ones(cells, np.uint32).tobytes())
    for _ in range(steps):
        shard.sweep()
    t = np.arange(1, size + 1)
    # a word met in this cell only: its root table is opened by the first table here
    opening = [math.log(totals.strength + totals.discount * (49 + k)) for k in range(size)]
    root = [0.0, *(math.log(k - totals.root_discount) - math.log(totals.root_strength + 1e6 - 1 + k) for k in range(1, size))]
    weight = exact_stirling(size, totals.discount)[size][1:] + np.cumsum(opening) + np.cumsum(root)
    weight = np.exp(weight - weight.max())
    weight /= weight.sum()
    mean, spread = (weight * t).sum(), math.sqrt((weight * t * t).sum() - (weight * t).sum() ** 2)
    assert abs(shard.tables.mean() - mean) < 5 * spread / math.sqrt(cells) + 0.01 * mean
    assert np.abs(np.bincount(shard.tables, minlength=size + 1)[1:] / cells - weight).max() < 0.05


def test_chains_go_on_between_exchanges(spark, sample, monkeypatch):
    told = []
    gathered = P._gathered

    def kept(shards, totals, seed, seating=None, keys=None):
        before = None if seating is None else {r.shard: r.seating for r in seating.collect()}
        after, keys = gathered(shards, totals, seed, seating, keys)
        told.append((before, {r.shard: r.seating for r in after.collect()}, totals.root))
        return after, keys

    monkeypatch.setattr(P, "_gathered", kept)
    P.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(100), HELD()).count()
    assert len(told) > 3
    for (_, after, _), (before, _, _) in zip(told, told[1:]):
        assert before == after
    assert sum(np.frombuffer(x, np.uint32).sum() for x in told[-1][1].values()) == told[-1][2]


def test_each_previous_word_has_its_own_restaurant(spark, monkeypatch):
    """Beyond 65,536 different words none shares a restaurant, and totals are those of the whole corpus."""
    texts = [" ".join(f"w{i}" for i in range(a, a + 1000)) for a in range(0, 80_000, 1000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:3])], "doc_id long, text string").repartition(4)
    states = []
    gathered = P._gathered

    def kept(shards, totals, seed, seating=None, keys=None):
        after, keys = gathered(shards, totals, seed, seating, keys)
        states.append((shards, after))
        return after, keys

    monkeypatch.setattr(P, "_gathered", kept)
    P.score(docs, F.lit(False)).count()
    shards, after = states[-1]
    customers = {}
    for row in shards.where("about IS NULL").select("shard", "restaurant").join(after, "shard").collect():
        totals = np.concatenate([np.frombuffer(r.customers, np.int64) for r in row.totals])
        for key, n in zip(np.frombuffer(row.restaurant, np.uint64).tolist(), totals.tolist(), strict=True):
            assert customers.setdefault(key, n) == n
    assert len(customers) == 80_001
    counts = Counter(customers.values())
    assert counts == {1: 77_000, 2: 3000, 83: 1}


def test_frequent_words_are_found_by_their_whole_hash(spark, monkeypatch):
    monkeypatch.setattr(P, "WHOLE", 1)
    texts = [" ".join(f"w{i % 7}" if i % 2 else f"r{j}x{i}" for i in range(700)) for j in range(10)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    words, counts, tokens = P._frequent(docs, 40)  # 7 words of 500 or more in 7010 tokens; the others occur once
    found = P.Words(*P.text_bytes(P.pa.array([" ".join(f"w{i}" for i in range(7))])))
    assert sorted(found.hashes().tolist()) == words.tolist() and (counts == 500).all() and tokens == 7010


@pytest.mark.parametrize("shards", [96, 7332])
def test_no_shard_holds_a_frequent_word_alone(shards):
    """Words of up to three hundredths of all tokens, as many shards as a few gigabytes have."""
    rng = np.random.default_rng(3)
    share = 1 / (np.arange(1, 2000) + 33)
    word, context = P.mixed(rng.choice(1999, 400_000, p=share / share.sum()).astype(np.uint64)), P.mixed(rng.integers(0, 1 << 60, 400_000).astype(np.uint64))
    words, counts = np.unique(word, return_counts=True)
    many = counts >= 2 * len(word) / shards
    deal = P.Deal(np.arange(shards, dtype=np.int32), words[many], counts[many], len(word))
    at = deal.shard(word, context)
    assert max(np.bincount(at[word == w]).max() for w in words) < max(3 * len(word) / shards, 60)
    pairs = {(w, s) for w, s in zip(word.tolist(), at.tolist()) if w in set(words[many].tolist())} if shards == 96 else set()
    assert len(pairs) <= 3 * shards


def test_a_common_pair_of_words_is_not_held_token_by_token(spark, monkeypatch):
    """Shards hold few text references; counts and scores are those of the tokens one by one."""
    texts = ["ab " * 4000 + f"c{i} ab D d" for i in range(25)] + ["ab ab c1", None, "d d"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    bucketed, held = P._bucketed, []

    def kept(frame, purpose, partitions):
        table = bucketed(frame, purpose, partitions)
        if purpose == "shards":
            held.extend(n for (n,) in table.where("about IS NULL").selectExpr("octet_length(text) div 2").collect())
        return table

    monkeypatch.setattr(P, "_bucketed", kept)
    monkeypatch.setattr(P, "HEAVY", 1 << 30)
    single = {r.doc_id: r for r in P.score(docs, HELD()).collect()}
    assert sum(held) > 100_000
    held.clear()
    monkeypatch.setattr(P, "HEAVY", 1 << 12)
    found = P.score(docs, HELD()).collect()
    assert 100 < sum(held) < 1000
    rows = counted(list(enumerate(texts)))
    assert len(found) == len(rows)
    for (doc_id, *exact, base), r in zip(rows, sorted(found, key=lambda r: r.doc_id)):
        assert [r[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens")] == exact
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and abs(r.score - single[doc_id].score) < 1e-5 * abs(r.score)
