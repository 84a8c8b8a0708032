import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinloom.llm import classifier as C
from twinloom.llm.words import text_bytes

EVERY = "true"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab \n", max_size=12), max_size=6))
def test_features_are_those_of_each_text_alone(texts):
    slot, value, bounds = C.features(*text_bytes(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        words = (text or "").split()
        a, b = bounds[i], bounds[i + 1]
        grams = set(words) | {"=" if p == q else f"{p} {q}" for p, q in zip(words, words[1:])}
        assert slot[a] == 0 and value[a] == 1 and b - a == len(grams) + 1
        assert not words or abs((value[a + 1 : b] ** 2).sum() - 1) < 1e-9
        alone, amounts, _ = C.features(*text_bytes(pa.array([text], pa.string())))
        assert alone.tolist() == slot[a:b].tolist() and np.allclose(amounts, value[a:b])


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    model, z, n = C.FollowTheLeader(slots=6), [0.0] * 6, [0.0] * 6
    for _ in range(200):
        slot = rng.choice(6, 3, replace=False)
        value, label = rng.normal(size=3), int(rng.integers(2))
        w = [0.0 if abs(z[i]) <= model.l1 else -(z[i] - np.sign(z[i]) * model.l1) / ((model.beta + n[i] ** 0.5) / model.alpha + model.l2) for i in slot]
        p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, value))))
        for i, x, a in zip(slot, value, w):
            g = (p - label) * x
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / model.alpha
            z[i], n[i] = z[i] + g - sigma * a, n[i] + g * g
        model.learn(slot, value, label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    weights = C.learned(docs, labels, ~held)
    rows = C.score(docs, weights).where(held).join(labels, "doc_id").select("score", "quality").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.98
    assert not any(r.score < 0.5 for r in rows if r.quality == 1)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (2, None, 5), (None, "", 5), (3, "c c c", 5), (3, "c c c", 5)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (3, 1), (2, None), (None, 1), (9, 1)], "doc_id long, quality int")
    scored = C.score(docs, C.learned(docs, labels, EVERY))
    assert scored.columns == [*docs.columns, "score"]
    scores = {(r.doc_id, r.text): r.score for r in scored.collect()}
    assert len(scored.collect()) == 5 and all(0 <= s <= 1 for s in scores.values())
    assert scores[1, "a b"] > scores[3, "c c c"]
    assert scores[2, None] == scores[None, ""]
    none = C.learned(docs, labels.limit(0), EVERY)
    assert {r.score for r in C.score(docs, none).collect()} == {0.5}
    assert C.score(docs.limit(0), none).collect() == []


def test_learning_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    assert np.array_equal(C.learned(docs, labels, EVERY), C.learned(docs.repartition(5), labels.repartition(3), EVERY))
