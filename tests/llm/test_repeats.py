import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.test_words import thue_morse
from twinloom.llm import repeats as R


def brute(rows, size):
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - size + 1):
            if seen[tuple(words[i : i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, size, vocabulary):
    rng = random.Random(seed)
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [text(size + rng.randrange(20)) for _ in range(4)]
    rows = []
    for i in range(60):
        words = text(rng.randrange(40))
        for _ in range(rng.randrange(3)):
            words += rng.choice(passages)[rng.randrange(3) :] + text(rng.randrange(6))
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(100, None), (101, ""), (None, " ".join(passages[0])), (102, "a " * 200), (103, "a b " * 60), (104, "x y z " * 11 + "x y"), (105, "x y z " * 12 + "x y")]
    return rows + [(7, rows[7][1]), (7, rows[7][1])]


@pytest.mark.parametrize("seed, size, vocabulary", [(1, 35, 500), (2, 35, 2), (3, 12, 5), (4, 3, 3), (5, 1, 40)])
def test_removal_equals_brute_force(spark, seed, size, vocabulary):
    rows = corpus(seed, size, [f"w{i}" for i in range(vocabulary)])
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int").repartition(5)
    found = R.without_repeats(docs, size).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, size)


def test_sample_table_and_kept_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = R.without_repeats(docs)
    assert sorted(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str) == brute(rows, 35)
    assert found.where("n_removed > 0").where(F.sha2("kept_text", 256) != F.col("kept_sha256")).count() == 0
    assert found.where("n_removed > 0").count() > 20


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.without_repeats(docs).collect() == []


def test_words_that_agree_under_every_polynomial(spark):
    common = " ".join(f"w{i}" for i in range(34))
    texts = [f"{common} {thue_morse(1024)}", f"{common} {thue_morse(1024, 'ba')}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in R.without_repeats(docs).collect()] == [0, 0]
