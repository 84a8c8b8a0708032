import hashlib
import random
import re

import pytest

from twinloom.llm import pii as P

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": kind == "ip" and all(int(p[-5:]) <= 255 and len(p.lstrip("0")) <= 3 for p in text.split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, form in FORMS.items() for m in re.finditer(form, text or "") if passes(k, m[0])]


def check(rows, docs):
    spans = {(i, hashlib.sha256(",".join(base(t)).encode()).hexdigest(), *(sum(s.startswith(k) for s in base(t)) for k in FORMS)) for i, t in rows}
    found = P.personal_data(docs).collect()
    assert {(r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found} == spans
    assert len(found) == len(rows)
    for r in found:
        own = [s for s in r.spans.split(",") if s]
        assert len(own) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
    return found


def test_base_spans_of_generated_texts(spark):
    rng = random.Random(4)
    parts = ["a.b@c.de", "x@y", "a@b.c_d@e.f.g", "é.ü@ñ.com", "1.2.3.4", "256.1.1.1", "0001.002.3.255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500000000000004", "+1 (988) 555-2485", "+12", "+1 .()-", "日本", " ", "\n", ".", "-", "+", "@", "9", "12345678901234567", "a"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(14)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "a@b.cd"), (1002, "9" * 20_000 + " " + "a" * 20_000), (1003, "a" * 20_000 + "@b" + ".c" * 5_000), (1004, "1 " * 9_000), (1005, "+" + "1(" * 5_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kind string").repartition(3)
    check(rows, docs)
    check([(1, "a@b.cd"), (1, "a@b.cd")], spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd")], "doc_id long, text string"))
    assert P.personal_data(docs.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_sample_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    found = check([(r.doc_id, r.text) for r in docs.collect()], docs)
    assert sum(r.n_email + r.n_ip + r.n_phone + r.n_card for r in found) > 10
    assert sum(r.n_added for r in found) == 0  # nothing there has a telling context


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please dial phone: +1 (212) 555-{1000 + i} at any time") for i in range(20)]
    rows += [(100, "please dial phone: (212) 555-7777 at any time"), (101, "in 1999 the phone: rang 12 times, version 3.0"), (102, "chapter (212) 555-8888 ends")]
    rows += [(200 + i, f"the server {i}.0.{i}.1 has version {i}.2") for i in range(20)]
    rows += [(300, "the server 10_0_0_1 has version 7.2 (212) 555-8888")]
    found = {r.doc_id: r for r in check(rows, spark.createDataFrame(rows, "doc_id long, text string"))}
    assert found[100].spans == "phone:19:33" and found[100].n_added == 1
    assert found[300].spans == "ip:11:19"
    assert sum(r.n_added for r in found.values()) == 2


@pytest.mark.parametrize("seen, unseen", [(80, 20), (50, 50), (20, 3)])
def test_unseen_identifiers_do_not_speak_against_their_pattern(spark, seen, unseen):
    rows = [(i, f"please dial phone: +1 (212) 555-{1000 + i} at any time") for i in range(seen)]
    rows += [(1000 + i, f"please dial phone: (212) 555-{7000 + i} at any time") for i in range(unseen)]
    found = {r.doc_id: r for r in check(rows, spark.createDataFrame(rows, "doc_id long, text string"))}
    assert all(found[1000 + i].spans == "phone:19:33" for i in range(unseen))
    assert sum(r.n_added for r in found.values()) == unseen


@pytest.mark.parametrize("other", ["version 7.{}", "+49 911 {} 1 2 3 4 5 6 7 8 9 0", "x{}@mail.org"])
def test_instances_that_contradict_the_kind_do(spark, other):
    rows = [(i, f"please dial number: +1 (212) 555-{1000 + i} at any time") for i in range(20)]
    rows += [(500 + i, f"please dial number: {other.format(100 + i)} at any time") for i in range(20)]
    if other.startswith("version"):
        rows = [(i, t.replace("version ", "")) for i, t in rows]
    rows += [(1000, "please dial number: (212) 555-7777 at any time")]
    found = {r.doc_id: r for r in check(rows, spark.createDataFrame(rows, "doc_id long, text string"))}
    assert found[1000].n_added == 0


def dial(n, text="please dial phone: +1 (212) 555-{} at any time"):
    return [(i, text.format(1000 + i)) for i in range(n)]


def spans_of(spark, rows, **options):
    found = P.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    return {r.doc_id: r.spans for r in found}


def test_an_instance_ends_where_its_form_does(spark):
    rows = [*dial(20), (100, "please dial phone: (212) 555-7777 2 times"), (101, "please dial phone: 3 (212) 555-7778 at any time")]
    found = spans_of(spark, rows)
    assert found[100] == "phone:19:33"
    assert found[101] == "phone:19:35"  # no pattern begins behind the 3, and all of it looks like a number


def test_an_instance_may_begin_within_a_run(spark):
    rows = [*dial(20, "please dial phone 2: +1 (212) 555-{} at any time"), (100, "please dial phone 2: (212) 555-7777 at any time")]
    assert spans_of(spark, rows)[100] == "phone:21:35"


def test_words_beside_a_base_span_are_instances(spark):
    rows = [(i, f"write to a{i}@b.com or x") for i in range(20)]
    rows += [(100, "write to user@localhost 10.0.0.1 or x"), (101, "write to user@localhost a9@b.com or x")]
    found = spans_of(spark, rows)
    assert found[100] == "email:9:23,ip:24:32"
    assert found[101] == "email:9:23,email:24:32"


def test_rounds_go_on_until_nothing_new(spark):
    rows = [(i, f"c0 +1 (212) 555-{1000 + i}") for i in range(10)]
    for level in range(5):
        for i in range(8):
            number = f"(212) 555-{2000 + 100 * level + i}"
            rows += [(1000 + 100 * level + i, f"c{level} {number}".replace("c0", "zero")), (5000 + 100 * level + i, f"c{level + 1} {number}".replace("c0", "zero"))]
    rows = [(i, text.replace("zero", "first").replace("c0 ", "first ").replace("c1", "second").replace("c2", "third").replace("c3", "fourth").replace("c4", "fifth").replace("c5", "sixth")) for i, text in rows]
    found = spans_of(spark, rows)
    assert all(found[i] for i, _ in rows)
    assert sum(bool(found[i]) for i, _ in rows if i >= 1000) > sum(bool(s) for i, s in spans_of(spark, rows, rounds=3).items() if i >= 1000)
    assert not any(s for i, s in spans_of(spark, rows, rounds=0).items() if i >= 1000)


def test_words_of_a_context_are_whole(spark):
    long = "x" * 200
    rows = [(i, f"{long}{i % 2} {long}: +1 (212) 555-{1000 + i} {long}") for i in range(20)]
    rows += [(100, f"{long}0 {long}: (212) 555-7777 {long}"), (101, f"{'x' * 199}0 {'x' * 199}: (212) 555-7778 {'x' * 199}")]
    found = spans_of(spark, rows)
    assert found[100] == "phone:404:418" and found[101] == ""
