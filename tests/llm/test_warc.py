import base64
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twinloom.llm import warc as W


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)).map(sorted), max_size=9))
def test_loser_tree_merges_stably(runs):
    order = list(W.LoserTree(runs))
    assert order == sorted(((r, i) for r, run in enumerate(runs) for i in range(len(run))), key=lambda x: (runs[x[0]][x[1]], x))


@pytest.mark.parametrize(
    "url, key",
    [
        ("https://www.Example.com:8080/A/b?x=1#top", "com,example,)/a/b?x=1"),
        ("http://user@m.example.org", "org,example,m,)/"),
        ("example.net/x", "net,example,)/x"),
        (None, ""),
    ],
)
def test_url_keys(url, key):
    assert W.url_key(url) == key


PAGES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, "http://a.example/2", "<p>one</p>"),
    (3, "http://b.example/3", None),
    (4, None, ""),
    (5, "http://b.example/\r\nX-Page: 9", "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\nÄ€"),
    (6, "http://a.example/2", "x" * 300_000),
    (None, "http://c.example", "<p>one</p>"),
    (None, "http://c.example", "alone"),
    (7, "http://d.example", "same"),
    (7, "http://d.example", "same"),
    (8, "http://d.example", "\r\n\r\n"),
]


def expected(pages):
    out = []
    for page, url, html in pages:
        body = html or ""
        known = [p for p, _, h in pages if (h or "") == body and p is not None]
        first = max(known, default=None)
        response = first is None or page == first
        digest = base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        out.append((page, len(body.encode()), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("records", [2, 1000])
def test_round_trip(spark, records):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(2)
    rows = W.archived(pages, records).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(PAGES)
    keys = [tuple(r[k] for k in W.KEY) for r in rows]
    assert keys == sorted(keys)
    assert W.archived(pages.limit(0)).collect() == []


def test_index_is_globally_ordered(spark):
    runs = W.sorted_runs(spark, W.write_archives(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(6), 20))
    index = W.capture_index(runs)
    keys = [tuple(r[k] for k in W.KEY) for r in index.collect()]
    assert len(keys) == 250 and keys == sorted(keys) and len({k[2] for k in keys}) > 6


def test_damage_is_found():
    record = b"WARC/1.1\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert [b for _, _, b in W.parse(record * 2)] == [b"abcd"] * 2
    with pytest.raises(ValueError):
        list(W.parse(record[:-6] + record))
