import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from twinloom.llm import words as W

TEXTS = st.lists(st.none() | st.text(alphabet="aB \t\n\x0b\x1c\x85é日.A", max_size=12), max_size=8)


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.booleans())
def test_words_equal_the_pattern(texts, lower):
    data, offsets = W.text_bytes(pa.array(texts, pa.string()))
    seen, by_hash = W.Words(data, offsets, lower), {}
    hashes = seen.hashes()
    for i, text in enumerate(texts):
        expected = [w.translate({c: c + 32 for c in range(65, 91)}) if lower else w for w in plain(text)]
        a, b = seen.bounds[i], seen.bounds[i + 1]
        found = [seen.data[s:e].tobytes().decode() for s, e in zip(seen.starts[a:b], seen.ends[a:b])]
        assert found == expected
        assert W.joined(seen, offsets)[i].decode() == " ".join(expected)
        keep = np.arange(len(seen.starts)) % 3 != 1
        assert W.joined(seen, offsets, keep)[i].decode() == " ".join(w for w, k in zip(expected, keep[a:b]) if k)
        for word, h in zip(found, hashes[a:b].tolist()):
            assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=30), st.integers(1, 4))
def test_windows_stay_within_texts(counts, size):
    bounds = np.concatenate(([0], np.cumsum(counts, dtype=np.int64))).astype(np.int64)
    starts, text = W.windows(bounds, size)
    expected = [(s, t) for t, n in enumerate(counts) for s in range(bounds[t], bounds[t] + n - size + 1)]
    assert list(zip(starts.tolist(), text.tolist())) == expected


def test_steps_cover_all_texts_once():
    offsets = np.array([0, 5, 5, 30, 31, 32])
    assert list(W.steps(offsets, 6)) == [(0, 2), (2, 3), (3, 5)]


def thue_morse(size, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(size))


def test_words_that_agree_under_every_polynomial():
    pair = [thue_morse(1024), thue_morse(1024, "ba")]
    data, offsets = W.text_bytes(pa.array([*pair, pair[0][:512] * 2, "ab", "ba"]))
    assert len(set(W.Words(data, offsets).hashes().tolist())) == 5
