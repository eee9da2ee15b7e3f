"""Words, windows and slices against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.blocks import free_name, slices, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c  ", max_size=30)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_hashes(texts):
    w = words(pa.array(texts, pa.string()))
    expected = [WORD.findall(t or "") for t in texts]
    raw = w.data.tobytes()
    got = [[raw[w.start[i]:w.end[i]].decode() for i in range(w.first[d], w.first[d + 1])] for d in range(len(texts))]
    assert got == expected
    flat, h = [x for e in expected for x in e], w.hashes()
    assert len({(a, int(b)) for a, b in zip(flat, h)}) == len(set(flat)) == len(set(h.tolist()))


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows(texts, k):
    w = words(pa.array(texts, pa.string()))
    flat = [x for t in texts for x in WORD.findall(t or "")]
    at, h = w.windows(w.hashes(), k)
    expected = [i for d in range(len(texts)) for i in range(w.first[d], w.first[d + 1] - k + 1)]
    assert at.tolist() == expected
    runs = [tuple(flat[i:i + k]) for i in at]
    assert len(set(zip(runs, h.tolist()))) == len(set(runs)) == len(set(h.tolist()))


def test_slices_cover_all_rows_and_stay_small():
    batch = pa.record_batch({"id": pa.array(range(50)), "text": pa.array(["x" * (i % 7 * 10) for i in range(50)])})
    parts = list(slices(iter([batch, batch.slice(0, 0)]), limit=100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(50))
    assert all(sum(map(len, p.column(1).to_pylist())) <= 100 or p.num_rows == 1 for p in parts)


def test_long_word_and_large_string():
    long = "z" * 200_000
    w = words(pa.array([long, long + "z", None, ""], pa.large_string()))
    assert w.n.tolist() == [1, 1, 0, 0]
    assert len(np.unique(w.hashes())) == 2


def test_free_name():
    assert free_name(["A", "_a"], "a") == "__a"
