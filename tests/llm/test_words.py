"""Words and hashes on byte buffers, without Spark."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import tokens as T
from tests.llm import plain

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abAB 1é日\n\t.,-_\x0b", max_size=30)), max_size=8)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_are_the_regex_words(texts):
    for table, words in ((T.word_table(T.ALNUM_SEPARATORS), plain.alnum_words), (T.word_table(T.SPACE_SEPARATORS), plain.space_words)):
        w = T.Words(pa.array(texts, pa.string()), table)
        got = [w.words(a, a + n).split(" ") if n else [] for a, n in zip(w.first, w.count)]
        assert got == [words(t) for t in texts]
        names = {}
        for h, x in zip(w.hash, (x for t in texts for x in words(t))):
            assert names.setdefault(x, h) == h
        assert len(set(names.values())) == len(names)


@given(TEXTS)
@settings(max_examples=60, deadline=None)
def test_grams_stay_inside_rows(texts):
    w = T.Words(pa.array(texts, pa.string()), T.word_table(T.SPACE_SEPARATORS))
    for n in (1, 2, 3):
        at, h = w.grams(n)
        want = [tuple(x[k:k + n]) for x in map(plain.space_words, texts) for k in range(len(x) - n + 1)]
        assert len(at) == len(want)
        names = {}
        assert all(names.setdefault(g, v) == v for g, v in zip(want, h)) and len(set(names.values())) == len(names)


def test_chunks_hold_all_rows_and_long_texts():
    batch = pa.record_batch({"id": pa.array(range(6)), "text": pa.array(["a" * 50, None, "b" * 500, "", "c", "d" * 90])})
    parts = list(T.chunks([batch, batch.slice(0, 0)], limit=100))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(6))
    assert max(len(T.column_bytes(p.column(1))[0]) for p in parts if p.num_rows > 1) <= 100


def test_sliced_columns():
    col = pa.array(["aa bb", "cc", None, "dd ee ff"]).slice(1)
    w = T.Words(col, T.word_table(T.SPACE_SEPARATORS))
    assert w.count.tolist() == [1, 0, 3] and np.all(w.doc == [0, 2, 2, 2])
