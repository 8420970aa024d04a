"""Backoff scores against plain counting."""

import numpy as np
import pytest

from tessera.llm import backoff as B
from tests.conftest import SF_SMALL
from tests.llm import plain

TEXTS = [None, "", "...", "a", "a b a b c", "A b; a B", "the the the the", "x y z", "é日 é日 a", "a b " * 20_000, "a b a b c", "a b a b c"]


def check(rows, texts):
    want = plain.backoff(texts)
    assert sorted((r.n_words, r.n_backoff, round(r.logprob, 5)) for r in rows) == sorted((n, b, round(lp, 5)) for n, b, lp in want)
    assert all((r.score is None) == (r.n_words == 0) and (r.score is None or abs(r.score * r.n_words - r.logprob) < 1e-6 * max(1, -r.logprob)) for r in rows)


@pytest.mark.parametrize("block", [40, 8 << 20])
def test_against_plain(spark, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK_BYTES", block)
    monkeypatch.setattr(B, "_PARTITION_WORDS", 1 << 10)
    ids = [*range(len(TEXTS) - 2), None, None]
    df = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, TEXTS)], "doc_id long, text string, block int")
    check(B.score_documents(df).collect(), TEXTS)


def test_trigrams_use_the_longest_context(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b c e"), (3, "q b c d")], "doc_id long, text string")
    rows = {r.id: r for r in B.score_documents(df, order=3).collect()}
    assert rows[1].n_backoff < 4 and rows[1].logprob > B.score_documents(df, order=2).where("id = 1").first().logprob - 10


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_against_plain(spark, monkeypatch, order):
    monkeypatch.setattr(B, "BLOCK_BYTES", 40)
    monkeypatch.setattr(B, "_PARTITION_WORDS", 1 << 10)
    texts = TEXTS + ["a b c d e", "q b c d f", "a b c e d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = B.score_documents(df, order=order).collect()
    want = plain.backoff(texts, order=order)
    assert [(r.n_words, r.n_backoff, round(r.logprob, 5)) for r in sorted(rows)] == [(n, b, round(lp, 5)) for n, b, lp in want]


def test_query_tells_spliced_from_fluent_text(spark, tmp_dir):
    """All word pairs of both last rows occur elsewhere; the runs of three only of the first."""
    texts = ["a b c d", "a b c d", "x b y", "z c w", "a b c d", "x b c w"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    rows = {r.doc_id: r for r in B.op4_backoff_scores(spark, tmp_dir).collect()}
    assert (rows[4].n_backoff, rows[5].n_backoff) == (0, 2)


@pytest.mark.parametrize("x", [[], [0], [7], [0, 255, 256], [1, 1 << 40, (1 << 64) - 1]])
def test_packed_arrays(x):
    x = np.array(x, np.uint64)
    assert B._unsqueezed(B._squeezed(B._packed(x))) == B._packed(x)
    assert (B._unpacked(B._packed(x)) == x).all() and len(B._unpacked(B._packed(x))) == len(x)
    if len(x):
        assert (B._unpacked_hashes(B._packed_hashes(x)) == x).all()


def test_empty_table(spark):
    assert B.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(B.op4_backoff_scores(spark, SF_SMALL).collect(), texts)
