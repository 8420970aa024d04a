"""Mixtures, blocks and permutations."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing as M
from tests.conftest import SF_SMALL
from tests.llm import plain


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 4097])
def test_permutation(n):
    full, key = np.full(n, n), np.full(n, 987654321)
    p = M.permuted(np.arange(n), full, key)
    assert sorted(p) == list(range(n)) and (M.permuted(p, full, key, back=True) == np.arange(n)).all()
    if n > 100:
        assert not (p == M.permuted(np.arange(n), full, key + 1)).all()


def check(rows, docs):
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(plain.space_words(text))
    want, taken = plain.targets(sizes), defaultdict(int)
    key = lambda r: (str(r[0]), r[1])
    by_row = sorted(((i, len(plain.space_words(t)), s) for i, t, s in docs), key=key)
    assert sorted(((r.id, r.size) for r in rows), key=key) == [(i, n) for i, n, _ in by_row]
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
    for r in rows:
        assert any(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and r.source_size == sizes[s] for s in sizes)
    totals = Counter()
    for r in rows:
        totals[(r.source_size, round(r.target, 3))] += r.taken
    full = Counter()
    for s in sizes:
        full[(sizes[s], round(want[s], 3))] += int(want[s] + 1e-9)
    assert all(abs(totals[k] - v) <= len(sizes) for k, v in full.items())


DOCS = [(i, "tok " * (i * 37 % 90 + 1), ["a", "b", "é", None, "z", "hot", "hot", "hot"][i % 8]) for i in range(400)] + \
    [(1000, "long " * 30_000, "b"), (1001, None, "a"), (1002, "", "only blank"), (1003, " \n", "only blank"), (None, "x y", "a"), (1000, "long " * 30_000, "b")]


def test_targets_and_reruns(spark):
    df = spark.createDataFrame([(*r, 1) for r in DOCS], "doc_id long, text string, source string, size int")
    rows = M.mix_report(df, block=16).collect()
    check(rows, DOCS)
    again = M.mix_report(df.repartition(7), block=16).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_holds_the_words_taken(spark):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in DOCS], "doc_id long, text string, source string, n_chars long")
    out = M.mix(df, block=16)
    assert out.columns == df.columns
    got = Counter()
    for r in out.collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id] += len(plain.space_words(r.text))
    want = Counter()
    for r in M.mix_report(df, block=16).collect():
        want[r.id] += r.taken
    assert got == +want


def test_mix_keeps_the_columns_of_each_row(spark):
    """Equal id and text under other sources and columns, some only told apart by where a null stands."""
    text = "w " * 40
    rows = [(i, text, s, lang, None if k else "x", "x" if k else None, [None, "y"] if k else ["y", None], {"a": k}, 80)
            for i in (None, 7) for s in ("a", "b", None) for lang in ("en", "de") for k in (0, 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, p string, q string, r array<string>, m map<string,int>, n_chars long")
    got = M.mix(df, block=16, share=2.0, weights=(1,)).collect()                # two whole passes over every row
    key = lambda r: str((r[0], r[2], r[3], r[4], r[5], r[6], r[7]))
    words, want = Counter(), Counter()
    for r in got:
        words[key(r)] += len(r.text.split())
    for r in rows:
        want[key(r)] += 80
    assert words == want


def test_mix_is_the_same_again_for_rows_with_equal_ids(spark):
    rows = [(None, "tok " * 30, "a", f"l{k}", 120) for k in range(40)] + [(1, "tok " * 30, "b", f"l{k}", 120) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    once, again = (sorted(map(str, M.mix(x, block=16, share=0.7).collect())) for x in (df, df.orderBy(F.rand(3)).repartition(5)))
    assert once == again


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")
    assert M.mix_report(df).count() == 0 and M.mix(df).count() == 0


def test_multinomial_counts_over_shards(spark):
    df = spark.createDataFrame([(i, "w " * 200, "s") for i in range(300)], "doc_id long, text string, source string")
    _, pieces = M.draw_mix(df, block=8, shards=4)
    n = [r["count"] for r in pieces.select("shard", "slot").distinct().groupBy("shard").count().collect()]
    assert len(n) == 4 and max(n) - min(n) < 6 * (sum(n) / 4) ** 0.5 and len(set(n)) > 1


def test_query(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = M.op9_mixing(spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()
    check(rows, docs)
