"""Toxicity classifier: learns, holds out, and bears odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa

from tessera.llm import toxicity as X
from tests.conftest import SF_SMALL


def made(n: int = 400, seed: int = 3):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randint(5, 80))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(["zwork", "xylquot", "vumpst"]))
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_cases(spark):
    docs, labels = made()
    odd = [(1000, None), (1001, ""), (1002, "a"), (None, "zwork zwork xylquot"), (1003, "zwork " * 50_000), (5, docs[5][1])]
    df = spark.createDataFrame([(*r, 0.5) for r in docs + odd], "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels + [(None, 1), (7, None), (4, 1), (4, 0)], "doc_id long, toxic int")
    model = X.train(df, lab, keep=(X._third() != 1))
    rows = X.score(df, model).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.id is not None and r.id < 400 and zlib.crc32(str(r.id).encode()) % 3 == 1]
    assert sum((r.score >= 0.7) == (r.id % 4 == 0) for r in held) >= 0.95 * len(held)
    toxic = [r for r in held if r.id % 4 == 0]
    assert sum(r.score >= 0.7 for r in toxic) >= 0.9 * len(toxic)
    by = {r.id: r.score for r in rows}
    assert by[1000] == by[1001] and by[1000] < 0.5 and by[1003] > 0.7 and by[None] > 0.7
    kept = X.without_toxic(df, model, 0.7)
    assert kept.columns == df.columns and kept.count() == sum(r.score < 0.7 for r in rows)


def test_training_needs_both_kinds(spark):
    docs, labels = made(20)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    none = X.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 1e-6 for r in X.score(df, none).collect())
    one = X.train(df, spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id long, toxic int"))
    assert all(r.score > 0.999 for r in X.score(df, one).collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert X.score(empty, one).count() == 0


def test_sample_is_bounded(spark):
    docs, labels = made(400)
    df, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    weights, _ = X.train(df, lab, rows=150)
    assert np.count_nonzero(weights) > 0


def test_every_feature_with_a_ratio_has_a_weight_and_repeated_ids_are_dealt(spark, tmp_path):
    docs, labels = made(300)
    again = [docs[0]] * 5_000                                    # one labelled id, most of the rows
    df = spark.createDataFrame(docs + again, "doc_id long, text string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    weights, _ = X.train(df, lab)
    seen = np.unique(X.grams(pa.array([t for _, t in docs]))[1])
    assert np.count_nonzero(weights[seen]) >= 0.95 * len(seen) and not weights[np.setdiff1d(np.arange(len(weights)), seen)].any()


def test_texts_without_features_only(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "") for i in range(10)], "doc_id long, text string")
    model = X.train(df, spark.createDataFrame([(i, int(i < 4)) for i in range(10)], "doc_id long, toxic int"))
    assert {0.3 < r.score < 0.5 for r in X.score(df, model).collect()} == {True}


def test_grams_are_distinct_and_of_one_text():
    row, f = X.grams(pa.array(["abcdefab", "abc", None, "ABCDE abcde"]))
    assert len(set(zip(row, f))) == len(f)
    lone, g = X.grams(pa.array(["abcdefab"]))
    assert g.tolist() == f[row == 0].tolist() and not (row == 1).any() and not (row == 2).any()


def test_query(spark):
    lab = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    got = X.op3_toxicity(spark, SF_SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in got)
    toxic = [r for r in X.op3_toxicity(spark, SF_SMALL.replace("0.001", "0.01")).collect() if r.held_out]
    marked = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet").where("toxic = 1").collect()}
    toxic = [r for r in toxic if r.doc_id in marked]
    assert toxic and sum(r.predicted for r in toxic) >= 0.3 * len(toxic)
    clean = [r for r in got if lab.get(r.doc_id) == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_a_fit_holds_little_more_than_its_features():
    import tracemalloc

    import pandas as pd
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(3000)]
    frame = pd.DataFrame({"y": [i % 2 for i in range(400)], "text": [" ".join(rng.choice(words, 1000)) for _ in range(400)]})
    fit = X._fit(rng.normal(size=1 << X.DIM_BITS))
    tracemalloc.start()
    try:
        assert len(fit(frame)) > 1
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 70e6, peak                    # about 3.2 million features of documents, 8 bytes each, and a part's arrays
