"""Counting and MI/CMI against a NumPy brute force, plus properties."""

import numpy as np
import pytest

from tessera.operators import infotheory as I


def entropy(*cols):
    keys = np.stack(cols, axis=1)
    _, counts = np.unique(keys, axis=0, return_counts=True)
    p = counts / counts.sum()
    return float(-(p * np.log2(p)).sum())


def mi(a, b):
    return entropy(a) + entropy(b) - entropy(a, b)


def cmi(a, b, y):
    return entropy(a, y) + entropy(b, y) - entropy(a, b, y) - entropy(y)


def matrix(seed=7, n=240):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 3, n)
    a = rng.integers(0, 2, n)
    b = rng.integers(0, 2, n)
    cols = [
        np.zeros(n, dtype=int),            # 0 constant
        y.copy(),                          # 1 copy of the label
        a, a.copy(),                       # 2, 3 equal features
        b, a ^ b,                          # 4, 5 xor pair
        rng.integers(-3, 4, n),            # 6 noise with negatives
        (y + rng.integers(0, 2, n)) % 4,   # 7 noisy label
    ]
    X = np.stack(cols, axis=1)
    return X, y


def frame(spark, X, y):
    rows = [(i, [int(v) for v in X[i]], int(y[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "id bigint, x array<tinyint>, y tinyint")


@pytest.fixture(scope="module")
def data(spark):
    X, y = matrix()
    return X, y, frame(spark, X, y)


def collect_info(df):
    return {r["k"]: (r["rel"], r["mi"], r["cmi"]) for r in df.collect()}


def test_relevance_matches_bruteforce(data):
    X, y, df = data
    info = collect_info(I.information(I.dense_cells(df)))
    for k in range(X.shape[1]):
        assert info[k][0] == pytest.approx(mi(X[:, k], y), abs=1e-12)


def test_redundancy_and_conditional_match_bruteforce(data):
    X, y, df = data
    for j in (2, 5, 6):
        info = collect_info(I.information(I.dense_cells(df, given=j)))
        for k in range(X.shape[1]):
            assert info[k][1] == pytest.approx(mi(X[:, k], X[:, j]), abs=1e-12)
            assert info[k][2] == pytest.approx(cmi(X[:, k], X[:, j], y), abs=1e-12)


def test_properties(data):
    X, y, df = data
    rel = collect_info(I.information(I.dense_cells(df)))
    assert all(v[0] >= -1e-12 for v in rel.values())          # MI >= 0
    assert rel[0][0] == pytest.approx(0.0, abs=1e-12)          # constant feature
    assert rel[1][0] == pytest.approx(entropy(y), abs=1e-12)   # copy of label: H(Y)
    red2 = collect_info(I.information(I.dense_cells(df, given=2)))
    red3 = collect_info(I.information(I.dense_cells(df, given=3)))
    assert red2[3][1] == pytest.approx(red3[2][1], abs=1e-12)  # symmetric
    assert red2[3][1] == pytest.approx(entropy(X[:, 2]), abs=1e-12)


def test_xor_conditional_exceeds_marginal(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2, 400)
    b = rng.integers(0, 2, 400)
    y = a ^ b
    df = frame(spark, np.stack([a, b], axis=1), y)
    info = collect_info(I.information(I.dense_cells(df, given=1)))
    assert info[0][2] > info[0][1] + 0.5      # I(A;B|Y) ~ 1 bit, I(A;B) ~ 0


def test_permuting_rows_changes_nothing(spark, data):
    X, y, df = data
    perm = np.random.default_rng(1).permutation(len(y))
    df2 = frame(spark, X[perm], y[perm])
    a = collect_info(I.information(I.dense_cells(df, given=4)))
    b = collect_info(I.information(I.dense_cells(df2, given=4)))
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_sparse_cells_equal_dense_cells(spark, data):
    X, y, df = data
    entries = [(i, int(y[i]), k, int(X[i, k])) for i in range(len(y)) for k in range(X.shape[1])
               if X[i, k] != 0]
    e = spark.createDataFrame(entries, "id bigint, y tinyint, k int, v tinyint")
    rows = df.select("id", "y")
    for given in (None, 4, 6):
        dense = I.dense_cells(df, given=given).selectExpr("CAST(k AS INT) k", "CAST(v AS INT) v",
                                                          "CAST(z AS INT) z", "CAST(y AS INT) y", "c")
        sparse = I.sparse_cells(I.partition_entries(e), rows, X.shape[1], given).selectExpr(
            "CAST(k AS INT) k", "CAST(v AS INT) v", "CAST(z AS INT) z", "CAST(y AS INT) y", "c")
        assert dense.exceptAll(sparse).count() == 0
        assert sparse.exceptAll(dense).count() == 0


def test_many_given_equals_single(data):
    X, y, df = data
    many = I.information(I.dense_cells_many(df, [2, 6]), keys=("j", "k")).collect()
    got = {(r["j"], r["k"]): (r["mi"], r["cmi"]) for r in many}
    for j in (2, 6):
        single = collect_info(I.information(I.dense_cells(df, given=j)))
        for k in range(X.shape[1]):
            assert got[(j, k)] == pytest.approx(single[k][1:], abs=1e-12)


def test_column_summary_and_layout(spark):
    e = spark.createDataFrame([(0, 1, 1), (2, 1, -1), (5, 3, 1)], "id bigint, k int, v tinyint")
    s = {r["k"]: (r["n_nonzero"], r["checksum"]) for r in I.column_summary(e).collect()}
    assert s == {1: (2, -2), 3: (1, 5)}
    laid = I.columnar_layout(e, 2).collect()
    assert sorted((r["k"], r["id"]) for r in laid) == [(1, 0), (1, 2), (3, 5)]
