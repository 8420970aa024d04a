"""SVM over sparse rows: equal to the dense form, whatever the blocks; bad input; plans."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import sparse_svm as SP
from tessera.operators import svm as SV


def made(n=200, d=40, share=0.15, seed=5):
    rng = np.random.default_rng(seed)
    X = np.where(rng.random((n, d)) < share, rng.normal(size=(n, d)), 0.0)
    X[:, 3] = 1.0                                   # a feature of every row
    X[4] = 0.0                                      # a row without any
    y = (X[:, 0] + X[:, 1] - X[:, 2] > 0).astype(float)
    return X, y, 1.0 + np.arange(n) % 3


def frames(spark, X, y, wt):
    d = X.shape[1]
    vec = [Vectors.sparse(d, [int(k) for k in np.flatnonzero(r)], r[r != 0].tolist()) if i % 5 else Vectors.dense(r) for i, r in enumerate(X)]
    sparse = spark.createDataFrame([(i, float(a), float(w), v) for i, (a, w, v) in enumerate(zip(y, wt, vec))], ["id", "label", "wt", "features"])
    dense = spark.createDataFrame([(i, float(a), float(w), r.tolist()) for i, (a, w, r) in enumerate(zip(y, wt, X))],
                                  "id bigint, label double, wt double, features array<double>")
    return sparse.repartition(3), dense


def as_array(weights, d):
    w = np.zeros(d)
    for r in weights.collect():
        w[r.k] = r.w
    return w


@pytest.mark.parametrize("block", [1, 50])
def test_sgd_equals_the_dense_form(spark, block):
    sparse, dense = frames(spark, *made())
    w, d = SP.sgd(sparse, 3, block=block)
    assert d == 40 and np.allclose(as_array(w, d), SV.sgd_svm(dense, 3), atol=1e-12)


def test_sgd_batches_and_early_stop(spark):
    sparse, dense = frames(spark, *made())
    w, d = SP.sgd(sparse, 4, fraction=0.3, key="id")
    assert np.allclose(as_array(w, d), SV.sgd_svm(dense, 4, fraction=0.3, key="id"), atol=1e-12)
    w, d = SP.sgd(sparse, 6, tol=0.9)
    assert np.allclose(as_array(w, d), SV.sgd_svm(dense, 6, tol=0.9), atol=1e-12)
    w, _ = SP.sgd(dense, 2)                          # arrays are taken too
    assert np.allclose(as_array(w, d), SV.sgd_svm(dense, 2), atol=1e-12)


@pytest.mark.parametrize("alpha,size", [(0.0, None), (0.5, None), (0.5, 60)])
def test_svc_equals_linear_svc(spark, alpha, size):
    sparse, dense = frames(spark, *made())
    w, d = SP.svc(sparse, 3, lr=0.5, batch=size, reg=0.05, alpha=alpha, weight="wt", key="id")
    model = SV.LinearSvc(weightCol="wt", idCol="id", maxIter=3, learningRate=0.5, reg=0.05, elasticNet=alpha, globalBatchSize=size or 10_000).fit(dense)
    assert np.allclose(as_array(w, d), model.coefficients, atol=1e-12)


def test_a_batch_without_rows_goes_on_to_the_next_one(spark):
    X, y, wt = made(n=5)
    sparse, dense = frames(spark, X, y, wt)
    w, d = SP.sgd(sparse, 3, fraction=0.01, key="id")
    assert np.allclose(as_array(w, d), SV.sgd_svm(dense, 3, fraction=0.01, key="id"), atol=1e-12)


def test_predict_keeps_rows_and_columns(spark):
    X, y, wt = made(n=60)
    sparse, dense = frames(spark, X, y, wt)
    w, d = SP.sgd(sparse, 3)
    want = {r.id: r.prediction for r in SV.predict(dense, as_array(w, d).tolist()).collect()}
    odd = spark.createDataFrame([(100, 0.0, 1.0, None), (101, 0.0, 1.0, Vectors.sparse(7, [1], [1.0]))], sparse.schema)
    twice = sparse.union(sparse.where("id = 9")).union(odd).withColumn("_row", F.lit("mine")).withColumn("prediction", F.lit(-5.0))
    got = SP.predict(twice, w, d)
    assert got.columns == twice.columns and got.count() == 63
    rows = got.collect()
    assert all(r._row == "mine" and r.prediction == want.get(r.id) for r in rows)
    none = SP.predict(sparse, w.where("k < 0"), d)                  # no weights: every margin is 0
    assert {r.prediction for r in none.collect()} == {0.0}
    assert SP.predict(sparse.where("id < 0"), w, d).count() == 0


def test_bad_input(spark):
    def vec(*rows):
        return spark.createDataFrame([(a, Vectors.sparse(n, [0], [1.0])) for a, n in rows], ["label", "features"])

    with pytest.raises(ValueError, match="binary"):
        SP.sgd(vec((2.0, 3), (1.0, 3)), 1)
    with pytest.raises(ValueError, match="dimension"):
        SP.sgd(vec((0.0, 3), (1.0, 4)), 1)
    with pytest.raises(ValueError, match="null element"):
        SP.sgd(spark.createDataFrame([(1.0, [1.0, None])], "label double, features array<double>"), 1)
    with pytest.raises(ValueError, match="null vector"):
        SP.sgd(spark.createDataFrame([(1.0, None), (0.0, [1.0])], "label double, features array<double>"), 1)
    with pytest.raises(ValueError, match="no training rows"):
        SP.sgd(spark.createDataFrame([], "label double, features array<double>"), 1)
    with pytest.raises(ValueError, match="key"):
        SP.svc(vec((0.0, 3)), 1, batch=10)


def test_wide_rows_stay_sparse(spark):
    """Vectors of 2^30 entries: nothing is as long as they are."""
    d = 1 << 30
    rows = [(float(i % 2), Vectors.sparse(d, [i, d - 1], [1.0 if i % 2 else -1.0, 0.5])) for i in range(40)]
    w, size = SP.sgd(spark.createDataFrame(rows, ["label", "features"]), 2)
    assert size == d and w.count() <= 41 and w.where(f"k = {d - 1}").count() <= 1


def test_a_feature_of_every_row_is_a_row_per_block(spark):
    sparse, _ = frames(spark, *made(n=400))
    from tessera.session import RoundTables
    blocks, _ = SP.training_blocks(sparse, "features", "label", None, None, RoundTables(spark, "t"), block=300)
    named = blocks.select(F.explode("ks").alias("k"))
    assert named.where("k = 3").count() == blocks.count()           # 399 non-zeros, a row per block
    assert blocks.agg(F.max(F.size("x"))).first()[0] <= 300 + 40
