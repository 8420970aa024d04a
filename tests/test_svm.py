"""SVM training against NumPy recurrences and MLlib; bad inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import svm as SV
from tessera.operators.split import key_hash


def data(spark, n=120, d=5, seed=4):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    y = (X[:, 0] + 0.5 * X[:, 1] > 0).astype(float)
    wt = 1.0 + (np.arange(n) % 3)
    rows = [(i, float(y[i]), float(wt[i]), [float(v) for v in X[i]]) for i in range(n)]
    return X, y, wt, spark.createDataFrame(rows, "id bigint, label double, wt double, features array<double>")


def numpy_sgd(X, y, iters, step=1.0, reg=0.01, tol=0.001):
    w = np.zeros(X.shape[1])
    s = 2 * y - 1
    for i in range(1, iters + 1):
        active = s * (X @ w) < 1
        g = -(s[active, None] * X[active]).sum(0) / len(y)
        st = step / math.sqrt(i)
        new = w * (1 - st * reg) - st * g
        done = np.linalg.norm(new - w) < tol * max(np.linalg.norm(new), 1.0)
        w = new
        if done:
            break
    return w


def test_sgd_matches_numpy(spark):
    X, y, _, df = data(spark)
    w = SV.sgd_svm(df, 6)
    assert np.allclose(w, numpy_sgd(X, y, 6), atol=1e-12)


def test_sgd_matches_mllib(spark):
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint
    X, y, _, df = data(spark)
    rdd = spark.sparkContext.parallelize([LabeledPoint(y[i], X[i]) for i in range(len(y))], 2)
    ml = SVMWithSGD.train(rdd, iterations=8)
    ours = SV.sgd_svm(df, 8)
    assert np.allclose(np.array(ml.weights), ours, atol=1e-9)


def test_predict_and_accuracy(spark):
    X, y, _, df = data(spark)
    w = SV.sgd_svm(df, 10)
    pred = SV.predict(df, w)
    got = np.array([r.prediction for r in pred.orderBy("id").collect()])
    assert np.array_equal(got, (X @ np.array(w) > 0).astype(float))
    acc = SV.accuracy(pred).first()["accuracy"]
    assert acc == pytest.approx((got == y).mean())


def numpy_svc(X, y, wt, iters, lr, reg, alpha, tol=1e-6):
    w = np.zeros(X.shape[1])
    s = 2 * y - 1
    prev = None
    for _ in range(iters):
        m = s * (X @ w)
        loss = (wt * np.maximum(0, 1 - m)).sum() / wt.sum()
        if prev is not None and abs(prev - loss) < tol:
            break
        prev = loss
        active = m < 1
        g = -((wt * s)[active, None] * X[active]).sum(0) / wt.sum()
        v = w * (1 - lr * reg * (1 - alpha)) - lr * g
        thr = lr * reg * alpha
        w = np.sign(v) * np.maximum(np.abs(v) - thr, 0.0)
    return w


@pytest.mark.parametrize("alpha", [0.0, 0.5])
def test_linear_svc_full_batch_matches_numpy(spark, alpha):
    X, y, wt, df = data(spark)
    model = SV.LinearSvc(weightCol="wt", maxIter=5, learningRate=0.5, reg=0.05, elasticNet=alpha,
                         globalBatchSize=10_000).fit(df)
    assert np.allclose(model.coefficients, numpy_svc(X, y, wt, 5, 0.5, 0.05, alpha), atol=1e-12)
    out = model.transform(df).select("prediction").collect()
    assert len(out) == len(y)


def test_linear_svc_minibatch_and_defaults(spark):
    X, y, wt, df = data(spark)
    model = SV.LinearSvc(idCol="id", maxIter=4, globalBatchSize=30).fit(df)   # no weight column
    assert len(model.coefficients) == X.shape[1]
    assert model.getLearningRate() == 0.1 and model.getGlobalBatchSize() == 30
    plain = SV.LinearSvc(maxIter=2, globalBatchSize=10).fit(df)     # without idCol: by the hash of the row
    assert any(plain.coefficients)
    assert SV.LinearSvc(maxIter=0, globalBatchSize=10_000).fit(df).coefficients == [0.0] * 5


def test_bad_inputs(spark):
    bad_label = spark.createDataFrame([(2.0, [1.0]), (1.0, [1.0])], "label double, features array<double>")
    with pytest.raises(ValueError, match="binary"):
        SV.sgd_svm(bad_label, 2)
    ragged = spark.createDataFrame([(0.0, [1.0, 2.0]), (1.0, [1.0])], "label double, features array<double>")
    with pytest.raises(ValueError, match="dimension"):
        SV.sgd_svm(ragged, 2)
    same = spark.createDataFrame([(1.0, [1.0, 2.0]), (1.0, [0.5, 1.0])], "label double, features array<double>")
    assert len(SV.sgd_svm(same, 3)) == 2          # all labels equal: still trains


def test_params_persist_and_copy(spark, tmp_dir):
    est = SV.LinearSvc(maxIter=7, learningRate=0.3, reg=0.02, elasticNet=0.25, weightCol="wt")
    est.write().overwrite().save(f"{tmp_dir}/svc")
    back = SV.LinearSvc.load(f"{tmp_dir}/svc")
    assert (back.getMaxIter(), back.getLearningRate(), back.getReg(), back.getElasticNet(),
            back.getWeightCol()) == (7, 0.3, 0.02, 0.25, "wt")
    twin = est.copy({est.maxIter: 3})
    assert twin.getMaxIter() == 3 and est.getMaxIter() == 7


def test_wide_gradient_path_matches_numpy(spark, monkeypatch):
    X, y, wt, df = data(spark, n=90, d=6)
    monkeypatch.setattr(SV, "WIDE_LIMIT", 2)          # force the broadcast / NumPy path
    w = SV.sgd_svm(df, 5)
    assert np.allclose(w, numpy_sgd(X, y, 5), atol=1e-12)
    model = SV.LinearSvc(weightCol="wt", maxIter=4, learningRate=0.5, reg=0.05, elasticNet=0.5,
                         globalBatchSize=10_000).fit(df)
    assert np.allclose(model.coefficients, numpy_svc(X, y, wt, 4, 0.5, 0.05, 0.5), atol=1e-12)
    pred = SV.predict(df, w).orderBy("id").collect()
    assert [r.prediction for r in pred] == list((X @ np.array(w) > 0).astype(float))
    assert set(pred[0].asDict()) == {"id", "label", "wt", "features", "prediction"}


def test_tiny_fractions_keep_rows(spark):
    rows = spark.range(20_000_000).selectExpr("id", "CAST(id % 2 AS DOUBLE) AS label").withColumn("_hash", key_hash(["id"]))
    n = SV.Batches(rows, 4e-7).interval().count()
    assert 1 <= n <= 30
    _, _, _, df = data(spark)
    assert any(SV.sgd_svm(df, 3, fraction=1e-9, key="id"))           # empty intervals go on to the next row
    assert any(SV.LinearSvc(maxIter=3, globalBatchSize=1).fit(df).coefficients)


def test_batches_walk_round_the_hash_circle(spark):
    _, _, _, df = data(spark)
    rows = df.withColumn("_hash", key_hash(["id"])).persist()
    b, seen = SV.Batches(rows, 0.25), []
    for _ in range(4):
        seen += [r.id for r in b.interval().collect()]
        b.step()
    assert sorted(seen) == sorted(r.id for r in rows.collect())


@pytest.mark.parametrize("limit", [2, 256])
def test_nulls_and_lengths_at_any_width(spark, monkeypatch, limit):
    monkeypatch.setattr(SV, "WIDE_LIMIT", limit)
    bad = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, None), (3, [1.0, None, 3.0]), (4, [1.0])], "id int, features array<double>")
    got = {r.id: r.prediction for r in SV.predict(bad, [1.0, 0.0, 0.0]).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: None}
    rows = spark.createDataFrame([(0.0, [1.0, 2.0]), (1.0, None)], "label double, features array<double>")
    with pytest.raises(ValueError, match="null vector"):
        SV.sgd_svm(rows, 2)
    rows = spark.createDataFrame([(0.0, [1.0, 2.0]), (1.0, [1.0, None])], "label double, features array<double>")
    with pytest.raises(ValueError, match="null element"):
        SV.LinearSvc().fit(rows)


def test_svc_model_saved_and_loaded(spark, tmp_dir):
    _, _, _, df = data(spark)
    model = SV.LinearSvc(weightCol="wt", maxIter=3, globalBatchSize=10_000, predictionCol="p").fit(df)
    model.write().overwrite().save(f"{tmp_dir}/model")
    back = SV.LinearSvcModel.load(f"{tmp_dir}/model")
    assert back.coefficients == model.coefficients and back.losses == model.losses and back.getPredictionCol() == "p"
    assert back.transform(df).orderBy("id").collect() == model.transform(df).orderBy("id").collect()


def test_equal_rows_are_split_between_partitions(spark):
    """A third of all rows equal: no partition of the batch layout above twice the median, and no row lost."""
    same = spark.range(30_000).selectExpr("1.0D AS label", "array(1.0D, 2.0D) AS features", "7L AS _hash")
    rest = spark.range(60_000).selectExpr("0.0D AS label", "array(id * 1.0D, 3.0D) AS features", "xxhash64(id) AS _hash")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = SV._persisted(same.unionByName(rest).repartition(16), sampled=True)
        sizes = sorted(r.n for r in data.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect())
        data.unpersist()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 90_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
