"""Greedy selection against a NumPy brute force; estimator/model behaviour."""

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, Vectors

from tessera.operators import criteria as C
from tessera.operators import selection as S
from tests.test_infotheory import cmi, frame, matrix, mi


def brute_greedy(X, y, crit, n, beta=0.5):
    d = X.shape[1]
    rel = [mi(X[:, k], y) for k in range(d)]
    sel, scores = [], []
    for i in range(min(n, d)):
        best = None
        for k in range(d):
            if k in sel:
                continue
            if i == 0 or crit == "mim":
                s = rel[k]
            else:
                m = [mi(X[:, k], X[:, j]) for j in sel]
                c = [cmi(X[:, k], X[:, j], y) for j in sel]
                if crit == "mifs":
                    s = rel[k] - beta * sum(m)
                elif crit == "jmi":
                    s = rel[k] - sum(a - b for a, b in zip(m, c)) / len(sel)
                elif crit == "mrmr":
                    s = rel[k] - sum(m) / len(sel)
                elif crit == "icap":
                    s = rel[k] - sum(max(0.0, a - b) for a, b in zip(m, c))
                else:
                    s = rel[k] - max(a - b for a, b in zip(m, c))
            key = (round(s, 10), -k)
            if best is None or key > best[0]:
                best = (key, k, s)
        sel.append(best[1])
        scores.append(best[2])
    return sel, scores


@pytest.fixture(scope="module")
def source(spark):
    X, y = matrix(seed=11, n=300)
    src = S.DenseFeatures(frame(spark, X, y))
    yield X, y, src
    src.release()


def test_all_criteria_match_bruteforce(source):
    X, y, src = source
    got = S.greedy_select_many(src, list(C.CRITERIA), 4)
    for crit in C.CRITERIA:
        feats, scores = brute_greedy(X, y, crit, 4)
        assert got[crit].features == feats, crit
        assert got[crit].scores == pytest.approx(scores, abs=1e-9), crit


def test_single_equals_lockstep_and_identities(source):
    X, y, src = source
    one = S.greedy_select(src, "jmi", 3)
    assert one.features == S.greedy_select_many(src, ["mrmr", "jmi"], 3)["jmi"].features
    assert S.greedy_select(src, "mim", 4).features == S.greedy_select(src, "mifs", 4, beta=0.0).features
    assert S.greedy_select(src, "cmim", 4).features == S.greedy_select(src, "if", 4).features


def test_n_is_clamped_and_exact(source):
    X, y, src = source
    assert len(S.greedy_select(src, "mrmr", 50).features) == X.shape[1]
    assert len(S.greedy_select(src, "mrmr", 3).features) == 3


def test_unknown_criterion(source):
    with pytest.raises(ValueError):
        S.greedy_select(source[2], "nope", 2)


def test_estimator_array_and_vector_columns(spark, source, tmp_dir):
    X, y, _ = source
    df = frame(spark, X, y)
    est = S.FeatureSelector(selectCriterion="mrmr", numTopFeatures=3, featuresCol="x", labelCol="y",
                            outputCol="sel")
    model = est.fit(df)
    expected = sorted(brute_greedy(X, y, "mrmr", 3)[0])
    assert model.selectedFeatures == expected
    out = model.transform(df).select("x", "sel").collect()
    for r in out:
        assert list(r["sel"]) == [r["x"][i] for i in expected]
    meta = model.transform(df).schema["sel"].metadata
    assert meta["ml_attr"]["num_attrs"] == 3

    # Vector column, sparse rows: VectorSlicer path keeps sparsity and indices
    vec = spark.createDataFrame([(Vectors.sparse(8, [0, 3, 7], [1.0, 2.0, 3.0]), 1.0)],
                                ["features", "label"])
    m2 = S.FeatureSelectorModel([3, 5, 7]).setFeaturesCol("features").setOutputCol("o")
    v = m2.transform(vec).first()["o"]
    assert isinstance(v, SparseVector) and v.size == 3
    assert list(v.indices) == [0, 2] and list(v.values) == [2.0, 3.0]

    path = f"{tmp_dir}/model"
    model.write().overwrite().save(path)
    back = S.FeatureSelectorModel.load(path)
    assert back.selectedFeatures == model.selectedFeatures
    assert back.getSelectCriterion() == "mrmr" and back.getNumTopFeatures() == 3
    assert spark.read.parquet(f"{path}/data").schema.simpleString() == \
        "struct<selectedFeatures:array<int>>"

    est_path = f"{tmp_dir}/est"
    est.write().overwrite().save(est_path)
    assert S.FeatureSelector.load(est_path).getNumTopFeatures() == 3


def test_bad_inputs(spark):
    bad = spark.createDataFrame([([200, 1], 0), ([1, 1], 1)], "x array<int>, y int")
    with pytest.raises(ValueError):
        S.DenseFeatures(bad)
    frac = spark.createDataFrame([([1.5, 1.0], 0)], "x array<double>, y int")
    with pytest.raises(ValueError):
        S.DenseFeatures(frac)
    with pytest.raises(TypeError):
        S.FeatureSelector(featuresCol="s", labelCol="y").fit(
            spark.createDataFrame([("a", 1)], "s string, y int"))
    with pytest.raises(ValueError):
        S.FeatureSelectorModel([3, 1])
    with pytest.raises(ValueError):
        S.FeatureSelector(numTopFeatures=0).fit(frame(spark, np.zeros((2, 2), int), np.zeros(2, int)))


def test_sparse_path_matches_dense(spark, source):
    X, y, src = source
    entries = [(i, int(y[i]), k, int(X[i, k])) for i in range(len(y)) for k in range(X.shape[1])
               if X[i, k] != 0]
    e = spark.createDataFrame(entries, "id bigint, y tinyint, k int, v tinyint")
    rows = frame(spark, X, y).select("id", "y")
    model = S.FeatureSelector(selectCriterion="jmi", numTopFeatures=3).fit_sparse(e, rows, X.shape[1])
    assert model.selectionOrder == S.greedy_select(src, "jmi", 3).features


def test_reports(spark, source):
    X, y, src = source
    rel = S.relevance_table(src)
    rep = S.maxrel_report(rel, 2).collect()
    assert rep[0]["feature"] == 2        # feature 1 (copy of label) printed 1-based
    assert len(rep[0]["score"].split(".")[1]) == 4
    sel = S.selection_frame(spark, S.greedy_select(src, "mrmr", 2))
    assert [r["feature"] for r in S.selected_report(sel).collect()][0] == 2
    assert [r["feat"] for r in S.sorted_selection(spark, [5, 1, 3]).collect()] == [1, 3, 5]


def test_copy_with_extra_params():
    from tessera.operators.selection import FeatureSelector, FeatureSelectorModel
    est = FeatureSelector(selectCriterion="icap", numTopFeatures=4)
    twin = est.copy({est.numTopFeatures: 9})
    assert twin.getNumTopFeatures() == 9 and est.getNumTopFeatures() == 4
    assert twin.getSelectCriterion() == "icap" and twin.uid == est.uid
    model = FeatureSelectorModel([1, 4], [4, 1], [0.5, 0.25])
    mcopy = model.copy({model.outputCol: "o2"})
    assert mcopy.selectedFeatures == [1, 4] and mcopy.getOutputCol() == "o2"


def test_vector_column_sparse_and_dense_paths(spark, source, monkeypatch):
    from pyspark.ml.linalg import Vectors
    X, y, src = source
    want = S.greedy_select(src, "mrmr", 3).features
    sparse_rows = [(Vectors.sparse(X.shape[1], {k: float(X[i, k]) for k in range(X.shape[1])
                                                if X[i, k] != 0}), float(y[i])) for i in range(len(y))]
    dense_rows = [(Vectors.dense([float(v) for v in X[i]]), float(y[i])) for i in range(len(y))]
    used = []
    real_sparse, real_dense = S.SparseFeatures, S.DenseFeatures
    monkeypatch.setattr(S, "SparseFeatures", lambda *a, **k: used.append("sparse") or real_sparse(*a, **k))
    monkeypatch.setattr(S, "DenseFeatures", lambda *a, **k: used.append("dense") or real_dense(*a, **k))
    for rows, threshold in ((sparse_rows, 1.01), (dense_rows, 0.0)):
        monkeypatch.setattr(S, "SPARSE_DENSITY", threshold)
        df = spark.createDataFrame(rows, ["features", "label"])
        model = S.FeatureSelector(selectCriterion="mrmr", numTopFeatures=3).fit(df)
        assert model.selectionOrder == want
    assert used == ["sparse", "dense"]
    ve = S.vector_entries(spark.createDataFrame(sparse_rows[:5], ["features", "label"]),
                          "features", "label")
    assert ve.n_features == X.shape[1] and ve.density < 1.0
    assert ve.entries.count() == int((X[:5] != 0).sum())


def test_transform_before_fit_fails(spark):
    df = spark.createDataFrame([([1, 2],)], "x array<int>")
    with pytest.raises(RuntimeError, match="before fit"):
        S.FeatureSelectorModel().setFeaturesCol("x").transform(df)


def test_slice_of_slice(spark):
    rng = np.random.default_rng(8)
    X = rng.integers(-2, 3, (30, 10))
    df = spark.createDataFrame([(i, [int(v) for v in X[i]]) for i in range(30)], "id bigint, x array<int>")
    first, second = [1, 3, 4, 7, 9], [0, 2, 4]            # second indexes into first's output
    twice = S.slice_dense(S.slice_dense(df, "x", first, "a"), "a", second, "b")
    once = S.slice_dense(df, "x", [first[i] for i in second], "c")
    got = twice.join(once, "id").select("b", "c").collect()
    assert all(list(r["b"]) == list(r["c"]) for r in got) and len(got) == 30
    entries = spark.createDataFrame([(i, k, int(X[i, k])) for i in range(30) for k in range(10)
                                     if X[i, k] != 0], "id bigint, k int, v int")
    e_twice = S.slice_sparse_entries(S.slice_sparse_entries(entries, first), second)
    e_once = S.slice_sparse_entries(entries, [first[i] for i in second])
    assert e_twice.exceptAll(e_once).count() == 0 and e_once.exceptAll(e_twice).count() == 0


def test_model_report(spark):
    model = S.FeatureSelectorModel([1, 4], [4, 1], [0.5, 0.25])
    rows = model.report(spark).collect()
    assert [(r.feature, r.score) for r in rows] == [(5, "0.5000"), (2, "0.2500")]


def _refused(spark, rows, schema="features array<double>, label double"):
    df = spark.createDataFrame(rows, schema)
    with pytest.raises(ValueError) as e:
        S.FeatureSelector(numTopFeatures=1).fit(df)
    return str(e.value)


def test_one_rule_for_arrays_and_vectors(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType())])
    sparse = [(Vectors.sparse(8, {0: 1.0}), 1.0)] * 20
    dense = [([1.0] + [0.0] * 7, 1.0)] * 20
    assert "null vector" in _refused(spark, sparse + [(None, 0.0)], schema)
    assert "null vector" in _refused(spark, dense + [(None, 0.0)])
    assert "dimension" in _refused(spark, sparse + [(Vectors.sparse(5, {0: 1.0}), 0.0)], schema)
    assert "dimension" in _refused(spark, dense + [([1.0], 0.0)])
    assert "not a byte" in _refused(spark, sparse + [(Vectors.sparse(8, {0: 0.5}), 0.0)], schema)
    assert "not a byte" in _refused(spark, dense + [([0.5] * 8, 0.0)])
    assert "null element" in _refused(spark, dense + [([None] * 8, 0.0)])
    assert "label" in _refused(spark, dense + [([1.0] * 8, None)])


@pytest.mark.parametrize("entry", [(1, 0.0, 0, 0), (1, 0.0, 0, None), (1, 0.0, 9, 1), (0, 1.0, 0, 1), (1, 0.0, 0, 300)])
def test_sparse_entries_keep_their_contract(spark, entry):
    rows = [(0, 1.0, 0, 1), (0, 1.0, 1, 1)]
    e = spark.createDataFrame(rows + [entry], "id long, y double, k int, v int")
    with pytest.raises(ValueError, match="refused"):
        S.SparseFeatures(e, e.select("id", "y").distinct(), 2)


def test_output_column_must_be_new_and_gets_nominal_attributes(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([1.0, 0.0, 2.0]), 1.0), (Vectors.dense([0.0, 1.0, 1.0]), 0.0)], ["features", "label"])
    with pytest.raises(ValueError, match="label"):
        S.FeatureSelector(outputCol="label").fit(df)
    model = S.FeatureSelectorModel([0, 2])
    with pytest.raises(ValueError, match="features"):
        model.copy({model.outputCol: "features"}).transform(df)
    meta = model.transform(df).schema["selectedFeatures"].metadata["ml_attr"]
    assert [a["type"] for a in meta["attrs"]["nominal"]] == ["nominal"] * 2
