"""Linear SVM trained by subgradient descent.

Every iteration is one aggregation job over the persisted training rows:
the current weights travel as a literal (d doubles, d fixed by the schema),
each task folds its rows into one partial row (d gradient sums, loss sum,
weight sum) and only that row per task is shuffled; the driver applies the
update.  Lineage never grows: iteration i reads the same persisted rows with
a new literal.

Two update rules:

* ``sgd_svm`` (E7) -- the classic setting: w0 = 0; step_i = step / sqrt(i);
  w <- w (1 - step_i reg) - step_i g; g is the mean hinge subgradient over the
  (optionally sampled) batch; stop early when
  ||w_new - w_old|| < tol * max(||w_new||, 1).
* ``LinearSvc`` (E8) -- weighted rows, constant learning rate, elastic net:
  w <- w (1 - lr reg (1 - a)) - lr g, then soft-threshold by lr reg a; stop
  when the mean weighted hinge loss changes by less than tol, or after maxIter.

Mini-batches: every row has a 60-bit hash, of its key or, without one, of its
values.  It is computed once; the persisted rows are range-partitioned and
sorted by it.  Iteration after iteration takes the next interval of hashes
that holds the wanted fraction on average (round the circle), so cached
blocks outside it are skipped by their bounds.  Where an interval has no row,
the next row's hash begins it: a batch of a table with rows is never empty.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol,
                                     HasTol, HasWeightCol)
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.checks import require_training_table, vector_fault
from tessera.operators.split import HASH_SPACE, hash_cut, key_hash, text_hash

# The classic SGD defaults (step 1.0, reg 0.01, full batch, tol 0.001).
SGD_STEP, SGD_REG, SGD_FRACTION, SGD_TOL = 1.0, 0.01, 1.0, 0.001
# Wider than this, the weights are broadcast and partitions fold NumPy partial gradients.
WIDE_LIMIT = 256


def _d(v: float) -> str:
    """A double literal in Spark SQL text (exact: repr round-trips)."""
    return f"({float(v)!r}D)"


def margin_sql(features: str, w: Sequence[float]) -> str:
    """SQL text of w . x: one array literal and one fold, a small expression tree.

    (Inlining d product terms builds a d-deep tree that costs more to
    optimise and compile per iteration than the fold costs to evaluate.)
    """
    if len(w) == 0:
        return "0.0D"
    arr = ", ".join(_d(v) for v in w)
    return (f"aggregate(zip_with({features}, array({arr}), (a, b) -> a * b), 0.0D, "
            f"(acc, v) -> acc + v)")


def margin(features: str, w: Sequence[float]) -> Column:
    """w . x as a Column."""
    return F.expr(margin_sql(features, w))


def gradient_sums(rows: DataFrame, w: Sequence[float], features: str = "features",
                  label: str = "label", weight: str | None = None) -> tuple[list[float], float, float, int]:
    """(sum of weighted hinge subgradients, weighted loss sum, weight sum, rows).

    One partially aggregated pass (each task ships one partial row).
    s = 2y - 1; a row is active when s (w . x) < 1 and then contributes
    -weight * s * x.  Up to WIDE_LIMIT weights the pass is SQL (weights in one
    array literal, d sums); wider models use ``_gradient_wide``.
    """
    d = len(w)
    if d > WIDE_LIMIT:
        return _gradient_wide(rows, w, features, label, weight)
    wt = f"CAST({weight} AS DOUBLE)" if weight else "1.0D"
    base = rows.selectExpr(f"{features} AS x", f"CAST({label} AS DOUBLE) * 2.0D - 1.0D AS s",
                           f"{wt} AS wt", f"{margin_sql(features, w)} AS m")
    base = base.selectExpr("x", "CASE WHEN s * m < 1.0D THEN -wt * s ELSE 0.0D END AS coef",
                           "wt * greatest(0.0D, 1.0D - s * m) AS loss", "wt")
    grad = "array(" + ", ".join(f"sum(coef * x[{i}])" for i in range(d)) + ") AS g"
    row = base.selectExpr(grad, "sum(loss) AS loss", "sum(wt) AS wsum", "count(1) AS n").first()
    g = [float(v or 0.0) for v in row["g"]] if d else []
    return g, float(row["loss"] or 0.0), float(row["wsum"] or 0.0), int(row["n"] or 0)


def _gradient_wide(rows: DataFrame, w: Sequence[float], features: str, label: str,
                   weight: str | None) -> tuple[list[float], float, float, int]:
    """Wide models: the weights go out once as a broadcast variable (d doubles, a
    proven size) instead of inside every task's plan; each partition folds its
    Arrow batches into ONE partial gradient with NumPy; the partials are summed
    per coordinate by Spark (d rows reach the driver: the model itself)."""
    spark = rows.sparkSession
    d = len(w)
    bc = spark.sparkContext.broadcast(np.asarray(w, dtype=np.float64))
    cols = rows.selectExpr(f"CAST({features} AS ARRAY<DOUBLE>) AS x",
                           f"CAST({label} AS DOUBLE) AS y",
                           f"CAST({weight} AS DOUBLE) AS wt" if weight else "1.0D AS wt")

    def fold(batches):
        wv = bc.value
        g = np.zeros(d)
        loss = wsum = 0.0
        n = 0
        for pdf in batches:
            if pdf.empty:
                continue
            X = np.stack(pdf["x"].to_numpy())
            s = pdf["y"].to_numpy() * 2.0 - 1.0
            wt = pdf["wt"].to_numpy()
            sm = s * (X @ wv)
            coef = np.where(sm < 1.0, -wt * s, 0.0)
            g += coef @ X
            loss += float((wt * np.maximum(0.0, 1.0 - sm)).sum())
            wsum += float(wt.sum())
            n += len(pdf)
        yield pd.DataFrame({"g": [g.tolist()], "loss": [loss], "wsum": [wsum], "n": [n]})

    partial = cols.mapInPandas(fold, "g array<double>, loss double, wsum double, n long")
    partial = partial.persist(StorageLevel.MEMORY_AND_DISK)   # one small row per partition
    try:
        parts = (partial.selectExpr("posexplode(g) AS (k, v)").groupBy("k")
                 .agg(F.expr("sum(v) AS g")).collect())
        tot = partial.selectExpr("sum(loss) AS loss", "sum(wsum) AS wsum", "sum(n) AS n").first()
    finally:
        partial.unpersist()
        bc.unpersist()
    g = [0.0] * d
    for r in parts:
        g[int(r["k"])] = float(r["g"])
    return g, float(tot["loss"] or 0.0), float(tot["wsum"] or 0.0), int(tot["n"] or 0)


def _norm(v: Sequence[float]) -> float:
    return math.sqrt(sum(x * x for x in v))


def row_hash(label: str, features: str, weight: str | None = None) -> Column:
    """Hash of a row's values, in millionths: equal rows share it, and are drawn together."""
    micro = lambda c: f"CAST(round(CAST({c} AS DOUBLE) * 1000000.0D) AS BIGINT)"
    parts = [micro(label), *([micro(weight)] if weight else []),
             f"array_join(transform({features}, v -> CAST({micro('v')} AS STRING)), '::')"]
    return text_hash(F.expr("concat_ws('::', " + ", ".join(parts) + ")"))


class Batches:
    """Successive mini-batches of rows that have the column ``_hash``."""

    def __init__(self, rows: DataFrame, fraction: float):
        self.rows, self.width, self.at = rows, max(1, hash_cut(fraction)), 0

    def interval(self) -> DataFrame:
        """The rows of the interval that begins here (it may run over the end of the circle)."""
        end = self.at + self.width
        h = F.col("_hash")
        if end <= HASH_SPACE:
            return self.rows.filter((h >= self.at) & (h < end))
        return self.rows.filter((h >= self.at) | (h < end - HASH_SPACE))

    def step(self) -> None:
        self.at = (self.at + self.width) % HASH_SPACE

    def skip(self) -> None:
        """To the next row's hash, after an empty interval."""
        self.step()
        first, after = self.rows.agg(F.min("_hash"), F.min(F.when(F.col("_hash") >= self.at, F.col("_hash")))).first()
        self.at = after if after is not None else first


class _Whole:
    """The whole table as every batch."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def interval(self) -> DataFrame:
        return self.rows

    def step(self) -> None:
        pass


def batch_gradient(batches, w: Sequence[float], features: str, label: str, weight: str | None = None):
    """``gradient_sums`` of the next batch, which is not empty."""
    out = gradient_sums(batches.interval(), w, features, label, weight)
    if out[3] == 0 and isinstance(batches, Batches):
        batches.skip()
        out = gradient_sums(batches.interval(), w, features, label, weight)
    if out[3] == 0:
        raise ValueError("an empty batch")
    batches.step()
    return out


def _persisted(data: DataFrame, sampled: bool) -> DataFrame:
    """The training rows, in ranges of the hash if batches are drawn; equal rows (one hash) are dealt by the partition they come from."""
    if sampled:
        data = data.withColumn("_spread", F.spark_partition_id()).repartitionByRange("_hash", "_spread") \
            .sortWithinPartitions("_hash").drop("_spread")
    return data.persist(StorageLevel.MEMORY_AND_DISK)


def sgd_svm(rows: DataFrame, iterations: int, step: float = SGD_STEP, reg: float = SGD_REG,
            fraction: float = SGD_FRACTION, tol: float = SGD_TOL, features: str = "features",
            label: str = "label", key: str | None = None) -> list[float]:
    """Weights after ``iterations`` subgradient steps (no intercept).

    ``fraction`` < 1 samples each iteration's batch by hash of ``key`` (of the row without one).
    """
    return sgd_svm_counted(rows, iterations, step, reg, fraction, tol, features, label, key)[0]


def sgd_svm_counted(rows: DataFrame, iterations: int, step: float = SGD_STEP, reg: float = SGD_REG,
                    fraction: float = SGD_FRACTION, tol: float = SGD_TOL, features: str = "features",
                    label: str = "label", key: str | None = None) -> tuple[list[float], int]:
    """``sgd_svm`` with the number of training rows, counted in the validation pass."""
    sampled = fraction < 1.0
    data = svc_rows(rows, features, label, None, key, sampled)
    data = _persisted(data, sampled)
    try:
        d, n_rows = require_training_table(data)
        batches = Batches(data, fraction) if sampled else _Whole(data)
        w = [0.0] * d
        for i in range(1, int(iterations) + 1):
            g, _, _, n = batch_gradient(batches, w, "features", "label")
            st = step / math.sqrt(i)
            new = [wi * (1.0 - st * reg) - st * gi / n for wi, gi in zip(w, g)]
            done = _norm([a - b for a, b in zip(new, w)]) < tol * max(_norm(new), 1.0)
            w = new
            if done:
                break
        return w, n_rows
    finally:
        data.unpersist()


def predict(df: DataFrame, w: Sequence[float], features: str = "features",
            out: str = "prediction", threshold: float = 0.0) -> DataFrame:
    """1.0 when w . x > threshold, else 0.0 (a projection; all columns kept).

    At any width: null for a null vector, a null element or another length.
    """
    x = F.col(features)
    fault = vector_fault(features, dim=F.lit(len(w)))
    if len(w) <= WIDE_LIMIT:
        return df.withColumn(out, F.when(fault.isNull(), F.expr(f"CAST(({margin_sql(features, w)}) > {_d(threshold)} AS DOUBLE)")))
    bc = df.sparkSession.sparkContext.broadcast(np.asarray(w, dtype=np.float64))
    thr = float(threshold)

    @F.pandas_udf("double")
    def wide_predict(x: pd.Series) -> pd.Series:
        given = x.notna()
        pred = pd.Series(np.nan, index=x.index, dtype="float64")
        if given.any():
            m = np.stack(x[given].to_numpy()) @ bc.value
            pred[given] = ((m > thr) | np.isnan(m)).astype(np.float64)      # NaN is greatest, as in SQL
        return pred

    valid = F.when(fault.isNull(), x.cast("array<double>"))
    return df.withColumn(out, F.when(fault.isNull(), wide_predict(valid)))


def accuracy(pred: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows whose integer parts of prediction and label agree, and the rows (one pass)."""
    hit = (F.col(prediction).cast("int") == F.col(label).cast("int")).cast("double")
    return pred.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- LinearSvc

def svc_rows(df: DataFrame, features: str, label: str, weight: str | None, key: str | None = None,
             hashed: bool = False) -> DataFrame:
    """S5 + P1-P3: (label double, weight double, features array<double>); ``hashed``: and ``_hash`` for batches."""
    dt = df.schema[features].dataType
    x = vector_to_array(F.col(features)) if isinstance(dt, VectorUDT) else \
        F.col(features).cast("array<double>")
    wt = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = [F.col(label).cast("double").alias("label"), wt.alias("weight"), x.alias("features")]
    if not hashed:
        return df.select(*rows)
    if key:
        return df.select(*rows, key_hash([key]).alias("_hash"))
    return df.select(*rows).withColumn("_hash", row_hash("label", "features", "weight"))


def elastic_step(w: Sequence[float], g: Sequence[float], lr: float, reg: float,
                 alpha: float) -> list[float]:
    """Q9: L2 shrink, gradient step, then soft-threshold (proximal L1)."""
    shrink = 1.0 - lr * reg * (1.0 - alpha)
    thr = lr * reg * alpha
    out = []
    for wi, gi in zip(w, g):
        v = wi * shrink - lr * gi
        if thr > 0.0:
            v = math.copysign(max(abs(v) - thr, 0.0), v) if v != 0.0 else 0.0
        out.append(v)
    return out


class _SvcParams(HasFeaturesCol, HasLabelCol, HasWeightCol, HasMaxIter, HasTol, HasPredictionCol):
    learningRate = Param(Params._dummy(), "learningRate", "step size", TypeConverters.toFloat)
    globalBatchSize = Param(Params._dummy(), "globalBatchSize", "rows per iteration",
                            TypeConverters.toInt)
    reg = Param(Params._dummy(), "reg", "regularization strength", TypeConverters.toFloat)
    elasticNet = Param(Params._dummy(), "elasticNet", "L1 share of the penalty, in [0, 1]",
                       TypeConverters.toFloat)
    idCol = Param(Params._dummy(), "idCol", "row key used to sample batches",
                  TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(maxIter=20, learningRate=0.1, globalBatchSize=32, tol=1e-6, reg=0.0,
                         elasticNet=0.0, featuresCol="features", labelCol="label",
                         predictionCol="prediction")

    def getLearningRate(self):
        return self.getOrDefault(self.learningRate)

    def getGlobalBatchSize(self):
        return self.getOrDefault(self.globalBatchSize)

    def getReg(self):
        return self.getOrDefault(self.reg)

    def getElasticNet(self):
        return self.getOrDefault(self.elasticNet)


class LinearSvc(Estimator, _SvcParams, DefaultParamsReadable, DefaultParamsWritable):
    """Weighted linear SVM with elastic net; fit takes exactly one table."""

    def __init__(self, **kwargs):
        super().__init__()
        self._set(**kwargs)

    def setParams(self, **kwargs):
        return self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> LinearSvcModel:
        weight = self.getOrDefault(self.weightCol) if self.isDefined(self.weightCol) else None
        key = self.getOrDefault(self.idCol) if self.isDefined(self.idCol) else None
        return self._train(dataset, weight or None, key)

    def _train(self, dataset: DataFrame, weight: str | None, key: str | None) -> LinearSvcModel:
        size = self.getGlobalBatchSize()
        plain = svc_rows(dataset, self.getFeaturesCol(), self.getLabelCol(), weight, key, hashed=True)
        data = _persisted(plain, sampled=True)
        try:
            d, n = require_training_table(data)
            batches = _Whole(data) if size >= n else Batches(data, size / n)
            lr, reg, alpha = self.getLearningRate(), self.getReg(), self.getElasticNet()
            w, prev_loss, losses = [0.0] * d, None, []
            for _ in range(self.getMaxIter()):
                g, loss, wsum, _ = batch_gradient(batches, w, "features", "label", "weight")
                if wsum <= 0.0:
                    raise ValueError("the weights of a batch sum to 0 or less")
                mean_loss = loss / wsum
                if prev_loss is not None and abs(prev_loss - mean_loss) < self.getTol():
                    break
                losses.append(mean_loss)
                prev_loss = mean_loss
                w = elastic_step(w, [gi / wsum for gi in g], lr, reg, alpha)
        finally:
            data.unpersist()
        model = LinearSvcModel(w, losses)
        model._resetUid(self.uid)
        return self._copyValues(model)


class LinearSvcModel(Model, _SvcParams, MLReadable, MLWritable):
    """The weights plus the estimator's params; transform predicts."""

    def __init__(self, coefficients: Sequence[float] | None = None, losses: Sequence[float] | None = None):
        super().__init__()
        self.coefficients = [float(v) for v in (coefficients or [])]
        self.losses = list(losses or [])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fcol = self.getFeaturesCol()
        dt = dataset.schema[fcol].dataType
        src = dataset
        if isinstance(dt, VectorUDT):
            src = dataset.withColumn("_x", vector_to_array(F.col(fcol)))
            fcol = "_x"
        out = predict(src, self.coefficients, fcol, self.getPredictionCol())
        return out.drop("_x") if fcol == "_x" else out

    def weights(self, spark) -> DataFrame:
        """The model table: (k int, w double)."""
        return spark.createDataFrame([(i, w) for i, w in enumerate(self.coefficients)],
                                     T.StructType([T.StructField("k", T.IntegerType()),
                                                   T.StructField("w", T.DoubleType())]))

    def write(self) -> MLWriter:
        return _SvcModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SvcModelReader(cls)


class _SvcModelWriter(MLWriter):
    """Params metadata plus the model table (k int, w double) at path/data."""

    def __init__(self, instance: LinearSvcModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"losses": self.instance.losses})
        self.instance.weights(self.sparkSession).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/data")


class _SvcModelReader(MLReader):
    """Restores the weights (one row per feature) and the params."""

    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LinearSvcModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.parquet(f"{path.rstrip('/')}/data").orderBy("k").collect()
        model = LinearSvcModel([r["w"] for r in rows], meta.get("losses"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
