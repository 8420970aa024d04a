"""Greedy information-theoretic feature selection.

``FeatureSelector`` is a Spark ML Estimator; ``FeatureSelectorModel`` keeps
the selected indices (sorted ascending) and slices feature columns.

One selection round is one Spark job over the persisted (x, y) table: count
cells against the last winner, derive (I(X_k;X_j), I(X_k;X_j|Y)) for every
feature, and fold them into the per-feature state (a small table, one row
per feature, written under the checkpoint folder each round so lineage
never grows).  Only the round's winner (one row) comes back to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.vectors import gather
from tessera.operators import bitslices as B
from tessera.operators import criteria as C
from tessera.operators import infotheory as I
from tessera.operators.checks import label_fault, vector_fault
from tessera.session import RoundTables, scratch_path

# Above this many features the per-round (k, mi, cmi) table is joined, not broadcast.
BROADCAST_FEATURE_LIMIT = 200_000
TIE_DIGITS = 10            # scores are ranked on round(score, 10), then by feature index


# ------------------------------------------------------------------ data sources

class DenseFeatures:
    """Persisted (x array<tinyint>, y tinyint) rows; every round re-scans them."""

    def __init__(self, df: DataFrame, x: str = "x", y: str = "y", n_partitions: int = 0,
                 check: bool = True):
        raw = df.selectExpr(f"{x} AS x", f"{y} AS y")
        # Bytes and the reason for a refusal are kept together, so the source is read once.
        fault = F.coalesce(label_fault("y", byte=True), vector_fault("x", byte=True)) if check else F.lit(None).cast("string")
        data = raw.select(F.expr("transform(x, v -> try_cast(v AS TINYINT)) AS x"),
                          F.expr("try_cast(y AS TINYINT) AS y"), fault.alias("fault"))
        if n_partitions:
            data = data.repartition(n_partitions)
        self.persisted = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.n_features = _one_dimension(data.agg(
                F.min("fault").alias("fault"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first())
        except ValueError:
            data.unpersist()
            raise
        self.data = data.select("x", "y")

    @property
    def spark(self) -> SparkSession:
        return self.data.sparkSession

    def cells(self, given: int | None) -> DataFrame:
        return I.dense_cells(self.data, given=given)

    def cells_many(self, given: list[int], only: list[int] | None = None) -> DataFrame:
        return I.dense_cells_many(self.data, given, only=only)

    def release(self) -> None:
        self.persisted.unpersist()


class BitSlicedFeatures(DenseFeatures):
    """The same rows as bitmaps per (feature, value, chunk of rows), persisted once: a round counts bits of ANDs."""

    def __init__(self, df: DataFrame, x: str = "x", y: str = "y", n_partitions: int = 0, check: bool = True):
        super().__init__(df, x, y, n_partitions, check)
        self.slices = B.bit_slices(self.data).persist(StorageLevel.MEMORY_AND_DISK)

    def cells(self, given: int | None) -> DataFrame:
        return B.cells(self.slices, [given]).drop("j")

    def cells_many(self, given: list[int], only: list[int] | None = None) -> DataFrame:
        return B.cells(self.slices, given, only)

    def release(self) -> None:
        self.slices.unpersist()
        super().release()


SPARSE_DENSITY = 0.5       # vector columns stored sparser than this take the sparse path


def _one_dimension(stats) -> int:
    """The one length of all vectors (0 without rows), or the table's fault."""
    if stats["fault"]:
        raise ValueError(f"a training row is refused: {stats['fault']} (features and labels must be integers of one byte)")
    if stats["low"] != stats["high"]:
        raise ValueError(f"feature vectors differ in dimension: from {stats['low']} to {stats['high']}")
    return int(stats["low"] or 0)


@dataclass
class VectorEntries:
    entries: DataFrame          # (id, y, k, v), stored non-zeros only
    rows: DataFrame             # (id, y), every row
    n_features: int
    density: float              # mean stored fraction of each vector


def vector_entries(df: DataFrame, features: str, label: str, id_col: str | None = None
                   ) -> VectorEntries:
    """Non-zero long form of a vector column, JVM-side, never densified.

    The vector's storage struct (``unwrap_udt``) is exploded, so the cost is
    linear in the stored values, not in the dimension.  The parse is written
    under the checkpoint folder with its row ids, so ids given by position
    (no ``id_col``) are the same whenever they are read.
    """
    idc = F.col(id_col).cast("bigint") if id_col else F.monotonically_increasing_id()
    path = scratch_path(df.sparkSession, "vector-entries")
    df.select(idc.alias("id"), F.col(label).alias("y"), F.unwrap_udt(F.col(features)).alias("p")).write.parquet(path)
    parsed = df.sparkSession.read.parquet(path)
    size = F.expr("CASE WHEN p.type = 0 THEN p.size ELSE size(p.values) END")
    fault = F.coalesce(label_fault("y", byte=True), vector_fault("x", byte=True))
    stats = parsed.select("*", F.col("p.values").alias("x")).agg(
        F.min(fault).alias("fault"), F.min(size).alias("low"), F.max(size).alias("high"),
        F.avg(F.expr("CASE WHEN p.type = 0 THEN size(p.values) / greatest(p.size, 1) ELSE 1.0 END")).alias("density")).first()
    n_features = _one_dimension(stats)
    entries = parsed.selectExpr(
        "id", "y", "explode(transform(p.values, (x, i) -> named_struct("
        "'k', CASE WHEN p.type = 0 THEN p.indices[i] ELSE i END, 'v', x))) AS e"
    ).selectExpr("id", "y", "e.k AS k", "e.v AS v").where("v <> 0")
    return VectorEntries(entries, parsed.select("id", "y"), n_features, float(stats["density"] or 0.0))


class SparseFeatures:
    """Non-zero entries (id, y, k, v) partitioned by row id, plus (id, y) for all rows."""

    def __init__(self, entries: DataFrame, rows: DataFrame, n_features: int,
                 n_partitions: int = 0, check: bool = True):
        v = F.col("v").cast("double")
        fault = (F.when(F.col("id").isNull() | F.col("k").isNull() | v.isNull(), "null entry").when(v == 0, "stored zero")
                 .when((F.col("k") < 0) | (F.col("k") >= n_features), "feature index")
                 .when((v % 1 != 0) | (v < -128) | (v > 127), "not a byte"))
        e = entries.select("id", F.col("k").cast("int").alias("k"), F.expr("try_cast(y AS TINYINT) AS y"),
                           F.expr("try_cast(v AS TINYINT) AS v"), F.coalesce(label_fault("y", byte=True), fault).alias("fault"))
        e = I.partition_entries(e, n_partitions or None)
        self.persisted = e.persist(StorageLevel.MEMORY_AND_DISK)
        if check:      # partitioned by id, so the pairs (id, k) are counted in place
            worst = e.groupBy("id", "k").agg(F.min("fault").alias("fault"), F.count(F.lit(1)).alias("n")) \
                .agg(F.min("fault").alias("fault"), F.max("n").alias("n")).first()
            if worst["fault"] or (worst["n"] or 0) > 1:
                e.unpersist()
                raise ValueError(f"an entry is refused: {worst['fault'] or 'repeated row and feature'}")
        self.entries = e.select("id", "y", "k", "v")
        self.rows = rows.select("id", F.col("y").cast("tinyint").alias("y")).persist(
            StorageLevel.MEMORY_AND_DISK)
        self.n_features = int(n_features)
        self.class_totals = I.class_totals(self.rows)      # once per fit (<= 256 classes)

    @property
    def spark(self) -> SparkSession:
        return self.entries.sparkSession

    def cells(self, given: int | None) -> DataFrame:
        return I.sparse_cell_parts(self.entries, self.rows, self.n_features, given,
                                   self.class_totals)

    def cells_many(self, given: list[int]) -> DataFrame:
        return I.sparse_cells_many(self.entries, self.rows, self.n_features, given,
                                   self.class_totals)

    def release(self) -> None:
        self.persisted.unpersist()
        self.rows.unpersist()


def training_rows(df: DataFrame, label: str = "label", features: str = "features",
                  keep: list[str] | None = None) -> DataFrame:
    """(keep..., label double, features) -- any numeric label is accepted (Q15)."""
    _check_label(df.schema, label)
    _feature_kind(df.schema, features)
    return df.select(*(keep or []), F.col(label).cast("double").alias("label"),
                     F.col(features).alias("features"))


# ------------------------------------------------------------------- algorithm

@dataclass
class Selection:
    features: list[int]          # in selection order
    scores: list[float]

    @property
    def sorted_features(self) -> list[int]:
        return sorted(self.features)


def relevance_table(source) -> DataFrame:
    """(k, rel) for every feature."""
    return I.information(source.cells(None)).select("k", "rel")


def winners(state: DataFrame, score_sql: str) -> dict[str, tuple[int, float]]:
    """A6 per criterion as one aggregate: max of (round(score, 10), -k).

    Partial aggregation keeps one candidate per criterion per task; one row
    per criterion reaches the driver.
    """
    rows = state.where("valid").groupBy("crit").agg(F.expr(
        f"max(struct(round({score_sql}, {TIE_DIGITS}) AS r, -k AS nk, {score_sql} AS s, k)) AS b"
    )).collect()
    return {r["crit"]: (int(r["b"]["k"]), float(r["b"]["s"])) for r in rows if r["b"] is not None}


def greedy_select_many(source, criteria: list[str], n: int = 10,
                       beta: float = C.DEFAULT_BETA) -> dict[str, Selection]:
    """E1 for several criteria in lockstep: one Spark job per round for all of them.

    Round i: the argmax per criterion over the state (one aggregate), then
    one pass over the data counts cells against every criterion's winner
    at once (``cells_many``) and folds (I(X_k;X_j), I(X_k;X_j|Y)) into each
    criterion's state.  The state (criteria x features rows) is written as a
    small table under the session's checkpoint folder every round, so the
    lineage never grows and a lost executor never costs a finished round.
    Q1: exactly n features; Q3: n is clamped to the number of features.
    """
    crits = list(dict.fromkeys(C.check_criterion(c) for c in criteria))
    n = max(0, min(int(n), source.n_features))
    out: dict[str, Selection] = {}
    if n == 0:
        return {c: Selection([], []) for c in crits}
    rel_tables = RoundTables(source.spark, "relevance")
    rel = rel_tables.put(relevance_table(source))
    looped = [c for c in crits if c != "mim"]
    try:
        if "mim" in crits:   # T2 / Q2: global top n by relevance
            top = (rel.orderBy(F.round("rel", TIE_DIGITS).desc(), F.col("k").asc())
                   .limit(n).collect())
            out["mim"] = Selection([int(r["k"]) for r in top], [float(r["rel"]) for r in top])
        if looped:
            out.update(_greedy_loop(source, rel, looped, n, beta))
    finally:
        rel_tables.close()
    return {c: out[c] for c in crits}


def _greedy_loop(source, rel: DataFrame, crits: list[str], n: int, beta: float) -> dict[str, Selection]:
    broadcast_ok = source.n_features * len(crits) <= BROADCAST_FEATURE_LIMIT
    tables = RoundTables(rel.sparkSession, "selection-state")
    picked = {c: ([], []) for c in crits}
    try:
        state = tables.put(C.initial_states(rel, crits))
        for i in range(n):
            best = winners(state, C.score_case_sql(crits, i, beta))
            for c, (j, sc) in best.items():
                picked[c][0].append(j)
                picked[c][1].append(sc)
            if i == n - 1 or not best:
                break
            given = sorted({j for j, _ in best.values()})
            info = I.information(source.cells_many(given), keys=("j", "k")).select(
                "j", "k", "mi", "cmi")
            state = tables.put(C.update_many(
                state, info, {c: j for c, (j, _) in best.items()}, broadcast_ok))
    finally:
        tables.close()
    return {c: Selection(f, s) for c, (f, s) in picked.items()}


def greedy_select(source, criterion: str = C.DEFAULT_CRITERION, n: int = 10,
                  beta: float = C.DEFAULT_BETA) -> Selection:
    """Forward selection of ``n`` features by one criterion."""
    return greedy_select_many(source, [criterion], n, beta)[C.check_criterion(criterion)]


LAZY_CRITERIA = ("icap", "cmim", "if")
LAZY_BATCH = 16            # stale features that one job brings up to date


@dataclass
class LazySelection(Selection):
    evaluated: int               # (feature, winner) pairs whose measures were counted
    eager: int                   # pairs that counting every feature in every round takes


def lazy_select(source, criterion: str, n: int = 10, batch: int = LAZY_BATCH) -> LazySelection:
    """E1 for icap, cmim and if, counting only features that may win.

    Their scores never rise as the set grows (icap from the relevance on, cmim and if from the first
    winner on), so a score that misses the last winners is an upper bound.  A round brings the
    features of the highest bounds up to date, ``batch`` at a time, until one that is up to date
    stands first; in the order used for ties no other can pass it.  The picks and scores are
    those of ``greedy_select``.  The state, with the number of winners each feature has been
    counted against, is a table under the checkpoint folder; only the first ``batch`` rows
    come to the driver.
    """
    crit = C.check_criterion(criterion)
    if crit not in LAZY_CRITERIA:
        raise ValueError(f"only {', '.join(LAZY_CRITERIA)} can be bounded, not {crit}")
    n = max(0, min(int(n), source.n_features))
    won, scores, evaluated = [], [], 0
    tables = RoundTables(source.spark, "lazy-selection")
    try:
        state = tables.put(C.initial_state(relevance_table(source)).withColumn("seen", F.lit(0))) if n else None
        while len(won) < n:
            bound = C.lazy_bound_sql(crit) if won else "rel"
            order = [F.expr(f"round({bound}, {TIE_DIGITS})").desc(), F.col("k").asc()]
            top = state.where("valid").select("k", "seen", F.expr(bound).alias("bound")).orderBy(*order).limit(batch).collect()
            if not won or top[0]["seen"] == len(won):
                won.append(int(top[0]["k"]))
                scores.append(float(top[0]["bound"]))
                state = state.withColumn("valid", F.col("valid") & (F.col("k") != won[-1]))
                continue
            stale = {int(r["k"]): r["seen"] for r in top if r["seen"] < len(won)}
            # Without an upper bound yet (cmim, if before the first winner) every feature is counted.
            every = any(r["bound"] == float("inf") for r in top)
            since = min(stale.values())
            given = won[since:]
            info = I.information(source.cells_many(given, None if every else sorted(stale)), keys=("j", "k")).select("j", "k", "mi", "cmi")
            state = tables.put(C.update_lazily(state, info, won))
            evaluated += (source.n_features - len(won)) * len(given) if every else sum(len(won) - s for s in stale.values())
    finally:
        tables.close()
    eager = sum(source.n_features - i for i in range(1, n))
    return LazySelection(won, scores, evaluated, eager)


def selection_frame(spark: SparkSession, sel: Selection) -> DataFrame:
    """(rank int, feat int, score double) in selection order (n rows)."""
    rows = [(i + 1, f, s) for i, (f, s) in enumerate(zip(sel.features, sel.scores))]
    return spark.createDataFrame(rows, "rank int, feat int, score double")


# --------------------------------------------------------------------- reports

def format_score(col: Column) -> Column:
    return F.format_string("%.4f", col)


def maxrel_report(rel: DataFrame, n: int) -> DataFrame:
    """Top n by relevance; 1-based feature, score as %.4f text."""
    top = rel.orderBy(F.round("rel", TIE_DIGITS).desc(), F.col("k").asc()).limit(n)
    return top.select((F.col("k") + 1).alias("feature"), format_score(F.col("rel")).alias("score"))


def selected_report(selection: DataFrame) -> DataFrame:
    """Selected features by score desc; 1-based feature, %.4f score."""
    ordered = selection.orderBy(F.round("score", TIE_DIGITS).desc(), F.col("feat").asc())
    return ordered.select((F.col("feat") + 1).alias("feature"),
                          format_score(F.col("score")).alias("score"))


def sorted_selection(spark: SparkSession, features: list[int]) -> DataFrame:
    """(pos, feat) ascending by feature index."""
    ordered = sorted(int(f) for f in features)
    if ordered != sorted(set(ordered)):
        raise ValueError("selected features must be distinct")
    return spark.createDataFrame([(i, f) for i, f in enumerate(ordered)], "pos int, feat int")


# ---------------------------------------------------------------- slicing

def slice_dense(df: DataFrame, col: str, indices: list[int], out: str) -> DataFrame:
    """P10: keep ``indices`` of an array column, in index order."""
    return df.withColumn(out, gather(col, sorted(indices)))


def slice_sparse_entries(entries: DataFrame, indices: list[int]) -> DataFrame:
    """P11 on the long form (id, k, v): keep k in ``indices``; renumber to 0..m-1.

    The keep list has one row per selected feature (bounded by the selection
    size), so the join broadcasts it.
    """
    spark = entries.sparkSession
    keep = spark.createDataFrame([(int(k), i) for i, k in enumerate(sorted(set(indices)))],
                                 "k int, new_k int")
    return entries.join(F.broadcast(keep), "k").drop("k").withColumnRenamed("new_k", "k")


# ------------------------------------------------------------------- estimator

class _SelectorParams(HasFeaturesCol, HasOutputCol, HasLabelCol):
    selectCriterion = Param(Params._dummy(), "selectCriterion",
                            "criterion: mim, mifs, jmi, mrmr, icap, cmim or if",
                            typeConverter=TypeConverters.toString)
    numTopFeatures = Param(Params._dummy(), "numTopFeatures",
                           "number of features to select (>= 1); all if fewer exist",
                           typeConverter=TypeConverters.toInt)
    nPartitions = Param(Params._dummy(), "nPartitions",
                        "partitions for the persisted training rows (0 = leave to Spark)",
                        typeConverter=TypeConverters.toInt)
    beta = Param(Params._dummy(), "beta", "redundancy weight of mifs",
                 typeConverter=TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(selectCriterion=C.DEFAULT_CRITERION, numTopFeatures=25, nPartitions=0,
                         beta=C.DEFAULT_BETA, featuresCol="features", labelCol="label",
                         outputCol="selectedFeatures")

    def getSelectCriterion(self) -> str:
        return self.getOrDefault(self.selectCriterion)

    def getNumTopFeatures(self) -> int:
        return self.getOrDefault(self.numTopFeatures)

    def getNPartitions(self) -> int:
        return self.getOrDefault(self.nPartitions)

    def getBeta(self) -> float:
        return self.getOrDefault(self.beta)

    def _validate(self) -> None:
        C.check_criterion(self.getSelectCriterion())
        if self.getNumTopFeatures() < 1:
            raise ValueError("numTopFeatures must be >= 1")
        if self.getNPartitions() < 0:
            raise ValueError("nPartitions must be >= 0")


def _feature_kind(schema: T.StructType, col: str) -> str:
    """P7: 'vector' or 'array'; anything else is rejected."""
    if col not in schema.fieldNames():
        raise ValueError(f"column {col!r} not found")
    dt = schema[col].dataType
    if isinstance(dt, VectorUDT):
        return "vector"
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.NumericType):
        return "array"
    raise TypeError(f"column {col!r} must be a vector or a numeric array, got {dt.simpleString()}")


def _check_label(schema: T.StructType, col: str) -> None:
    if col not in schema.fieldNames():
        raise ValueError(f"column {col!r} not found")
    if not isinstance(schema[col].dataType, T.NumericType):   # Q15: any numeric label
        raise TypeError(f"label column {col!r} must be numeric")


def _check_output(df: DataFrame, col: str) -> None:
    """The output column must be new."""
    if col in df.columns:
        raise ValueError(f"the table already has a column {col!r}; choose another outputCol")


class FeatureSelector(Estimator, _SelectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """E2/E3 Estimator.  ``fit`` runs the greedy selection on Spark."""

    def __init__(self, *, selectCriterion=None, numTopFeatures=None, nPartitions=None, beta=None,
                 featuresCol=None, labelCol=None, outputCol=None):
        super().__init__()
        kw = {k: v for k, v in dict(selectCriterion=selectCriterion, numTopFeatures=numTopFeatures,
                                    nPartitions=nPartitions, beta=beta, featuresCol=featuresCol,
                                    labelCol=labelCol, outputCol=outputCol).items() if v is not None}
        self._set(**kw)

    def setSelectCriterion(self, v: str):
        return self._set(selectCriterion=v)

    def setNumTopFeatures(self, v: int):
        return self._set(numTopFeatures=v)

    def setNPartitions(self, v: int):
        return self._set(nPartitions=v)

    def setBeta(self, v: float):
        return self._set(beta=v)

    def setFeaturesCol(self, v: str):
        return self._set(featuresCol=v)

    def setLabelCol(self, v: str):
        return self._set(labelCol=v)

    def setOutputCol(self, v: str):
        return self._set(outputCol=v)

    def _fit(self, dataset: DataFrame) -> FeatureSelectorModel:
        self._validate()
        fcol, lcol = self.getFeaturesCol(), self.getLabelCol()
        kind = _feature_kind(dataset.schema, fcol)
        _check_output(dataset, self.getOutputCol())
        rows = training_rows(dataset, lcol, fcol)
        if kind == "vector":
            ve = vector_entries(rows, "features", "label")
            if ve.density < SPARSE_DENSITY:    # A13 path: only stored non-zeros are counted
                return self._finish(SparseFeatures(ve.entries, ve.rows, ve.n_features, self.getNPartitions()))
        x = vector_to_array(F.col("features")) if kind == "vector" else F.col("features")
        rows = rows.select(x.alias("x"), F.col("label").alias("y"))
        return self._finish(DenseFeatures(rows, n_partitions=self.getNPartitions()))

    def _finish(self, source) -> FeatureSelectorModel:
        try:
            sel = greedy_select(source, self.getSelectCriterion(), self.getNumTopFeatures(),
                                self.getBeta())
        finally:
            source.release()
        model = FeatureSelectorModel(sel.sorted_features, sel.features, sel.scores)
        model._resetUid(self.uid)
        return self._copyValues(model)

    def fit_sparse(self, entries: DataFrame, rows: DataFrame, n_features: int) -> FeatureSelectorModel:
        """A13 path: non-zero long form (id, y, k, v) plus all rows (id, y)."""
        self._validate()
        return self._finish(SparseFeatures(entries, rows, n_features, self.getNPartitions()))


class FeatureSelectorModel(Model, _SelectorParams, MLReadable, MLWritable):
    """Keeps the selected indices (ascending) and slices feature columns."""

    def __init__(self, selectedFeatures: list[int] | None = None,
                 selectionOrder: list[int] | None = None, selectionScores: list[float] | None = None):
        super().__init__()
        self.fitted = selectedFeatures is not None
        sel = [int(i) for i in (selectedFeatures or [])]
        if sel != sorted(sel):
            raise ValueError("selected features must be sorted ascending")
        self.selectedFeatures = sel
        self.selectionOrder = list(selectionOrder or [])
        self.selectionScores = list(selectionScores or [])

    def setFeaturesCol(self, v: str):
        return self._set(featuresCol=v)

    def setOutputCol(self, v: str):
        return self._set(outputCol=v)

    def setLabelCol(self, v: str):
        return self._set(labelCol=v)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if not self.fitted:
            raise RuntimeError("transform before fit: this selector model holds no features")
        fcol, out = self.getFeaturesCol(), self.getOutputCol()
        kind = _feature_kind(dataset.schema, fcol)
        _check_output(dataset, out)
        meta = _output_metadata(dataset.schema[fcol].metadata, self.selectedFeatures, out)
        if kind == "vector":       # dense or sparse vectors; nominal attributes unless the input has some
            sliced = VectorSlicer(inputCol=fcol, outputCol=out, indices=self.selectedFeatures).transform(dataset)
            return sliced.withMetadata(out, meta)
        return dataset.withColumn(out, gather(fcol, self.selectedFeatures).alias(out, metadata=meta))

    def selection(self, spark: SparkSession) -> DataFrame:
        return selection_frame(spark, Selection(self.selectionOrder, self.selectionScores))

    def report(self, spark: SparkSession) -> DataFrame:
        """S13 for this fit: (feature 1-based, score %.4f) by score descending."""
        return selected_report(self.selection(spark))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)

    def copy(self, extra=None):
        that = FeatureSelectorModel(self.selectedFeatures, self.selectionOrder, self.selectionScores)
        that._resetUid(self.uid)
        return self._copyValues(that, extra)


def _output_metadata(in_meta: dict, selected: list[int], name: str) -> dict:
    """Carry per-feature attributes of the kept indices; nominal defaults otherwise."""
    attrs = (in_meta or {}).get("ml_attr", {}).get("attrs")
    if attrs:
        by_idx = {}
        for kind, lst in attrs.items():
            for a in lst:
                by_idx[a["idx"]] = (kind, a)
        kept: dict = {}
        for new_i, old_i in enumerate(selected):
            if old_i in by_idx:
                kind, a = by_idx[old_i]
                kept.setdefault(kind, []).append({**a, "idx": new_i})
        return {"ml_attr": {"attrs": kept, "num_attrs": len(selected), "name": name}}
    nominal = [{"idx": i, "type": "nominal"} for i in range(len(selected))]
    return {"ml_attr": {"attrs": {"nominal": nominal}, "num_attrs": len(selected), "name": name}}


class _ModelWriter(MLWriter):
    """Params metadata plus one parquet row ``selectedFeatures array<int>`` at path/data."""

    def __init__(self, instance: FeatureSelectorModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        extra = {"selectionOrder": self.instance.selectionOrder,
                 "selectionScores": self.instance.selectionScores}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=extra)
        df = self.sparkSession.createDataFrame([(self.instance.selectedFeatures,)],
                                               "selectedFeatures array<int>")
        df.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/data")


class _ModelReader(MLReader):
    """Restore indices and params."""

    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FeatureSelectorModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        row = self.sparkSession.read.parquet(f"{path.rstrip('/')}/data").select(
            "selectedFeatures").head()
        model = FeatureSelectorModel(list(row[0]), meta.get("selectionOrder"),
                                     meta.get("selectionScores"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
