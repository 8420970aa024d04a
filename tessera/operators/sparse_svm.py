"""Linear SVM over sparse rows (P3, A14, E7, E8, P16): weights as a table, nothing of the model's length anywhere.

The training rows are written once, in blocks of about ``BLOCK`` non-zeros, a table row each.  A block
names its distinct features and keeps its non-zeros as positions in them.  An iteration

* sends every block the non-zero weights of the features it names, once per block and feature
  (one equi-join on the feature, one grouping by block; a block bounds what is gathered);
* forms, inside the block, the rows' margins and one partial gradient over the named features;
* adds up the partial gradients by feature, pre-aggregated, and updates the weight table.

A feature that occurs in every row adds one row per block, however many rows there are, and
long rows are spread as their blocks are.  The persisted blocks are partitioned by block, so an
iteration shuffles pairs of block and feature, never the non-zeros.  Only the sums of loss, weight and rows
(and two norms) reach the driver.

The recurrences, defaults and batches are those of ``tessera.operators.svm``: ``sgd`` equals
``sgd_svm``, ``svc`` the training of ``LinearSvc``, weight by weight.

Input.  Vector columns are read through their storage struct; dense vectors and arrays are taken
too, their zeros are not stored.  Labels are 0 or 1; vectors have no null and one common size,
checked while the blocks are written.  A table without rows is an error, as in the dense form.
Features without a weight in the table have weight 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators import svm as SV
from tessera.operators.checks import check_training, training_metrics, vector_fault
from tessera.operators.split import HASH_SPACE, key_hash
from tessera.session import RoundTables, scratch_path

BLOCK = 1 << 16
_BLOCKS = ("block bigint, id array<bigint>, y array<double>, wt array<double>, h array<bigint>, "
           "ends array<int>, ks array<int>, at array<int>, x array<double>")
_ROW = ("id", "y", "wt", "h")
LOSS, WEIGHT, ROWS = -1, -2, -3           # keys of the totals among the gradient's features


def sparse_parts(df: DataFrame, features: str) -> DataFrame:
    """All columns, with ``_ks`` (positions), ``_x`` (values) and ``_size`` of a vector or array column."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        parts = df.withColumn("_p", F.unwrap_udt(F.col(features)))
        parts = parts.withColumn("_x", F.col("_p.values"))
        return parts.withColumn("_size", F.expr("CASE WHEN _p.type = 0 THEN _p.size ELSE size(_p.values) END")) \
            .withColumn("_ks", F.expr("CASE WHEN _p.type = 0 THEN _p.indices ELSE transform(_x, (v, i) -> i) END")).drop("_p")
    parts = df.withColumn("_x", F.col(features).cast("array<double>"))
    return parts.withColumn("_size", F.when(F.col("_x").isNotNull(), F.size("_x"))).withColumn("_ks", F.expr("transform(_x, (v, i) -> i)"))


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column; nulls inside become NaN."""
    return col.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(col.value_lengths().fill_null(0).to_numpy())).astype(np.int64)


def _cut(block: int):
    """Rows -> blocks: rows that begin in the same stretch of ``block`` non-zeros of their batch."""
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ks, off = _flat(batch.column("_ks"))
            x, _ = _flat(batch.column("_x"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(off))
            kept = x != 0
            ks, x, row = ks[kept].astype(np.int32), x[kept], row[kept]
            off = np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows)))
            cuts = np.append(np.flatnonzero(np.diff(off[:-1] // block, prepend=-1)), batch.num_rows)
            for a, b in zip(cuts[:-1], cuts[1:]):
                named, at = np.unique(ks[off[a]:off[b]], return_inverse=True)
                lists = {name: batch.column(name).slice(a, b - a) for name in _ROW}
                lists |= {"ends": pa.array((off[a + 1:b + 1] - off[a]).astype(np.int32)), "ks": pa.array(named.astype(np.int32)),
                          "at": pa.array(at.astype(np.int32)), "x": pa.array(x[off[a]:off[b]])}
                whole = {name: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for name, v in lists.items()}
                yield pa.record_batch({"block": pa.array([(part << 33) + number]), **whole})
                number += 1
    return run


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Blocks of rows (id, y, wt, h, _ks, _x)."""
    return rows.select(*_ROW, "_ks", "_x").mapInArrow(_cut(block), _BLOCKS)


def training_blocks(df: DataFrame, features: str, label: str, weight: str | None, key: str | None, tables: RoundTables,
                    block: int = BLOCK) -> tuple[DataFrame, int]:
    """(blocks, common size of the vectors); the checks ride on the write."""
    parts = sparse_parts(df, features)
    rows = parts.select(F.lit(0).cast("bigint").alias("id"), F.col(label).cast("double").alias("y"),
                        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("wt"),
                        (key_hash([key]) if key else F.lit(0).cast("bigint")).alias("h"), "_ks", "_x", "_size")
    seen = Observation()
    blocks = tables.put(_blocks(rows.observe(seen, *training_metrics("_x", "y", size="_size")), block))
    d, _ = check_training(seen.get)
    return blocks, d


def _with_weights(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """Blocks with ``have``: the (k, w) of the features they name, where w is not 0."""
    named = blocks.select("block", F.explode("ks").alias("k"))
    have = named.join(weights.where("w <> 0").select("k", "w"), "k").groupBy("block").agg(F.collect_list(F.struct("k", "w")).alias("have"))
    have = have.select("block", F.col("have.k").alias("have_k"), F.col("have.w").alias("have_w"))
    return blocks.join(have, "block", "left").drop("block")


def _each(batch: pa.RecordBatch):
    """Per block: its lists as arrays by name, the row of every non-zero, the rows' margins."""
    for c in range(batch.num_rows):
        b = {}
        for name in batch.schema.names:
            cell = batch.column(name)[c]
            b[name] = cell.values.to_numpy(zero_copy_only=False) if cell.is_valid else np.empty(0)
        row = np.repeat(np.arange(len(b["y"])), np.diff(b["ends"], prepend=0))
        w = np.zeros(len(b["ks"]))
        w[np.searchsorted(b["ks"], b["have_k"])] = b["have_w"]
        yield b, row, np.bincount(row, b["x"] * w[b["at"]], minlength=len(b["y"]))


def _gradient(start: int, width: int):
    """Blocks with weights -> partial sums (k, g) over the rows whose hash lies in the interval, which may run over the end of the circle."""
    def run(batches):
        for batch in batches:
            for b, row, m in _each(batch):
                mine = (b["h"] - start) % HASH_SPACE < width
                s, wt = 2.0 * b["y"] - 1.0, b["wt"]
                coef = np.where(mine & (s * m < 1.0), -wt * s, 0.0)
                g = np.bincount(b["at"], coef[row] * b["x"], minlength=len(b["ks"]))
                some = np.flatnonzero(g)
                totals = [(wt * np.maximum(0.0, 1.0 - s * m))[mine].sum(), wt[mine].sum(), mine.sum()]
                yield pa.record_batch({"k": pa.array(np.append(b["ks"][some], [LOSS, WEIGHT, ROWS]).astype(np.int32)),
                                       "g": pa.array(np.append(g[some], totals).astype(np.float64))})
    return run


def _margins(batches):
    for batch in batches:
        for b, _, m in _each(batch):
            yield pa.record_batch({"id": pa.array(b["id"].astype(np.int64)), "margin": pa.array(m.astype(np.float64))})


def sparse_gradient(blocks: DataFrame, weights: DataFrame, start: int = 0, width: int = HASH_SPACE) -> DataFrame:
    """(k, g), the sum of hinge subgradients by feature, and the totals under LOSS, WEIGHT and ROWS."""
    return _with_weights(blocks, weights).mapInArrow(_gradient(start, width), "k int, g double").groupBy("k").agg(F.sum("g").alias("g"))


class _Training:
    """The blocks of a table, its weight table and the sums of a round, all under the checkpoint folder."""

    def __init__(self, df: DataFrame, features: str, label: str, weight: str | None, key: str | None, block: int):
        spark = df.sparkSession
        self.store, self.sums, self.rounds = (RoundTables(spark, f"sparse-svm-{name}") for name in ("blocks", "sums", "weights"))
        self.blocks = None
        try:
            stored, self.d = training_blocks(df, features, label, weight, key, self.store, block)
        except Exception:
            self.close()
            raise
        self.blocks = stored.repartition("block").sortWithinPartitions("block").persist(StorageLevel.MEMORY_AND_DISK)
        self.weights = spark.createDataFrame([], "k int, w double, old double")

    def rows(self) -> int:
        return self.blocks.agg(F.sum(F.size("y"))).first()[0]

    def gradient(self, batches: SV.Batches | None) -> tuple[DataFrame, float, float, float]:
        """(gradient by feature, loss, weight, rows) of the next batch, which is not empty."""
        out = self._sums(batches)
        if out[3] == 0 and batches:
            batches.skip()
            out = self._sums(batches)
        if out[3] == 0:
            raise ValueError("an empty batch")
        if batches:
            batches.step()
        return out

    def _sums(self, batches: SV.Batches | None) -> tuple[DataFrame, float, float, float]:
        interval = (batches.at, batches.width) if batches else (0, HASH_SPACE)
        table = self.sums.put(sparse_gradient(self.blocks, self.weights, *interval))
        total = {r["k"]: r["g"] for r in table.where("k < 0").collect()}                 # three rows
        return table.where("k >= 0"), total[LOSS], total[WEIGHT], total[ROWS]

    def update(self, gradient: DataFrame, new: str) -> None:
        """The next weight table; ``new`` is the SQL text of a weight from ``w`` and ``g``."""
        both = self.weights.select("k", "w").join(gradient, "k", "full")
        both = both.selectExpr("k", "coalesce(w, 0.0D) AS w", "coalesce(g, 0.0D) AS g")
        self.weights = self.rounds.put(both.selectExpr("k", f"{new} AS w", "w AS old").where("w <> 0 OR old <> 0"))

    def batches(self, fraction: float) -> SV.Batches:
        return SV.Batches(self.blocks.select(F.explode("h").alias("_hash")), fraction)

    def close(self) -> None:
        """Everything but the last weight table, which the result reads."""
        if self.blocks is not None:
            self.blocks.unpersist()
        self.store.close()
        self.sums.close()

    def result(self) -> DataFrame:
        return self.weights.select("k", "w").where("w <> 0")


def sgd(df: DataFrame, iterations: int, step: float = SV.SGD_STEP, reg: float = SV.SGD_REG, fraction: float = SV.SGD_FRACTION,
        tol: float = SV.SGD_TOL, features: str = "features", label: str = "label", key: str | None = None,
        block: int = BLOCK) -> tuple[DataFrame, int]:
    """(weights (k, w) that are not 0, size of the vectors); ``fraction`` < 1 draws batches by hash of ``key``."""
    _require_key(fraction, key)
    run = _Training(df, features, label, None, key, block)
    try:
        batches = run.batches(fraction) if fraction < 1.0 else None
        for i in range(1, int(iterations) + 1):
            g, _, _, n = run.gradient(batches)
            st = step / math.sqrt(i)
            run.update(g, f"w * (1.0D - {SV._d(st * reg)}) - {SV._d(st)} * g / {SV._d(n)}")
            moved, size = run.weights.selectExpr("sqrt(coalesce(sum((w - old) * (w - old)), 0.0D))", "sqrt(coalesce(sum(w * w), 0.0D))").first()
            if moved < tol * max(size, 1.0):
                break
        return run.result(), run.d
    finally:
        run.close()


def svc(df: DataFrame, iterations: int = 20, lr: float = 0.1, batch: int | None = None, tol: float = 1e-6, reg: float = 0.0, alpha: float = 0.0,
        features: str = "features", label: str = "label", weight: str | None = None, key: str | None = None,
        block: int = BLOCK) -> tuple[DataFrame, int]:
    """(weights (k, w) that are not 0, size of the vectors) by the rule of ``LinearSvc``; ``batch`` rows an iteration (null: all)."""
    _require_key(0.0 if batch else 1.0, key)
    run = _Training(df, features, label, weight, key, block)
    try:
        n = run.rows() if batch else 0
        batches = run.batches(batch / n) if batch and batch < n else None
        shrink, cut, before = SV._d(1.0 - lr * reg * (1.0 - alpha)), SV._d(lr * reg * alpha), None
        for _ in range(int(iterations)):
            g, loss, wsum, _ = run.gradient(batches)
            if wsum <= 0.0:
                raise ValueError("the weights of a batch sum to 0 or less")
            if before is not None and abs(before - loss / wsum) < tol:
                break
            before = loss / wsum
            moved = f"(w * {shrink} - {SV._d(lr)} * (g / {SV._d(wsum)}))"
            run.update(g, f"signum({moved}) * greatest(abs({moved}) - {cut}, 0.0D)" if lr * reg * alpha > 0.0 else moved)
        return run.result(), run.d
    finally:
        run.close()


def _require_key(fraction: float, key: str | None) -> None:
    if fraction < 1.0 and key is None:
        raise ValueError("batches of sparse rows are drawn by the hash of a key column")


def predict(df: DataFrame, weights: DataFrame, dim: int, features: str = "features", out: str = "prediction", threshold: float = 0.0) -> DataFrame:
    """All columns and 1.0 where w . x > threshold, else 0.0; null for a null vector, a null element or another size.

    The rows are written once with a number each, so blocks and rows agree whenever they are read.
    """
    number = "_row"
    while number in df.columns:
        number += "_"
    path = scratch_path(df.sparkSession, "sparse-svm-rows")
    df.withColumn(number, F.monotonically_increasing_id()).write.parquet(path)
    rows = sparse_parts(df.sparkSession.read.parquet(path), features)
    good = rows.where(vector_fault("_x").isNull() & (F.col("_size") == dim))
    blocks = scratch_path(df.sparkSession, "sparse-svm-blocks")
    _blocks(good.select(F.col(number).alias("id"), F.lit(0.0).alias("y"), F.lit(1.0).alias("wt"), F.lit(0).cast("bigint").alias("h"), "_ks", "_x"), BLOCK) \
        .write.parquet(blocks)
    margins = _with_weights(df.sparkSession.read.parquet(blocks), weights).mapInArrow(_margins, "id bigint, margin double")
    found = margins.select(F.col("id").alias(number), F.expr(f"CAST(margin > {SV._d(threshold)} AS DOUBLE)").alias(out))
    kept = [c for c in df.columns if c.lower() != out.lower()]
    return df.sparkSession.read.parquet(path).select(number, *kept).join(found, number, "left").select(*kept, out)
