"""Toxicity scores from a character n-gram linear classifier with naive Bayes features.

Texts are lower-cased, ASCII other than letters and digits counts as a space; their distinct character n-grams (lengths NGRAMS) are hashed to
2^DIM_BITS features.  A feature's value is its naive Bayes log-count ratio
log((p / |p|) / (q / |q|)), p and q being the smoothed numbers of toxic and other training
documents that contain it.  Logistic regression on these values gives the weights.

Training.  The labelled rows are sampled by a hash of their id to about TRAIN_ROWS (the
documented bound; all are used while there are fewer).  Counts are combined in the tasks.
The sample is stored, and its rows are dealt by a hash of their place in the stored table into
groups of about GROUP_ROWS rows (rows that repeat an id are dealt like any others); every group
is fitted in a task of its own and the weights are averaged, so no task holds more than a group and
TRAIN_ROWS may be raised freely.  No feature is left out: a ratio of z standard errors is shrunk by
the factor 1 / (1 + (SIGMAS / z)^8), so what chance alone explains weighs little; the
2^DIM_BITS of the hash bound what is broadcast.

Scoring reads every whole text once, without a shuffle.

Defined cases.  Null and empty texts have no features; their score is the bias alone.
Without labelled rows of both kinds the score is the share of toxic rows (0 without any).
Labels with a null id or value are left out; an id with several labels is toxic if one of
them is.  A null document id is not held out.  Repeated rows are scored each by itself.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import tokens as T
from tessera.session import scratch_path

NGRAMS = (4, 5)
DIM_BITS = 18
TRAIN_ROWS = 24_000
GROUP_ROWS = 2_000
SMOOTHING = 1.0
SIGMAS = 4.0
L2 = 3e-4
_CHUNK = 1 << 18          # bytes of text whose n-grams are held at a time
STEPS = 100
RATE = 0.04

_GAPS = np.array([not chr(c).isalnum() for c in range(128)])


def grams(col: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct n-grams, by row; of the features marked in `used` only."""
    texts = [(t or "").lower() for t in col.to_pylist()]
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where((code < 128) & _GAPS[np.minimum(code, 127)], np.uint32(32), code)
    row = np.repeat(np.arange(len(texts)), np.diff(off))
    found = []
    for n in NGRAMS:
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n, np.uint32)
        for k in range(n):
            h = h * np.uint32(0x01000193) ^ code[k:len(code) - n + 1 + k] * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h = (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - DIM_BITS)
        inside = row[:len(h)] == row[n - 1:]
        if used is not None:
            inside &= used[h]
        mine = row[:len(h)][inside]
        found.append((h[inside], np.searchsorted(mine, np.arange(len(texts) + 1))))
    last, each = np.empty(1 << DIM_BITS, np.int64), []              # place where a feature was last put
    for i in range(len(texts)):
        f = np.concatenate([h[at[i]:at[i + 1]] for h, at in found]) if found else np.empty(0, np.uint32)
        places = np.arange(len(f))
        last[f] = places
        each.append(f[last[f] == places])                           # of equal features the last one
    sizes = [len(f) for f in each]
    return np.repeat(np.arange(len(texts)), sizes), np.concatenate(each).astype(np.int64) if each else np.empty(0, np.int64)


def _counts(batches):
    """Per task: feature, documents that contain it by label; feature -1 counts the documents."""
    size = 1 << DIM_BITS
    total, docs = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
    for part in T.chunks(batches, limit=_CHUNK):
        y = part.column(0).to_numpy().astype(np.int64)
        row, f = grams(part.column(1))
        total += np.bincount(y[row] * size + f, minlength=2 * size).reshape(2, size)
        docs += np.bincount(y, minlength=2)
    have = np.flatnonzero(total.any(axis=0))
    yield pa.record_batch({"f": pa.array(np.append(have, -1)), "other": pa.array(np.append(total[0][have], docs[0])), "toxic": pa.array(np.append(total[1][have], docs[1]))})


def _fit(ratio: np.ndarray):
    """Logistic regression of one group on the naive Bayes values (Adam on all rows)."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        used = ratio != 0
        y = frame["y"].to_numpy(float)
        parts, at, have = [], 0, np.zeros(len(ratio), bool)          # a part's rows are no other's: what a step holds is bounded by a part
        for part in T.chunks([pa.record_batch({"text": pa.array(frame["text"], pa.string())})], limit=_CHUNK):
            r, f = grams(part.column(0), used)
            if len(r):
                starts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))            # r ascends
                parts.append(((r + at).astype(np.int32), f.astype(np.int32), starts))
                have[f] = True
            at += part.num_rows
        ids = np.flatnonzero(have)
        place = np.zeros(len(ratio), np.int32)
        place[ids] = np.arange(len(ids))
        x = ratio[ids]
        parts = [(r, place[f], starts) for r, f, starts in parts]
        w, b, n = np.zeros(len(ids)), np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), len(y)
        m, v = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1)
        for t in range(1, STEPS + 1):
            z, values = np.full(n, b), (w * x).astype(np.float32)
            for r, f, starts in parts:
                z[r[starts]] += np.add.reduceat(values[f], starts)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
            sums = np.zeros(len(ids))
            for r, f, _ in parts:
                np.add.at(sums, f, e[r])
            g = np.append(sums * x + L2 * w, e.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
        return pd.DataFrame({"f": np.append(ids, -1), "w": np.append(w, b)})
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          keep: Column | None = None, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """(weight of every feature, bias), learnt from the labelled rows for which `keep` holds."""
    spark = docs.sparkSession
    path = scratch_path(spark, "toxicity")
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.where(keep) if keep is not None else known
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
    n = known.count()
    part = min(1.0, rows / max(n, 1))
    sample = known.where(F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 30)) < int(part * (1 << 30)) + (part >= 1))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The sample holds about `rows` ids, so it may be broadcast; the texts are not shuffled.
    texts.join(F.broadcast(sample), "id").select("y", "text", F.monotonically_increasing_id().alias("row")).write.parquet(path)
    data = spark.read.parquet(path)

    counts = data.select("y", "text").mapInArrow(_counts, "f long, other long, toxic long") \
        .groupBy("f").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toPandas()     # at most 2^DIM_BITS + 1 rows
    weights = np.zeros(1 << DIM_BITS)
    size = counts[counts.f < 0][["other", "toxic"]].sum().to_numpy()
    counts = counts[counts.f >= 0].sort_values("f")
    if not size.all():
        share = float(size[1] / size.sum()) if size.sum() else 0.0
        return weights, 30.0 if share == 1 else -30.0
    q, p = counts.other.to_numpy() + SMOOTHING, counts.toxic.to_numpy() + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    sure = np.abs(ratio) / np.sqrt(1 / p + 1 / q)                  # ratio over its standard error
    values = np.zeros(1 << DIM_BITS)
    values[counts.f.to_numpy()] = ratio * sure ** 8 / (sure ** 8 + SIGMAS ** 8)

    groups = max(1, round(size.sum() / GROUP_ROWS))
    fitted = data.withColumn("g", F.pmod(F.xxhash64(F.lit("group"), "row"), F.lit(groups))).groupBy("g").applyInPandas(_fit(values), "f long, w double")
    mean = fitted.groupBy("f").agg(F.sum("w").alias("w")).toPandas()                                     # at most 2^DIM_BITS + 1 rows
    used = data.select(F.pmod(F.xxhash64(F.lit("group"), "row"), F.lit(groups))).distinct().count()
    got = mean[mean.f >= 0]
    weights[got.f.to_numpy()] = got.w.to_numpy() / used
    return weights * values, float(mean[mean.f < 0].w.iloc[0] / used)


def _scorer(spark: SparkSession, model: tuple[np.ndarray, float]):
    """Function from a text column to its scores; the broadcast weights are 2^DIM_BITS numbers."""
    weights, bias = spark.sparkContext.broadcast(model[0]), model[1]

    def scores(col: pa.Array) -> np.ndarray:
        row, f = grams(col, weights.value != 0)
        z = bias + np.bincount(row, weights.value[f], minlength=len(col))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return scores


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    scores = _scorer(docs.sparkSession, model)

    def run(batches):
        for part in T.chunks(batches, limit=_CHUNK):
            yield pa.record_batch({"id": part.column(0), "score": pa.array(scores(part.column(1)))})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float, text_col: str = "text") -> DataFrame:
    """The rows scored below the threshold, with all their columns."""
    scores = _scorer(docs.sparkSession, model)

    def run(batches):
        for part in T.chunks(batches, text_col, _CHUNK):
            kept = np.flatnonzero(scores(part.column(part.schema.names.index(text_col))) < threshold)
            yield part.take(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def _third(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from two thirds of the labels, scores every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=_third() != 1)
    return score(docs, model).select(F.col("id").alias("doc_id"), F.coalesce(_third("id") == 1, F.lit(False)).alias("held_out"),
                                     "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
