"""Per-feature column vectors in bounded chunks.

A feature's column over all rows is a sequence of chunks of ``CHUNK`` consecutive rows, one
table row each: sparse (ascending positions and values) or, where at least half of a chunk is
not zero, dense.  Chunks without a non-zero are not stored.  What is gathered is one chunk
of one feature, so a feature that is everywhere is many chunks and no single task's work.
Entries are distinct pairs of feature and row; rows are numbered 0 .. n - 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 15
DENSE_SHARE = 0.5
_COLUMNS = "k int, chunk bigint, size int, positions array<int>, vals array<tinyint>"


def _packed(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            at, vals = np.array(r["at"], np.int64), np.array(r["vals"], np.int8)
            positions = r["at"]
            if len(at) >= DENSE_SHARE * r["size"]:
                column = np.zeros(r["size"], np.int8)
                column[at] = vals
                positions, vals = None, column
            out.append({"k": r["k"], "chunk": r["chunk"], "size": r["size"], "positions": positions, "vals": vals.tolist()})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("k", pa.int32()), ("chunk", pa.int64()), ("size", pa.int32()),
                                                         ("positions", pa.list_(pa.int32())), ("vals", pa.list_(pa.int8()))]))


def column_chunks(entries: DataFrame, n_rows: int, chunk: int = CHUNK) -> DataFrame:
    """(k, chunk, size, positions, vals) from the non-zeros (k, id, v); positions are null where vals is dense."""
    at = F.col("id") - F.col("chunk") * chunk
    grouped = entries.select(F.col("k").cast("int").alias("k"), F.col("id"), F.col("v").cast("tinyint").alias("v"), F.expr(f"id div {chunk}").alias("chunk")) \
        .groupBy("k", "chunk").agg(F.array_sort(F.collect_list(F.struct(at.cast("int").alias("at"), "v"))).alias("e"))
    size = F.least(F.lit(chunk), F.lit(n_rows) - F.col("chunk") * chunk).cast("int")
    return grouped.select("k", "chunk", size.alias("size"), F.col("e.at").alias("at"), F.col("e.v").alias("vals")).mapInArrow(_packed, _COLUMNS)


def column_entries(chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The non-zeros (k, id, v) of column chunks."""
    each = chunks.select("k", "chunk", "positions", F.posexplode("vals").alias("i", "v")).where("v <> 0")
    place = F.when(F.col("positions").isNull(), F.col("i")).otherwise(F.expr("positions[i]"))
    return each.select("k", (F.col("chunk") * chunk + place).alias("id"), "v")
