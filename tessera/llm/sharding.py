"""Shards cut along a Hilbert curve through several metadata dimensions.

Every dimension is quantised to 2^BITS cells of about equal row counts, which are ranges of
its values: bounds of numbers are approximate percentiles over all rows; bounds of strings
are the whole values at which the rows counted per value, summed in byte order, reach each
share of all rows, so a common prefix of any length changes nothing.  Rows are sorted by the curve index of their cell vector and cut into runs
of equal counts (law `rows`: counts differ by one at most).  A run covers few ranges in
every dimension, so file statistics prune on any of them.

The global rank needs no single task: the rows are range-partitioned and sorted by curve
index, then written with their position; a rank is the position plus the rows of the
partitions before it.  The table is written once and read back, so both uses see the same
partitions.  A hot cell (one source holding a third of the rows, thousands of equal texts)
is split between partitions, because the sort continues by text checksum and id.

Defined cases.  Null values of a dimension come first (cell 0).  A null text has size 1 and
checksum null.  Rows that are equal in everything are interchangeable; each gets a slot of
its own.  An empty table gives an empty result.  Columns that are not named are carried
along by `hilbert_ranked`, and not read by the query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from tessera.session import scratch_path

BITS = 4
SHARDS = 8
_ACCURACY = 1000
_RUN = 4096


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Curve index of each row of cells (rows x dimensions, each below 2^bits).

    The axes are turned level by level into the curve's transposed index, whose bits are
    then interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(dims):
            turn = (x[i] & level) != 0
            swap = np.where(turn, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turn, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> b & 1)
    return out


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, ST.StringType)


def _text_bounds(df: DataFrame, name: str, parts: int) -> list[bytes]:
    """The values at which the cumulative count of rows in byte order reaches k / parts of the rows that are not null."""
    per = df.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("binary").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    values, _ = ranked(per, ["value"])
    values = values.withColumn("run", F.expr(f"rank div {_RUN}"))
    sums = values.groupBy("run").agg(F.sum("n").alias("s"))                      # one row per _RUN distinct values
    total = sums.agg(F.coalesce(F.sum("s"), F.lit(0))).first()[0]
    before = sums.select("run", F.coalesce(F.sum("s").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("run").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    upto = values.withColumn("inside", inside).join(before, "run").withColumn("upto", F.col("before") + F.col("inside"))
    row = upto.agg(*[F.min(F.when(F.col("upto") * parts >= k * total, F.col("value"))) for k in range(1, parts)]).first()
    return sorted({bytes(b) for b in row if b is not None})


def curve_column(df: DataFrame, dims: list[str], bits: int = BITS) -> tuple[DataFrame, Column]:
    """df with its quantised dimensions as the column `__cells`, and the curve index made of it."""
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = [d for d in dims if not _is_text(df, d)]
    row = df.agg(F.count(F.lit(1)), *[F.percentile_approx(F.col(d).cast("double"), steps, _ACCURACY) for d in numbers]).first() if numbers else []
    found = dict(zip(numbers, row[1:]))
    cells = []
    for d in dims:                               # at most 2^bits - 1 bounds
        bounds = _text_bounds(df, d, 1 << bits) if _is_text(df, d) else sorted(set(found[d] or []))
        value = F.col(d).cast("binary" if _is_text(df, d) else "double")
        cells.append(F.coalesce(sum([(value > F.lit(b)).cast("int") for b in bounds], F.lit(0)), F.lit(0)))

    @F.pandas_udf("long")
    def index(cells: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack(cells.to_list()), bits) if len(cells) else [], dtype="int64")

    return df.withColumn("__cells", F.array(*cells)), index("__cells")


def ranked(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """(df with its global `rank` from 0 in ascending order of the columns, number of rows)."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    # Position and partition are stored: they are not computed a second time.
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("__at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("c"))            # one row per partition
    before = counts.select("__part", F.coalesce(F.sum("c").over(
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    out = (rows.join(F.broadcast(before), "__part")
           .withColumn("rank", F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1)).drop("__part", "__at", "__before"))
    return out, total


def hilbert_ranked(df: DataFrame, dims: list[str], ties: list[str], bits: int = BITS) -> tuple[DataFrame, int]:
    """(df with `curve` and the global `rank` along it, number of rows)."""
    cells, curve = curve_column(df, dims, bits)
    return ranked(cells.withColumn("curve", curve).drop("__cells"), ["curve", *ties])


def cut(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Adds `shard` and `slot`: runs of the rank whose lengths differ by one at most, the longer ones first."""
    small, extra = divmod(total, shards)
    head = extra * (small + 1)                                  # ranks of the longer runs
    r = F.col("rank")
    shard = F.when(r < head, F.floor(r / (small + 1))).otherwise(extra + F.floor((r - head) / max(small, 1)))
    slot = F.when(r < head, r % (small + 1)).otherwise((r - head) % max(small, 1))
    return rows.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, dims: tuple[str, ...] = ("lang", "source", "n_chars"),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, curve, shard, slot) of every row."""
    text = F.col(text_col)
    view = docs.select(F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *[F.col(d).alias(f"dim{i}") for i, d in enumerate(dims)])
    along, total = hilbert_ranked(view, [f"dim{i}" for i in range(len(dims))], ["text_crc32", "id", "size"])
    return cut(along, total, shards).select("id", "size", "text_crc32", "curve", "shard", "slot")


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents along a curve through language, source and length, in eight shards of equal row counts."""
    s = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return s.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "curve")
