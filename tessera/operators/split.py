"""Table splits, key hashes and row ids (L1-L3).

The reference splits with an unseeded random draw.  Here the default split
is a pure function of a row key (60 bits of md5 of the key text), so a
row lands on the same side on every run, on every executor, after any task
retry, with no shuffle; ``random_split`` offers the seeded draw as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

HASH_SPACE = 1 << 60


def text_hash(text: Column) -> Column:
    """0 .. HASH_SPACE-1: the first 15 hex digits of the text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def key_hash(keys: Sequence[str]) -> Column:
    """Hash of the '::'-joined key columns."""
    return text_hash(F.concat_ws("::", *[F.col(k).cast("string") for k in keys]))


def hash_cut(fraction: float) -> int:
    """The hashes below this number are ``fraction`` of all."""
    return int(fraction * HASH_SPACE)


def hash_split(df: DataFrame, keys: Sequence[str], fraction: float) -> tuple[DataFrame, DataFrame]:
    """(main, rest): ``fraction`` of the rows by key hash, and the side output."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be in [0, 1], got {fraction}")
    h = key_hash(keys)
    return df.filter(h < hash_cut(fraction)), df.filter(h >= hash_cut(fraction))


_BUCKET_BITS = 12


def exact_split(df: DataFrame, keys: Sequence[str], fraction: float) -> tuple[DataFrame, DataFrame]:
    """(main, rest) with exactly round(fraction * rows) rows in ``main`` (L2): those of the smallest key hashes.

    The cut is an order statistic of the 60-bit hash, found by refining a histogram: each pass
    counts the rows of the current hash range in 4096 parts (at most that many rows come back) and goes
    on in the part that holds the cut.  Rows whose hash is the cut itself (repeated keys)
    are numbered, in the order of a hash of all columns, and the first of them are taken.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be in [0, 1], got {fraction}")
    hashed = df.withColumn("__h", key_hash(keys))
    left = int(fraction * df.count() + 0.5)             # rows still to find below the cut
    low, bits = 0, HASH_SPACE.bit_length() - 1
    while bits and left:
        bits -= _BUCKET_BITS
        part = F.shiftright(F.col("__h") - low, bits)
        counts = sorted(hashed.where((F.col("__h") >= low) & (F.col("__h") < low + (1 << bits + _BUCKET_BITS)))
                        .groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        for r in counts:
            if r["n"] >= left:                          # the cut lies in this part, or at its end
                at = r["part"]
                break
            left -= r["n"]
        low += at << bits
        if r["n"] == left:                              # the whole part, so no row is split off
            low, left = low + (1 << bits), 0
    main, rest = hashed.where(F.col("__h") < low), hashed.where(F.col("__h") >= low)
    if left:
        same = with_row_id(hashed.where(F.col("__h") == low).withColumn("__o", F.xxhash64(*df.columns)), ["__o"], "__n")
        main = main.unionByName(same.where(F.col("__n") < left).drop("__o", "__n"))
        rest = hashed.where(F.col("__h") > low).unionByName(same.where(F.col("__n") >= left).drop("__o", "__n"))
    return main.drop("__h"), rest.drop("__h")


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Seeded ``randomSplit``; weights are normalised as in Spark."""
    return df.randomSplit(list(weights), seed)


def with_row_id(df: DataFrame, order_cols: Sequence[str], name: str = "rid") -> DataFrame:
    """Consecutive ids 0..n-1 over a total order of ``order_cols`` (L3), all columns kept.

    The rows are range-partitioned and sorted on the order and written under
    the checkpoint folder together with their position (partition number
    << 33 plus the row's place in it).  Both the counts per partition and
    the ids are then derived from that one stored table, so they always
    agree.  A row's id is its place plus the rows of the partitions before
    (one broadcast row per partition).  ``order_cols`` must be a total order,
    or ids are not reproducible.
    """
    path = scratch_path(df.sparkSession, "row-ids")
    (df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
     .withColumn("__at", F.monotonically_increasing_id()).write.parquet(path))
    stored = df.sparkSession.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    counts = stored.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    place = F.col("__at").bitwiseAND((1 << 33) - 1)
    return (stored.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + place)
            .drop("__at", "__part", "__before"))
