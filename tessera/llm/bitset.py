"""Bitsets of a fixed size that mark hashed keys.

A fuller bitset lets more rows pass, never fewer, so what follows stays exact; its size is
a parameter and does not grow with the data, so it may be broadcast.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 1 << 24


def bit_words(hashes: DataFrame, bits: int = BITS) -> DataFrame:
    """(w, b): the words of the bitset that are not 0, at most bits / 64 rows, for a long column `hash`."""
    slot = F.col("hash").bitwiseAND(bits - 1)
    return hashes.select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("b")) \
        .groupBy("w").agg(F.bit_or("b").alias("b"))


def bitset(spark: SparkSession, hashes: DataFrame, bits: int = BITS):
    """The bitset as a broadcast numpy array, for Python workers."""
    out = np.zeros(bits // 64, np.uint64)
    for w, b in bit_words(hashes, bits).collect():
        out[w] = b & 0xFFFFFFFFFFFFFFFF
    return spark.sparkContext.broadcast(out)


def marked(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Indices of the hashes whose bit is set."""
    slot = h & np.uint64(64 * len(words) - 1)
    return np.flatnonzero((words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1))


def where_marked(df: DataFrame, key: Column, keys: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of df whose key may be among `keys` (one column): a broadcast join with the bitset, without a shuffle of df."""
    words = bit_words(keys.select(F.xxhash64(keys[0]).alias("hash")), bits).withColumnsRenamed({"w": "__w", "b": "__b"})
    slot = F.xxhash64(key).bitwiseAND(bits - 1)
    return (df.withColumn("__slot", slot).join(F.broadcast(words), F.shiftright("__slot", 6) == F.col("__w"))
            .where("(__b & shiftleft(1L, cast(__slot & 63 as int))) <> 0").drop("__slot", "__w", "__b"))
