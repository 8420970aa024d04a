"""Validation operators.

One rule for feature vectors, ``vector_fault``, serves the violation tables
and the estimators.  A violation table returns its bad rows as a DataFrame
(so a caller can inspect or store them); the ``require_*`` forms raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import has_non_byte

BINARY_LABELS = (0.0, 1.0)


def label_violations(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose label is not 0.0 or 1.0 (null included)."""
    lab = F.col(label).cast("double")
    return df.filter(lab.isNull() | ~lab.isin(*BINARY_LABELS))


def label_fault(label: str = "label", byte: bool = False) -> Column:
    """Why a label is refused, or null: not 0/1, or (``byte``) not an integer of one byte."""
    lab = F.col(label).cast("double")
    bad = (lab % 1 != 0) | (lab < -128) | (lab > 127) if byte else ~lab.isin(*BINARY_LABELS)
    return F.when(lab.isNull(), "null label").when(bad, "label")


def vector_fault(features: str = "features", byte: bool = False, dim: Column | None = None) -> Column:
    """Why an array of features is refused, or null: null, null element, other length, not a byte."""
    x = F.col(features)
    fault = F.when(x.isNull(), "null vector").when(F.exists(x, lambda v: v.isNull()), "null element")
    if dim is not None:
        fault = fault.when(F.size(x) != dim, "length")
    return fault.when(has_non_byte(features), "not a byte") if byte else fault


def vector_violations(df: DataFrame, features: str = "features", byte: bool = False) -> DataFrame:
    """P5/A5: rows that ``vector_fault`` refuses, with the column ``fault``.

    The expected length is the most common one of the table (of equally
    common ones the smallest).
    """
    sizes = df.filter(F.col(features).isNotNull()).groupBy(F.size(features).alias("d")).count()
    top = sizes.orderBy(F.desc("count"), "d").first()
    dim = F.lit(top["d"] if top else 0)
    return df.withColumn("fault", vector_fault(features, byte, dim)).filter(F.col("fault").isNotNull())


def byte_violations(df: DataFrame, features: str = "features") -> DataFrame:
    """P5: rows with a null, or a value that is non-integral or outside [-128, 127]."""
    return df.filter(vector_fault(features, byte=True).isNotNull())


def dimensions(df: DataFrame, features: str = "features") -> DataFrame:
    """A5: one row (min_dim, max_dim, n) in a single partially aggregated pass."""
    size = F.size(features)
    return df.agg(F.min(size).cast("int").alias("min_dim"), F.max(size).cast("int").alias("max_dim"),
                  F.count(F.lit(1)).alias("n"))


def training_metrics(features: str = "features", label: str = "label", byte: bool = False, size: str | None = None) -> list[Column]:
    """P4 + P5 + A5 as aggregates for ``check_training``; ``size`` names the vectors' size where it isn't the array's.

    They fit ``agg`` and, so that a check rides on a write, ``DataFrame.observe``.
    """
    length = F.col(size) if size else F.size(features)
    length = F.when(F.col(features).isNotNull(), length)
    return [F.min(label_fault(label, byte)).alias("label"), F.min_by(label, label_fault(label, byte)).alias("example"),
            F.min(vector_fault(features, byte)).alias("fault"),
            F.min(length).alias("low"), F.max(length).alias("high"), F.count(F.lit(1)).alias("n")]


def check_training(row, byte: bool = False) -> tuple[int, int]:
    """(dimension, rows) of a training table, or an error that names its first fault."""
    if row["n"] == 0:
        raise ValueError("no training rows")
    if row["label"]:
        what = "an integer of one byte" if byte else "binary, 0 or 1"
        raise ValueError(f"{row['label']} in the training table: labels must be {what} (for example {row['example']})")
    if row["fault"]:
        raise ValueError(f"feature vectors with a fault in the training table: {row['fault']}")
    if row["low"] != row["high"]:
        raise ValueError(f"feature vectors differ in dimension: from {row['low']} to {row['high']}")
    return int(row["low"]), int(row["n"])


def require_training_table(df: DataFrame, features: str = "features", label: str = "label",
                           byte: bool = False) -> tuple[int, int]:
    """P4 + P5 + A5 in one pass: labels, no nulls, one common dimension (``byte``: byte domain).

    Returns (dimension, rows).
    """
    return check_training(df.agg(*training_metrics(features, label, byte)).first(), byte)
