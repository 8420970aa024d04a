"""Labeled text source (S3): ``label,<tag>,f1 f2 ... fn``.

The text after the second comma is trimmed and split on spaces; empty
tokens are dropped (Q7), so repeated spaces do not create extra zeros.  A
line without two commas or with an unparseable number is bad (Q16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the line layout.
LINE_PATTERN = r"^([^,]*),([^,]*),(.*)$"


def _parsed(df: DataFrame, value: str = "value") -> DataFrame:
    v = F.col(value)
    matched = v.rlike(LINE_PATTERN)
    label = F.regexp_extract(v, LINE_PATTERN, 1)
    tag = F.regexp_extract(v, LINE_PATTERN, 2)
    rest = F.trim(F.regexp_extract(v, LINE_PATTERN, 3))
    tokens = F.filter(F.split(rest, " "), lambda s: s != "")
    feats = F.transform(tokens, lambda s: s.try_cast("double"))
    return df.select(
        F.col(value).alias("line"),
        F.when(matched, F.trim(label).try_cast("double")).alias("label"),
        F.when(matched, tag).alias("tag"),
        F.when(matched, feats).alias("features"))


def _good():
    return (F.col("label").isNotNull() & F.col("features").isNotNull()
            & ~F.exists("features", lambda x: x.isNull()))


def split_labeled_lines(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows (label double, tag string, features array<double>), bad lines)."""
    p = _parsed(df, value)
    ok = F.coalesce(_good(), F.lit(False))
    return p.filter(ok).select("label", "tag", "features"), p.filter(~ok).select("line")


def parse_labeled_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """Strict: a bad line fails the job, whatever columns are read (the check filters rows)."""
    p = _parsed(df, value)
    fail = F.raise_error(F.concat(F.lit("not a labeled line: "), F.coalesce("line", F.lit("null")))).cast("boolean")
    return p.filter(F.when(_good(), F.lit(True)).otherwise(fail)).select("label", "tag", "features")


def read_labeled_text(spark: SparkSession, path: str, strict: bool = True):
    """S3: read a labeled text file (train or test)."""
    lines = spark.read.text(path)
    return parse_labeled_lines(lines) if strict else split_labeled_lines(lines)
