"""Fitted models applied to Structured Streaming sources.

The reference has no streaming operator (no window, watermark or keyed
state).  What does carry over is that the fitted transforms are pure
per-row projections: selector slicing (E4) and SVM prediction (P16) run
unchanged on a ``readStream`` DataFrame, with no state and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.labeled import split_labeled_lines
from tessera.sources.ratings import split_rating_lines


def labeled_line_stream(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S3 over a directory of arriving text files: (good rows, bad lines) streams."""
    return split_labeled_lines(spark.readStream.text(path))


def rating_line_stream(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S1/P6 over a directory of arriving rating feeds: (good rows, bad lines) streams."""
    return split_rating_lines(spark.readStream.text(path))


def apply_model(stream: DataFrame, model) -> DataFrame:
    """Any fitted tessera model (selector or SVM): a stateless projection of the stream."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return model.transform(stream)


def run_to_table(stream: DataFrame, checkpoint: str, sink: str, fmt: str = "parquet"):
    """Start an append-mode query into ``sink`` with its own checkpoint folder.

    Call ``processAllAvailable()`` / ``stop()`` on the returned query.
    """
    return (stream.writeStream.format(fmt).outputMode("append")
            .option("checkpointLocation", checkpoint).start(sink))
