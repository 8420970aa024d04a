"""Training-corpus pipeline over `documents`.

Stages, in order: toxic documents go; one document of each near-duplicate group stays
(five-word shingles, 80 of 100); documents in which a benchmark window occurs go; the
sources are mixed to their target weights; the mixture is cut into shards along a Hilbert
curve.  Each stage is a function of (spark, docs, sf_dir) and works on all rows that its
predecessor kept.  `run` writes every stage's rows as Parquet under the checkpoint folder
and reads them back for the next one, so a lost executor never costs a finished stage.

Defined cases are those of the operators: documents with null or empty text are neither
toxic, duplicates nor contaminated, and the mixture takes nothing of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, mixing, near_dedup, sharding, toxicity
from tessera.session import scratch_path

#: SQL can't express the trained classifier; tests hold the stages against plain versions.
ORACLE_SQL = None


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of two thirds of the ids, drops every document scored 0.7 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, keep=F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    return toxicity.without_toxic(docs, model, 0.7)


def near_duplicates_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every group linked at 0.8 over five-word shingles."""
    return near_dedup.keep_one(docs, shingle=5, percent=80)


def contaminated_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which ten consecutive words of a benchmark item occur."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document and whole pass of its source, and per piece of a part pass."""
    return mixing.mix(docs)


def _free(name: str, taken: list[str]) -> str:
    """The name, with underscores while a column of the documents has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with `curve`, `shard` and `slot`: eight shards along language, source and length.

    Documents that have columns of these names keep them; the stage's get an underscore more.
    """
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.col("lang").alias("dim0"), F.col("source").alias("dim1"),
                         F.col("n_chars").alias("dim2"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"))
    along, total = sharding.hilbert_ranked(packed, ["dim0", "dim1", "dim2"], ["id", "tie"])
    return sharding.cut(along, total, sharding.SHARDS).select("doc.*", *[F.col(c).alias(_free(c, docs.columns)) for c in ("curve", "shard", "slot")])


STAGES = [
    ("toxicity", toxic_documents_go),
    ("near_dedup", near_duplicates_go),
    ("decontamination", contaminated_documents_go),
    ("mixing", sources_mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
