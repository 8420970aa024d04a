"""Session helpers.

On a cluster the session comes from the launcher and already names a shared
``spark.checkpoint.dir``; nothing here overrides it.  Only when it is unset
(local runs, tests) do we pick a scratch folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session tuned for the workloads in this package.

    AQE stays on: it coalesces the small post-aggregation shuffles (count
    cells are few), converts joins to broadcast from *measured* sizes and
    splits skewed join partitions.
    """
    master = master or os.environ.get("TESSERA_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g")))
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting one only if unset.

    The value of ``spark.checkpoint.dir`` (shared storage on a cluster) wins.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: iterative jobs "
                               "write their per-round tables there")
        # Local/test runs only: a fresh scratch folder of our own.
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for written tables/models)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class RoundTables:
    """Small per-round tables written under the checkpoint folder and read back.

    Writing cuts the lineage each round, survives executor loss, and runs
    through AQE (a persisted plan keeps its un-coalesced shuffle partitions).
    The previous round's table is deleted once the next one is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, name)
        self.count = 0
        self.last: str | None = None

    def put(self, df):
        path = f"{self.base}/r{self.count}"
        self.count += 1
        df.write.mode("overwrite").parquet(path)
        self._drop(self.last)
        self.last = path
        return self.spark.read.parquet(path)

    def close(self) -> None:
        self._drop(self.base)
        self.last = None

    def _drop(self, path: str | None) -> None:
        if not path:
            return
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
