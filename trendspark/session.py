"""Session construction and lineage cuts.

Everything that needs a durable intermediate (a sequenced table reused by several
marts, a range-partitioned table whose partition ids become data) writes parquet
under the cluster's shared ``spark.checkpoint.dir``. The setting is read from the
session; a private folder is set only when it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STORED_CODEC = "zstd"      # of what is written to be read back; a quarter smaller than the default on the metrics


def build_session(master: str | None = None, app_name: str = "trendspark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way every operator here expects it.

    UTC session zone (timestamps are epoch based), ANSI on (Spark 4 default),
    AQE with partition coalescing and skew-join splitting, UI off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if not configured:
        # A folder of this machine is right only where driver and tasks share one process.
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="trendspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside deletes its shuffle files when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of all
    steps of a query add up on disk. A later read takes the written files, so none is missed."""
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_KEY)
        else:
            spark.conf.set(_CLEANUP_KEY, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts lineage (an executor loss after this point never recomputes upstream
    work) and freezes nondeterministic columns such as partition ids.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tables", f"{label}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        df.write.mode("overwrite").option("compression", STORED_CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a materialised table that nothing reads any more."""
    spark = df.sparkSession
    root = f"{ensure_checkpoint_dir(spark)}/tables/"
    jvm = spark.sparkContext._jvm
    for name in {f.split("/tables/", 1)[1].split("/", 1)[0] for f in df.inputFiles() if "/tables/" in f}:
        path = jvm.org.apache.hadoop.fs.Path(root + name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
