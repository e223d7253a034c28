"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(prefix: str = "c") -> str:
    """A column name no caller's column clashes with."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def held_out(doc_id: str) -> F.Column:
    """crc32 of the id as text, mod 5, is 0; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def own_columns(df: DataFrame) -> list[F.Column]:
    """The columns of ``df`` by name, also where a name holds a dot."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` for any column names (it cannot look up names with a dot): batches go by position."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)


class Scratch:
    """Written intermediates of one operator run, deleted when no longer read.

    ``keep`` writes and rereads a table (cutting the lineage at the shared folder);
    ``drop`` deletes tables; after either, shuffle files of finished steps are released,
    so that disk use follows the widest step and not the sum of all steps.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = os.path.join(ensure_checkpoint_dir(spark), "tables", f"{label}-{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        self.release()
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(frame._scratch)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.release()

    def release(self) -> None:
        """Let the context cleaner remove shuffles that nothing refers to any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def common_from(counts: DataFrame, bound: int, c: str = "c") -> int:
    """Smallest power-of-two-eighth count from which at most ``bound`` rows of ``counts`` have it.

    A bound for what is sent to all tasks; the rest needs a join. Only a histogram of the
    counts (eight steps to a doubling) reaches the driver.
    """
    steps = counts.groupBy(F.floor(F.log2(c) * 8).alias("step")).agg(F.count("*").alias("n"), F.min(c).alias("least"))
    total, least = 0, 1 << 62
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):
        total += row["n"]
        if total > bound:
            break
        least = row["least"]
    return least


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside send at most ``rows`` rows at once to Python (rows with long lists)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
