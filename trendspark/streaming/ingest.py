"""Incremental ingest: landed JSON Lines -> keyed upsert, with Structured Streaming.

Each micro-batch of newly landed files is upserted into a table partitioned by key
bucket (``sources.upsert``). Within a micro-batch the rows of a key's newest landed file win, so
the table does not depend on how many files a trigger takes. The upsert is idempotent,
so a batch replayed after a failure (the file source and the checkpoint guarantee
at-least-once delivery to ``foreachBatch``) leaves the same table. Lines that do not fit
the schema go to ``<table_root>-rejects`` with a reason, one folder per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendspark.sources.io import parse_lines
from trendspark.sources.upsert import load_batch, newest_per_key


def start_ingest(spark: SparkSession, landing_dir: str, table_root: str, schema: T.StructType,
                 keys: tuple[str, ...] | list[str], checkpoint_location: str | None = None,
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 rejects_root: str | None = None,
                 on_batch: Callable[[int, int], None] | None = None) -> StreamingQuery:
    """Start a stream that upserts every new landed file batch into ``table_root``.

    ``available_now`` processes what has landed and stops (scheduled batch runs);
    otherwise the query keeps running and picks up files as they arrive. The default
    checkpoint lies beside the table, so a restarted application goes on from there.
    ``on_batch`` is called on the driver with the number of a micro-batch and the table's
    row count once the batch is loaded, before it counts as done.
    """
    table_root = table_root.rstrip("/")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.text(landing_dir).select(
        "value", F.col("_metadata.file_modification_time").alias("_landed"), F.col("_metadata.file_path").alias("_file"))
    location = checkpoint_location or f"{table_root}-checkpoint"
    rejects = rejects_root or f"{table_root}-rejects"

    def load(batch: DataFrame, batch_id: int) -> None:
        good, bad = parse_lines(batch, schema)
        newest = newest_per_key(good, keys, ["_landed", "_file"]).drop("_landed", "_file")
        bad.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{rejects}/batch={batch_id}")
        rows = load_batch(batch.sparkSession, table_root, newest, keys)
        if on_batch:
            on_batch(batch_id, rows)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
