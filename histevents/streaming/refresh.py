"""Incremental refresh with Structured Streaming.

* ``refresh_to_table``: landed files -> same enrichment as batch ->
  ``foreachBatch`` that keeps the first row per event hash inside the
  micro-batch and appends only hashes the target does not hold yet
  (``left_anti``).  Re-running an epoch after a failure appends nothing
  twice, and the checkpoint lets a restarted query resume where it stopped.
  ``Trigger.AvailableNow`` processes what has landed and stops.
* ``dedupe_within_watermark``: bounded-state streaming dedupe by hash with a
  watermark on ingest time; replays older than the watermark are left to the
  anti-join against the store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histevents.functions.scalars import event_hash
from histevents.operators.dedupe import first_wins_dedupe
from histevents.session import path_exists, scratch_path


def with_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("event_hash", event_hash("year", "title", "source"))


def dedupe_within_watermark(stream: DataFrame, ts_col: str = "ingest_ts", delay: str = "1 day") -> DataFrame:
    return with_hash(stream).withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(["event_hash"])


def run_batches(stream: DataFrame, target: str) -> None:
    """Append what a stateful stream emits from everything landed so far."""
    (stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", f"{target}-checkpoint")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def _append_new(target: str, order_col: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        first = first_wins_dedupe(with_hash(batch), "event_hash", [order_col])
        # only a target that isn't there yet is new; one that can't be read is a
        # fault and fails the epoch, or its rows would be appended once more
        if path_exists(spark, target):
            stored = spark.read.schema(first.schema).parquet(target).select("event_hash")
            first = first.join(stored, "event_hash", "left_anti")
        first.write.mode("append").parquet(target)
    return run


def refresh_to_table(stream: DataFrame, target: str, checkpoint: str, order_col: str = "seq",
                     available_now: bool = True):
    """Start the refresh query; returns the StreamingQuery."""
    w = (stream.writeStream.foreachBatch(_append_new(target, order_col))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_refresh_once(spark: SparkSession, stream: DataFrame, order_col: str = "seq",
                     name: str | None = None) -> DataFrame:
    """Process everything landed so far into a fresh table under the shared
    checkpoint folder and return that table."""
    tag = name or f"refresh_{uuid.uuid4().hex}"
    target = scratch_path(spark, f"{tag}/table")
    q = refresh_to_table(stream, target, scratch_path(spark, f"{tag}/checkpoint"), order_col)
    q.awaitTermination()
    return spark.read.parquet(target)


def refresh_store(stream: DataFrame, store, checkpoint: str | None = None, available_now: bool = True):
    """T1 into the event store with the batch code path: every micro-batch
    goes through ``EventStore.save_events`` (validity split, first row per
    hash, anti-join against stored hashes, partitioned append, quarantine).
    Returns the StreamingQuery."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        store.save_events(batch)

    ckpt = checkpoint or f"{store.base}/_checkpoints/refresh_store"
    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
