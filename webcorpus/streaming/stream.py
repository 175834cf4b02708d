"""Structured Streaming forms of the batch operators.

The same DataFrame functions run on a stream: ``readStream`` of pages or
records -> operator -> ``foreachBatch`` sink.  State (first-seen keys) and
progress live in a checkpoint location under the session's shared
checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def read_stream(spark: SparkSession, path_glob: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet stream over a folder or a glob (a stream over the path of
    a single file cannot start: its base path must be a directory)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path_glob)


def run_to_table(stream: DataFrame, out_path: str, checkpoint: str,
                 batch_fn: Callable[[DataFrame, int], DataFrame] | None = None,
                 output_mode: str = "append", partition_by: list[str] | None = None,
                 trigger: dict | None = None) -> None:
    """Process the stream into a parquet table.

    ``batch_fn`` may transform each micro-batch; with ``partition_by``
    (e.g. ``["sink"]``) one write fills several sinks, one folder each.
    Progress is in the checkpoint, so a restart resumes after the last
    committed batch; each batch lands in its own ``batch_id`` partition,
    written with dynamic overwrite, so a replayed batch is not doubled.  ``trigger`` defaults to ``availableNow`` (process
    what is there, then stop); pass e.g. ``{"processingTime": "1 minute"}``
    for a long-running query."""
    def sink(batch: DataFrame, epoch: int):
        out = (batch_fn(batch, epoch) if batch_fn else batch).withColumn("batch_id", F.lit(epoch))
        # idempotent per epoch: a batch replayed after a restart replaces
        # its own partition instead of appending a second copy
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", *(partition_by or [])).parquet(out_path))

    w = stream.writeStream.foreachBatch(sink).outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**trigger) if trigger else w.trigger(availableNow=True)
    w.start().awaitTermination()


def stream_first_seen(keyed_stream: DataFrame, event_time: str | None = None,
                      within: str | None = None) -> DataFrame:
    """First arrival of every ``(meta, key)`` across all micro-batches
    and restarts.  The seen keys live in the state store (RocksDB, see
    ``session.DEFAULT_CONF``) and are checkpointed with the query.

    Unbounded by default, as the set it replaces.  With ``event_time`` and
    ``within`` (e.g. ``"7 days"``) a key is only remembered for that long
    after its last arrival (``dropDuplicatesWithinWatermark``), which
    bounds the state."""
    if event_time and within:
        if dict(keyed_stream.dtypes)[event_time] == "timestamp_ntz":
            # watermarks need TIMESTAMP; wall-clock values are read in the session zone (UTC)
            keyed_stream = keyed_stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
        return keyed_stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["meta", "key"])
    return keyed_stream.dropDuplicates(["meta", "key"])


def stream_left_anti(stream: DataFrame, static: DataFrame, on: list[str]) -> DataFrame:
    """Drop stream rows whose key is already in a stored table."""
    return stream.join(static.select(*on).distinct(), on, "left_anti")


def new_locations(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output table path, checkpoint path) under the shared folder."""
    base = scratch_path(spark, name)
    return base + "/out", base + "/checkpoint"
