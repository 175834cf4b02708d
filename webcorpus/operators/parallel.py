"""Partitions of CPU-bound stages (regex-heavy text, HTML parsing)."""

from __future__ import annotations

from pyspark.sql import DataFrame

STAGE_PARTITIONS = "webcorpus.stage.partitions"


def partitioned(df: DataFrame, key: str | None = None) -> DataFrame:
    """``df`` as it is, or hashed on ``key`` into the number of partitions
    that the caller has set in the session's ``webcorpus.stage.partitions``.

    Unset (the default) adds no exchange: the scan's splits
    (``spark.sql.files.maxPartitionBytes``) are the tasks, whatever the
    number of files.  A caller whose table is one unsplittable file (one
    row group) may set it to keep several cores busy.  Streams are never
    repartitioned; their batches are bounded.
    """
    n = None if df.isStreaming else df.sparkSession.conf.get(STAGE_PARTITIONS, None)
    if not n:
        return df
    return df.repartition(int(n), key) if key else df.repartition(int(n))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows dealt out evenly before costly work on each, such as rendering and parsing a page;
    by hash of ``keys`` if given, for a join that has to shuffle the rows anyway.

    Their scan is no measure of that work: some MB of parquet, one task,
    hold the rows of hours.  As many partitions as :func:`partitioned` was told, or
    as shuffles have (``spark.sql.shuffle.partitions``)."""
    if df.isStreaming:
        return df
    conf = df.sparkSession.conf
    return df.repartition(int(conf.get(STAGE_PARTITIONS, None) or conf.get("spark.sql.shuffle.partitions")), *keys)
