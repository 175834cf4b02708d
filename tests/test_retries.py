"""The requeue as a stateful stream: restarts, timers, pages that come late."""

import time

import pytest
from pyspark.sql import functions as F

from webcorpus.session import scratch_path
from webcorpus.sources.tables import PAGE_SCHEMA
from webcorpus.streaming import retries as RT
from webcorpus.streaming import stream as W


@pytest.fixture(autouse=True)
def few_partitions(spark):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", was)


def run(spark, base, rows, n, **options):
    """One more start of the same stream with new pages; what that start put out."""
    src = f"{base}/src"
    spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1).write.parquet(f"{src}/part{n}")
    s = W.read_stream(spark, f"{src}/*/*.parquet", PAGE_SCHEMA)
    W.run_to_table(RT.requeue(s, **options).withColumn("start", F.lit(n)), f"{base}/out", f"{base}/ck")
    got = spark.read.parquet(f"{base}/out").where(F.col("start") == n)
    return sorted((r.page_id or -1, r.url, r.route, r.attempt, r.visited) for r in got.collect())


def test_attempts_survive_restarts(spark):
    base, bad = scratch_path(spark, "t_requeue"), "<p>arg1</p>"
    assert run(spark, base, [(1, "a", bad), (2, "b", "<p>x</p>"), (3, "c", None), (4, "d", bad), (5, "d", bad)], 1) == [
        (1, "a", "retry", 1, False), (2, "b", "content", 0, False), (3, "c", "content", 0, False), (4, "d", "retry", 1, False), (5, "d", "retry", 1, False)]
    assert run(spark, base, [(1, "a", bad), (4, "d", "<p>y</p>")], 2) == [(1, "a", "retry", 2, False), (4, "d", "content", 1, False)]
    assert run(spark, base, [(1, "a", bad), (5, "d", bad), (2, "b", "<p>x</p>")], 3) == [
        (1, "a", "reject", 3, False), (2, "b", "content", 0, True), (5, "d", "retry", 2, True)]


def test_a_timer_reports_what_is_due(spark):
    base, got = scratch_path(spark, "t_due"), []
    rows = [(1, "a", "arg1"), (2, "b", "fine")]
    spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1).write.parquet(f"{base}/src/part1")
    s = W.read_stream(spark, f"{base}/src/*/*.parquet", PAGE_SCHEMA)
    q = (RT.requeue(s, retry_after_ms=1).writeStream.foreachBatch(lambda df, _: got.extend(df.collect()))
         .option("checkpointLocation", f"{base}/ck").trigger(processingTime="1 second").start())
    try:
        end = time.time() + 120
        while time.time() < end and not any(r.route == "due" for r in got) and q.isActive:
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted((r.page_id, r.url, r.route, r.attempt) for r in got if r.route != "due") == [(1, "a", "retry", 1), (2, "b", "content", 0)]
    assert [(r.page_id, r.url, r.attempt) for r in got if r.route == "due"] == [(None, "a", 1)]
