"""Streams: same result as batch, several micro-batches, restart from the
checkpoint without duplicates."""


from pyspark.sql import functions as F

from webcorpus.operators import extract as X
from webcorpus.operators.visited import VisitedTable
from webcorpus.session import scratch_path
from webcorpus.sources.tables import PAGE_SCHEMA
from webcorpus.streaming import stream as W

SF = "/root/testdata/sf0.001"


def _split_events(spark, base, parts):
    """Write the events table as several files so a stream sees several batches."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    for i in range(parts):
        ev.where(F.col("event_id") % parts == i).coalesce(1).write.mode("overwrite").parquet(f"{base}/part{i}")
    return ev


def test_stream_first_seen_batches_and_restart(spark):
    base = scratch_path(spark, "t_stream_src")
    ev = _split_events(spark, base, 4)
    schema = ev.schema
    out, ck = W.new_locations(spark, "t_stream_fs")

    def keyed(stream):
        return stream.select(F.col("event_type").alias("meta"),
                             F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"))

    # first run sees two of the four folders, one file per micro-batch
    s1 = W.read_stream(spark, f"{base}/part[01]/*.parquet", schema, max_files_per_trigger=1)
    W.run_to_table(W.stream_first_seen(keyed(s1)), out, ck)
    first = spark.read.parquet(out).drop("batch_id").count()
    # restart on the same checkpoint over all folders: old files are not re-read
    s2 = W.read_stream(spark, f"{base}/part[01]/*.parquet", schema, max_files_per_trigger=1)
    W.run_to_table(W.stream_first_seen(keyed(s2)), out, ck)
    assert spark.read.parquet(out).drop("batch_id").count() == first
    got = spark.read.parquet(out).drop("batch_id")
    assert got.count() == got.distinct().count()
    expect = keyed(ev.where(F.col("event_id") % 4 < 2)).distinct()
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_stream_extract_equals_batch(spark):
    s = W.read_stream(spark, f"{SF}/pages*.parquet", PAGE_SCHEMA)
    out, ck = W.new_locations(spark, "t_stream_x")
    W.run_to_table(X.article_titles(s), out, ck)
    batch = X.article_titles(spark.read.parquet(f"{SF}/pages.parquet"))
    got = spark.read.parquet(out).drop("batch_id")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_stream_first_seen_within_watermark(spark):
    base = scratch_path(spark, "t_stream_wm")
    ev = _split_events(spark, base, 2)
    s = W.read_stream(spark, f"{base}/part*/*.parquet", ev.schema, max_files_per_trigger=1)
    keyed = s.select("ts", F.col("event_type").alias("meta"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"))
    out, ck = W.new_locations(spark, "t_stream_wm_out")
    W.run_to_table(W.stream_first_seen(keyed, "ts", "1000 days").drop("ts"), out, ck)
    got = spark.read.parquet(out).drop("batch_id")
    assert got.count() == got.distinct().count() == ev.select("event_type", "user_id").distinct().count()


def test_crawl_stream_restart_processes_only_new_pages(spark):
    from webcorpus.plans import crawl as CR
    from webcorpus.plans import render as RD

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    pages = RD.article_pages(orders)
    src = scratch_path(spark, "t_crawl_src")
    pages.where(F.col("page_id") % 2 == 0).coalesce(1).write.parquet(f"{src}/a")
    base = scratch_path(spark, "t_crawl")
    paths = CR.CrawlPaths(base + "/articles", base + "/rejects", base + "/retry")
    ck, visited = base + "/ck", VisitedTable(spark, scratch_path(spark, "t_crawl_visited"))
    CR.crawl_articles_stream(spark, W.read_stream(spark, f"{src}/*/*.parquet", PAGE_SCHEMA), paths, ck, visited)
    first = spark.read.parquet(paths.articles).count()
    # new pages arrive (including every old one again): only unseen keys are processed
    pages.coalesce(1).write.parquet(f"{src}/b")
    CR.crawl_articles_stream(spark, W.read_stream(spark, f"{src}/*/*.parquet", PAGE_SCHEMA), paths, ck, visited)
    stored = spark.read.parquet(paths.articles)
    batch_ok = X.article_detail(pages).where("reject_reason IS NULL")
    assert stored.count() == batch_ok.count() > first
    assert stored.select("url").distinct().count() == stored.count()   # no page stored twice
    assert visited.read().count() == visited.read().distinct().count() == stored.count()
    visited.drop()
    # a rejected page is never marked visited, so it is tried again when it arrives again
    rejects = spark.read.parquet(paths.rejects)
    bad_all = X.article_detail(pages).where("reject_reason IS NOT NULL")
    bad_even = bad_all.where(F.col("page_id") % 2 == 0)
    assert rejects.count() == bad_all.count() + bad_even.count()
    assert rejects.select("url").distinct().count() == bad_all.count()


def test_replayed_batch_is_not_doubled(spark):
    from webcorpus.plans import crawl as CR
    from webcorpus.plans import render as RD

    pages = RD.article_pages(spark.read.parquet(f"{SF}/orders.parquet"))
    base = scratch_path(spark, "t_replay")
    paths = CR.CrawlPaths(base + "/articles", base + "/rejects", base + "/retry")
    CR.crawl_articles(pages, None, paths, batch_id="7")
    once = (spark.read.parquet(paths.articles).count(), spark.read.parquet(paths.rejects).count())
    CR.crawl_articles(pages, None, paths, batch_id="7")       # the same epoch again, as after a restart
    assert (spark.read.parquet(paths.articles).count(), spark.read.parquet(paths.rejects).count()) == once


def test_first_batch_that_stores_nothing(spark):
    """Only challenge pages and odd URLs: every table can be read, later pages go on."""
    from webcorpus.plans import crawl as CR
    from webcorpus.plans import render as RD
    from webcorpus.sources.tables import FETCHED_SCHEMA

    src, base = scratch_path(spark, "t_empty_src"), scratch_path(spark, "t_empty")
    rows = [(1, "https://x.net/a", "arg1", 0), (2, "ftp://x.net/b", "<p>x</p>", None), (3, "https://x.net/c", "arg1", 2), (4, None, None, None)]
    spark.createDataFrame(rows, FETCHED_SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    paths = CR.CrawlPaths(base + "/articles", base + "/rejects", base + "/retry")
    visited = VisitedTable(spark, scratch_path(spark, "t_empty_visited"))
    for _ in range(2):
        CR.crawl_articles_stream(spark, W.read_stream(spark, f"{src}/*/*.parquet", FETCHED_SCHEMA), paths, base + "/ck", visited)
    assert CR.read_table(spark, paths.articles, CR.ARTICLE_SCHEMA).count() == 0 and visited.read().count() == 0
    assert [tuple(r)[:3] for r in CR.read_table(spark, paths.retry, CR.RETRY_SCHEMA).collect()] == [(1, "https://x.net/a", 1)]
    rejects = CR.read_table(spark, paths.rejects, CR.REJECT_SCHEMA).collect()
    assert sorted((str(r.url), r.stage, r.attempt) for r in rejects) == [("None", "url", 0), ("ftp://x.net/b", "url", 0), ("https://x.net/c", "fetch", 3)]
    pages = RD.article_pages(spark.read.parquet(f"{SF}/orders.parquet")).withColumn("attempt", F.lit(0))
    pages.limit(50).coalesce(1).write.parquet(f"{src}/b")
    CR.crawl_articles_stream(spark, W.read_stream(spark, f"{src}/*/*.parquet", FETCHED_SCHEMA), paths, base + "/ck", visited)
    assert CR.read_table(spark, paths.articles, CR.ARTICLE_SCHEMA).count() == visited.read().count() > 30
    visited.drop()


def test_page_fetched_twice_in_a_batch_is_one_record(spark):
    from webcorpus.plans import crawl as CR
    from webcorpus.plans import render as RD

    pages = RD.article_pages(spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey < 60"))
    base = scratch_path(spark, "t_twice")
    paths = CR.CrawlPaths(base + "/articles", base + "/rejects", base + "/retry")
    new = CR.crawl_articles(pages.unionByName(pages), None, paths, batch_id="0")
    stored = CR.read_table(spark, paths.articles, CR.ARTICLE_SCHEMA)
    assert stored.count() == stored.select("id").distinct().count() == new.count() > 0


def test_a_broken_visited_set_fails_the_batch(spark):
    import pytest

    class Broken(VisitedTable):
        def read(self):
            raise OSError("no permission")

    src, base = scratch_path(spark, "t_broken_src"), scratch_path(spark, "t_broken")
    spark.createDataFrame([(1, "https://x.net/a", "<p>x</p>")], PAGE_SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    from webcorpus.plans import crawl as CR
    paths = CR.CrawlPaths(base + "/articles", base + "/rejects", base + "/retry")
    with pytest.raises(Exception):
        CR.crawl_articles_stream(spark, W.read_stream(spark, f"{src}/*/*.parquet", PAGE_SCHEMA), paths, base + "/ck", Broken(spark, scratch_path(spark, "t_none")))


def test_a_page_challenged_for_ever_is_given_up(spark):
    """The stream counts attempts itself: its pages carry none."""
    from webcorpus.plans import crawl as CR

    src, base = scratch_path(spark, "t_forever_src"), scratch_path(spark, "t_forever")
    paths = CR.CrawlPaths(base + "/articles", base + "/rejects", base + "/retry")
    visited = VisitedTable(spark, scratch_path(spark, "t_forever_visited"))
    for n in range(3):
        spark.createDataFrame([(1, "https://x.net/a", "arg1")], PAGE_SCHEMA).coalesce(1).write.parquet(f"{src}/{n}")
        CR.crawl_articles_stream(spark, W.read_stream(spark, f"{src}/*/*.parquet", PAGE_SCHEMA), paths, base + "/ck", visited)
    assert sorted(r.attempt for r in CR.read_table(spark, paths.retry, CR.RETRY_SCHEMA).collect()) == [1, 2]
    assert [(r.reason, r.attempt) for r in CR.read_table(spark, paths.rejects, CR.REJECT_SCHEMA).collect()] == [("challenge page", 3)]
