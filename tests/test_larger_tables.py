"""The work of the profile queries and the crawl step grows with their rows only."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from webcorpus.functions import urls as U
from webcorpus.plans import crawl as CR
from webcorpus.plans import queries as Q
from webcorpus.plans import render as RD
from webcorpus.session import scratch_path

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
CUSTOMERS = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _orders(spark, n):
    return spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"),
                                 F.lit("2020-01-02").cast("timestamp").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")).to(spark.createDataFrame([], ORDERS).schema)


def _crawl(spark, pages, name):
    base = scratch_path(spark, name)
    paths = CR.CrawlPaths(base + "/articles", base + "/rejects", base + "/retry")
    CR.crawl_articles(pages, None, paths, batch_id="0")
    return CR.read_table(spark, paths.articles, CR.ARTICLE_SCHEMA), CR.read_table(spark, paths.rejects, CR.REJECT_SCHEMA)


@pytest.mark.parametrize("name", ["badges_join", "page_count"])
def test_profiles_of_one_small_file_are_read_by_many_tasks(spark, name):
    folder = scratch_path(spark, "t_customers")
    rows = [(i, f"Customer#{i}", i % 25, 10.5 * i, "BUILDING") for i in range(1, 41)]
    spark.createDataFrame(rows, CUSTOMERS).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    out, plan = Q.QUERIES[name](spark, folder), io.StringIO()
    with contextlib.redirect_stdout(plan):
        out.explain()
    below = plan.getvalue().split("Exchange RoundRobinPartitioning(8)")  # the session's shuffle partitions
    assert len(below) == 2 and "asideProfile" in below[0] and "asideProfile" not in below[1]  # narrow rows cross it, pages do not
    assert out.count() == 40 and out.where("reject_reason is null").count() == sum(i % 7 > 0 and i % 11 > 0 and i % 13 > 0 for i in range(1, 41))


def test_records_are_sorted_only_where_pages_repeat(spark, monkeypatch):
    """One page fetched twice is one record; a batch of different pages is not shuffled and sorted to find that out."""
    kind = type(spark.range(0))
    sorts, drop = [], kind.dropDuplicates
    monkeypatch.setattr(kind, "dropDuplicates", lambda self, *a: (sorts.append(a), drop(self, *a))[1])
    pages = RD.article_pages(_orders(spark, 60))
    stored, rejects = _crawl(spark, pages, "t_once")
    assert not sorts
    once = sorted(map(str, stored.collect())), sorted(map(str, rejects.collect()))
    assert len(once[0]) + len(once[1]) == 60 and once[1]
    stored, rejects = _crawl(spark, pages.unionByName(pages.where("page_id % 2 = 0")), "t_more")
    assert sorts and (sorted(map(str, stored.collect())), sorted(map(str, rejects.collect()))) == once


def test_visit_keys_are_made_once(spark, monkeypatch):
    """The routed batch holds the key of every page, null where there is none."""
    kept = []
    monkeypatch.setattr(CR, "remove_scratch", lambda _, path: kept.append(path))
    made, visit_key = [], U.visit_key
    monkeypatch.setattr(U, "visit_key", lambda *a: (made.append(a), visit_key(*a))[1])
    _, rejects = _crawl(spark, RD.faulty_article_pages(_orders(spark, 60)), "t_keys")
    routed = spark.read.parquet(next(p for p in kept if "routed" in p))
    assert routed.count() == 60 and routed.where(~F.col("key").eqNullSafe(visit_key("url"))).count() == 0
    assert routed.where("key is null").count() == rejects.where("stage = 'url'").count() == 4
    assert len(made) == 2  # of the batch, and of what is stored
