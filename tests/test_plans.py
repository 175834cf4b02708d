"""Physical-plan properties the design relies on at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from webcorpus.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
# queries whose functions run actions (writes, loops, streams) are left out
ACTIONS = {"json_corpus", "wholetext_scan", "article_info_append", "user_info_append", "mark_after_write",
           "crawl_closure", "stream_extract", "stream_first_seen", "stream_left_anti", "crawl_articles",
           "crawl_visited", "sql_single_row", "corpus_tokens", "visited_refresh", "wholetext_lines", "per_file_outputs",
           "site_closure", "append_twice", "crawl_rejects", "retry_rounds", "frontier_union"}


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - ACTIONS))
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = plan_of(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_native_text_rules_stay_in_the_jvm(spark):
    for key in ("follow_url", "resolve_url", "strip_markup", "drop_blank", "sentence_split", "char_tokens", "visit_key",
                "lenient_int", "kv_map", "first_seen", "reconcile_visited", "severity_route"):
        plan = plan_of(QUERIES[key](spark, SF))
        assert "EvalPython" not in plan and "MapInPandas" not in plan, key


def test_scans_read_only_needed_columns_and_push_filters(spark):
    plan = plan_of(QUERIES["strip_markup"](spark, SF))
    assert re.search(r"ReadSchema: struct<page_id:bigint,html:string>", plan)
    plan = plan_of(QUERIES["forget_keys"](spark, SF))
    assert "EqualTo(event_type,error)" in plan and "GreaterThanOrEqual(value,50.0)" in plan
    plan = plan_of(QUERIES["severity_route"](spark, SF))
    assert re.search(r"ReadSchema: struct<event_id:bigint,event_type:string>", plan)


def test_markup_chain_is_evaluated_once(spark):
    plan = plan_of(QUERIES["drop_blank"](spark, SF))
    # the chain appears in one projection only, not in a pushed-down filter
    assert plan.count("katex--display") == 1


def test_first_seen_combines_before_the_shuffle(spark):
    plan = plan_of(QUERIES["first_seen"](spark, SF))
    assert "partial_min" in plan  # map-side combine: a hot key is one row per partition


@pytest.mark.parametrize("files", [1, 64])
def test_no_exchange_between_scan_and_stage(spark, files):
    """Whatever the number of files, the scan's splits are the tasks unless the caller sets a number."""
    from webcorpus.operators import corpus as C
    from webcorpus.operators import extract as X
    from webcorpus.operators.parallel import STAGE_PARTITIONS
    from webcorpus.session import scratch_path
    path = scratch_path(spark, f"t_files{files}")
    spark.read.parquet(f"{SF}/pages.parquet").repartition(files).write.parquet(path)
    pages = spark.read.parquet(path)
    docs = pages.selectExpr("page_id as doc_id", "html as text")
    stages = [C.strip_markup(pages), C.drop_blank(C.strip_markup(docs, "text", "doc_id")), C.char_tokens(docs), X.article_detail(pages), X.nav_links(pages)]
    assert not any("Exchange" in plan_of(s) for s in stages)
    spark.conf.set(STAGE_PARTITIONS, "8")
    try:
        assert "hashpartitioning(page_id" in plan_of(C.strip_markup(pages))
    finally:
        spark.conf.unset(STAGE_PARTITIONS)


def test_first_seen_never_sorts(spark):
    plan = plan_of(QUERIES["first_seen"](spark, SF))
    assert "SortAggregate" not in plan and "Sort " not in plan


def test_frontier_resolves_urls_in_one_python_node(spark):
    from webcorpus.plans.queries import _frontier
    plan = plan_of(_frontier(spark, SF))
    assert plan.count("ArrowEvalPython") <= 2   # the tree and the details name the one node once each


def test_closure_level_reads_edges_bucketed(spark):
    from webcorpus.session import scratch_path
    n, salts = 8, 4
    base = scratch_path(spark, "t_plan")
    e = spark.createDataFrame([("a", "b")], "src string, dst string").withColumn("salt", F.pmod(F.hash("dst"), F.lit(salts)))
    e.repartition(n, "src", "salt").write.bucketBy(n, "src", "salt").option("path", base + "/e").saveAsTable("t_plan_e")
    spark.createDataFrame([("a", 0)], "node string, depth int").write.partitionBy("depth") \
        .bucketBy(n, "node").option("path", base + "/s").saveAsTable("t_plan_s")
    try:
        seen, edges = spark.table("t_plan_s"), spark.table("t_plan_e")
        level = seen.where(F.col("depth") == 0).select(
            "node", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        nxt = (level.join(edges, (level["node"] == edges["src"]) & (level["salt"] == edges["salt"]))
                    .select(F.col("dst").alias("node")).distinct().join(seen.select("node"), "node", "left_anti"))
        plan = plan_of(nxt)
        exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        # the frontier (node, salt) and the candidates (node) are shuffled; edges and seen are not
        assert len(exchanges) == 2, exchanges
        assert all("src" not in x for x in exchanges)
    finally:
        spark.sql("DROP TABLE IF EXISTS t_plan_e")
        spark.sql("DROP TABLE IF EXISTS t_plan_s")
