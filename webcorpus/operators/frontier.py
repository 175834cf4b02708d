"""Link graph and crawl closure.

``crawl_closure`` is a breadth-first search written as a driver loop of
DataFrame joins over bucketed tables in the shared checkpoint folder (see
its docstring): per level, one shuffle of the new candidates only, none of
the edge table or of the nodes seen so far.  The driver only sees one
observed row count per level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, remove_scratch, scratch_path

BROADCAST_HUBS = 100_000    # rows of (node, number of salts); more are joined instead


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Both directions of every edge, from a single pass over the input
    (a union of two projections would scan the source twice)."""
    a, b = F.col(src), F.col(dst)
    both = F.array(F.struct(a.alias("src"), b.alias("dst")), F.struct(b.alias("src"), a.alias("dst")))
    return edges.select(F.explode(both).alias("e")).select("e.src", "e.dst")


def crawl_closure(spark: SparkSession, edges: DataFrame, seeds: DataFrame,
                  max_depth: int | None = None, buckets: int | None = None, hub_edges: int = 1_000_000,
                  symmetric: bool = False) -> DataFrame:
    """G1: every node reachable from ``seeds`` with its BFS depth.

    ``edges``: ``(src, dst)``; ``seeds``: ``(node)``.  Stops when a level
    adds no node, or after ``max_depth`` levels.  Returns ``(node, depth)``,
    each node once, with its smallest depth.

    Storage, both in the shared checkpoint folder:
      * edges, written once, bucketed by ``(src, salt)``.  Out-degrees are
        counted first; a node with more than ``hub_edges`` edges gets one salt
        per ``hub_edges`` of them, so a hub's edges (even a third of all) lie
        in as many buckets as its size asks for, and every other node's in one;
      * seen nodes, one ``depth=<d>`` partition per level, bucketed by
        ``node``.
    Per level, the frontier's hubs are copied once per salt of theirs, the
    other nodes not at all, and shuffled to the edge buckets; the edge table
    is read bucket by bucket and never shuffled.  The new nodes are made
    distinct (partial aggregation first, so a node reached from many places
    is combined map-side) and anti-joined with the seen table, again
    bucket-wise.  With ``symmetric`` edges (every edge in both directions) a
    level's neighbours lie in the levels next to it, so only the last two
    are read and a long chain costs its length.  Each level is one written
    job, which cuts the lineage: a lost executor is recovered from files.
    The edge table is dropped at the end; the levels are the result.
    """
    checkpoint_dir(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag = uuid.uuid4().hex[:12]
    edges_t, seen_t = f"closure_edges_{tag}", f"closure_seen_{tag}"
    base = scratch_path(spark, "closure")
    # read twice below: an extraction behind the edges must not run twice
    edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull()).write.parquet(f"{base}/pairs")
    pairs = spark.read.schema(edges.select("src", "dst").schema).parquet(f"{base}/pairs")
    hubs = pairs.groupBy("src").agg(F.count("*").alias("degree")).where(F.col("degree") > hub_edges) \
        .select("src", F.ceil(F.col("degree") / hub_edges).cast("int").alias("salts"))
    hubs.write.parquet(f"{base}/hubs")
    hubs = spark.read.schema(hubs.schema).parquet(f"{base}/hubs")
    hubs = F.broadcast(hubs) if hubs.count() <= BROADCAST_HUBS else hubs
    salted = pairs.join(hubs, "src", "left").select("src", "dst", F.pmod(F.hash("dst"), F.coalesce("salts", F.lit(1))).alias("salt"))
    # dealt out by (src, salt) first: the duplicates fall away in the same partitions
    (salted.repartition(n, "src", "salt").distinct().write.bucketBy(n, "src", "salt").option("path", f"{base}/edges").saveAsTable(edges_t))

    def write_level(df: DataFrame, d: int) -> int:
        """Append one level; its row count is observed during the write
        (no second job to test for emptiness)."""
        obs = Observation(f"closure_level_{tag}_{d}")
        # already hash-partitioned on node by the distinct/anti join: the
        # bucketed writer needs no extra shuffle
        (df.select("node", F.lit(d).alias("depth")).observe(obs, F.count(F.lit(1)).alias("rows"))
           .write.mode("append")
           .partitionBy("depth").bucketBy(n, "node").option("path", f"{base}/seen").saveAsTable(seen_t))
        return obs.get["rows"]

    try:
        write_level(seeds.select("node").where(F.col("node").isNotNull()).distinct(), 0)
        e = spark.table(edges_t)
        depth = 0
        while max_depth is None or depth < max_depth:
            seen = spark.table(seen_t)
            if symmetric:
                seen = seen.where(F.col("depth") >= depth - 1)
            level = seen.where(F.col("depth") == depth).select("node")
            level = level.join(hubs.withColumnRenamed("src", "node"), "node", "left").select(
                "node", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
            on = (level["node"] == e["src"]) & (level["salt"] == e["salt"])
            nxt = (level.join(e, on).select(F.col("dst").alias("node"))
                        .distinct().join(seen.select("node"), "node", "left_anti"))
            if write_level(nxt, depth + 1) == 0:
                break
            depth += 1
        # read the levels back as plain files: the result outlives the tables
        return spark.read.parquet(f"{base}/seen").select("node", F.col("depth").cast("int").alias("depth"))
    finally:
        # tables over given paths: dropping them leaves the files
        spark.sql(f"DROP TABLE IF EXISTS {edges_t}")
        spark.sql(f"DROP TABLE IF EXISTS {seen_t}")
        for part in ("pairs", "hubs", "edges"):
            remove_scratch(spark, f"{base}/{part}")


def nav_edges(nav: DataFrame) -> DataFrame:
    """``(src_url, dst_url, kind)`` from extracted category links."""
    return nav.where(F.col("reject_reason").isNull() & F.col("target").isNotNull()) \
        .select(F.col("url").alias("src_url"), F.col("target").alias("dst_url"),
                F.lit("category").alias("kind"))


def _ok(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull())


def feed_edges(feed: DataFrame) -> DataFrame:
    """Feed page -> article and feed page -> author."""
    # both edges of an item from one pass (a union would run the extraction twice)
    both = F.array(F.struct(F.col("article_href").alias("dst_url"), F.lit("article").alias("kind")),
                   F.struct(F.col("user_href").alias("dst_url"), F.lit("author").alias("kind")))
    return _ok(feed).select(F.col("url").alias("src_url"), F.explode(both).alias("e")) \
        .select("src_url", "e.dst_url", "e.kind")


def followee_edges(followees: DataFrame) -> DataFrame:
    """Follow list -> followed author page."""
    return _ok(followees).select(F.col("url").alias("src_url"), F.col("user_url").alias("dst_url"),
                                 F.lit("follow").alias("kind"))


def article_list_edges(lists: DataFrame) -> DataFrame:
    """Article list page -> article."""
    return _ok(lists).select(F.col("url").alias("src_url"), F.col("href").alias("dst_url"),
                             F.lit("article").alias("kind"))


def list_pages(df: DataFrame, url_col: str, count_col: str, include_last: bool = True,
               chunk: int = 10_000) -> DataFrame:
    """X10 as rows: ``df`` plus ``page_no`` (1..n, or 1..n-1 without the
    last page) and ``list_url`` = ``<url>/article/list/<page_no>``.

    Expanded in two levels so no row ever holds more than ``chunk`` page
    numbers: first one row per chunk of page numbers, hash-distributed so
    the chunks of one huge author spread over many tasks, then each chunk
    expands to its pages.  (``sequence(1, n)`` in one row would put an
    author holding a third of all articles into one array in one task.)"""
    n = F.col(count_col).cast("long")
    hi = F.greatest(F.coalesce(n if include_last else n - 1, F.lit(0)), F.lit(0))
    n_chunks = F.ceil(hi / F.lit(chunk)).cast("long")
    # chunks, too, are numbered in blocks of at most ``chunk``: three levels reach chunk ** 3 pages
    blocks = F.ceil(n_chunks / F.lit(chunk)).cast("long")
    block_ids = F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(F.least(blocks, F.lit(chunk).cast("long")) - 1, F.lit(0).cast("long"))),
                         lambda b: b < blocks)
    too_many = F.when(blocks > chunk, F.raise_error(F.lit("more list pages than chunk ** 3")))
    df = df.withColumn("_block", F.explode(F.coalesce(too_many.cast("array<bigint>"), block_ids)))
    chunk_ids = F.sequence(F.col("_block") * chunk, F.least((F.col("_block") + 1) * chunk, n_chunks) - 1)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (df.withColumn("_hi", hi).withColumn("_chunk", F.explode(chunk_ids))
                .repartition(parts, F.col(url_col), F.col("_chunk")))
    lo = F.col("_chunk") * chunk + 1
    top = F.least(F.col("_chunk") * chunk + chunk, F.col("_hi"))
    pages = chunks.withColumn("page_no", F.explode(F.sequence(lo, top)))
    return (pages.withColumn("list_url", F.concat(F.col(url_col), F.lit("/article/list/"),
                                                  F.col("page_no").cast("string")))
                 .drop("_hi", "_chunk", "_block"))


def list_page_edges(profiles: DataFrame, include_last: bool = True) -> DataFrame:
    """G2 + X10: author page -> each of its article list pages."""
    ok = _ok(profiles).select("url", "page_count")
    return list_pages(ok, "url", "page_count", include_last).select(
        F.col("url").alias("src_url"), F.col("list_url").alias("dst_url"), F.lit("list").alias("kind"))


def link_edges(*parts: DataFrame) -> DataFrame:
    """Union of edge producers (category, feed, follow, list, article)."""
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out
