"""The crawl's data flow over already fetched pages (E1), batch or stream.

    pages -> P4 ineligible URLs to the reject log
          -> P1 challenge split (W4: retries carry their attempt)
          -> D1 first-seen against the visited set
          -> X7 article extraction -> K2 append records / K8 append rejects
          -> K3 mark visited from the rows the record table now holds

First-seen and the challenge test run *before* the parse: Catalyst cannot
push filters through ``mapInPandas``, so only new content pages reach the
Python stage.  What feeds more than one output (the routed batch without
its HTML, the extracted records) is written once to the shared scratch
folder and removed afterwards; nothing is kept on executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import extract as X
from ..operators import routing as R
from ..operators import visited as V
from ..operators.parallel import dealt
from ..session import path_exists, remove_scratch, scratch_path

#: what is stored of an article: a surrogate id, then the record
ARTICLE_SCHEMA = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(c, T.StringType()) for c in X.ARTICLE_COLUMNS]])
REJECT_SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("stage", T.StringType()),
                              T.StructField("reason", T.StringType()), T.StructField("attempt", T.IntegerType())])
RETRY_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                             T.StructField("attempt", T.IntegerType())])
_BATCH = T.StructField("batch", T.StringType())


@dataclass
class CrawlPaths:
    articles: str   # article_info table (append)
    rejects: str    # rejects(url, stage, reason, attempt) (append)
    retry: str      # challenged pages to fetch again (append)


def surrogate_id(url="url"):
    """The id column of the stored tables: a hash of the URL, the same on every run."""
    return F.xxhash64(url)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of the crawl with its ``batch``; empty if no batch has written it or only empty ones have."""
    full = T.StructType([*schema.fields, _BATCH])
    return spark.read.schema(full).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], full)


def _append(df: DataFrame, path: str, schema: T.StructType, batch_id: str) -> None:
    """One ``batch=<id>`` partition; a batch that runs again replaces its own."""
    (df.select(*schema.names).to(schema).withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def crawl_articles(pages: DataFrame, visited: DataFrame | None, paths: CrawlPaths, batch_id: str,
                   marker: str = R.CHALLENGE_MARKER, max_attempts: int = 3, meta: str = "blog") -> DataFrame:
    """Process one batch of fetched article pages ``(page_id, url, html[, attempt])``.

    Records, rejects and retries go to partition ``batch=<batch_id>`` of
    their tables (dynamic overwrite: re-running a batch replaces it); the
    keys to mark are read back from that partition only, so the cost is
    that of the batch, not of everything stored.  Every page ends in one of
    the three tables, or is a repeat of a visited or earlier page.  Returns
    the *new* visited keys (K3: only keys whose record is stored).
    """
    spark = pages.sparkSession
    routed_path, extracted_path = scratch_path(spark, "routed"), scratch_path(spark, "extracted")
    try:
        # the visit key is made once and read back where it is needed; null for an ineligible URL
        routed = V.keyed_all(R.challenge_split(pages, marker, max_attempts).select("page_id", "url", "route", "next_attempt"))
        routed.write.parquet(routed_path)
        routed = spark.read.schema(routed.schema).parquet(routed_path)
        known = routed.where(F.col("key").isNotNull())
        _append(known.where(F.col("route") == "retry").select("page_id", "url", F.col("next_attempt").alias("attempt")),
                paths.retry, RETRY_SCHEMA, batch_id)
        refused = known.where(F.col("route") == "reject").select(
            "url", F.lit("fetch").alias("stage"), F.lit("challenge page").alias("reason"), F.col("next_attempt").alias("attempt"))
        odd = R.ineligible_rejects(routed.where(F.col("key").isNull()).withColumnRenamed("next_attempt", "attempt"))

        content = known.where(F.col("route") == "content").select("page_id", "url", "key")
        chosen = V.first_seen_rows(V.in_set(content, meta), visited, "page_id").select("page_id", "url")
        # the join's partitions are the extraction's tasks: their number is not cut down to what the bytes suggest
        on = ["page_id", "url"]
        fresh = dealt(pages.select(*on, "html"), *on).join(dealt(chosen, *on).hint("shuffle_hash"), on, "left_semi")
        extracted = X.article_detail(fresh)
        extracted.write.parquet(extracted_path)
        extracted = spark.read.schema(extracted.schema).parquet(extracted_path)
        # one page fetched twice in a batch is one record; the ids tell whether there is any, and records are sorted only then
        if not extracted.groupBy("page_id").count().where("count > 1").isEmpty():
            extracted = extracted.dropDuplicates(["page_id"])
        ok, _ = X.split_rejects(extracted)
        _append(ok.withColumn("id", surrogate_id()), paths.articles, ARTICLE_SCHEMA, batch_id)
        _append(R.rejects_table(extracted, "article").unionByName(refused).unionByName(odd), paths.rejects, REJECT_SCHEMA, batch_id)
    finally:
        remove_scratch(spark, routed_path)
        remove_scratch(spark, extracted_path)
    stored_now = read_table(spark, paths.articles, ARTICLE_SCHEMA).where(F.col("batch") == batch_id)
    return V.keyed(stored_now.select("url"), "url", meta).select(*V.SET_COLS).distinct()


def crawl_articles_stream(spark: SparkSession, page_stream: DataFrame, paths: CrawlPaths,
                          checkpoint: str, visited: V.VisitedTable, meta: str = "blog",
                          trigger: dict | None = None, compact_every: int = 100) -> None:
    """The same step per micro-batch.  The visited set is read fresh
    at every batch; it lies in buckets of its key, so only the batch is
    shuffled for the anti-join.  The batch's new keys are appended once its
    records are stored, and the set is compacted every ``compact_every``
    batches.  Every other table is written per ``batch`` partition with
    dynamic overwrite, so an epoch replayed after a restart replaces its
    own output; its keys are then in the set already, which is why an epoch
    leaves its own keys out of the set it compares with.  Attempts are counted
    here: a page comes with the highest attempt that the retry table of
    earlier epochs holds for its URL, or its own if that is higher."""
    def step(batch: DataFrame, epoch: int):
        sent_back = read_table(spark, paths.retry, RETRY_SCHEMA).where(F.col("batch") != str(epoch))
        batch = R.with_attempts(batch, sent_back)
        seen = visited.read()
        if seen is not None:
            own = read_table(spark, paths.articles, ARTICLE_SCHEMA).where(F.col("batch") == str(epoch)).select("url")
            if not own.isEmpty():  # a replay
                seen = seen.join(V.keyed(own, "url", meta).select(*V.SET_COLS), V.SET_COLS, "left_anti")
        visited.append(crawl_articles(batch, seen, paths, batch_id=str(epoch), meta=meta))
        if epoch % compact_every == compact_every - 1:
            visited.compact()
            visited.vacuum()

    w = page_stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    w = w.trigger(**trigger) if trigger else w.trigger(availableNow=True)
    w.start().awaitTermination()
