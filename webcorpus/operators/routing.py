"""Routing of pages and records: challenge pages, rejects, severity sinks,
and marking keys visited only after their records were written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls as U
from ..session import list_names, path_exists
from . import visited as V

# Fixed value: the marker of an access-challenge page instead of content.
CHALLENGE_MARKER = "arg1"


def challenge_split(pages: DataFrame, marker: str = CHALLENGE_MARKER, max_attempts: int = 3,
                    attempt_col: str = "attempt") -> DataFrame:
    """P1 + W4: ``route`` is ``content`` for a page without the marker,
    ``retry`` (``attempt`` + 1) for a challenged page still under
    ``max_attempts``, else ``reject``."""
    att = F.coalesce(F.col(attempt_col), F.lit(0)) if attempt_col in pages.columns else F.lit(0)
    hit = F.col("html").contains(marker)
    return pages.select(
        "*",
        F.when(~hit | F.col("html").isNull(), F.lit("content"))
         .when(att + 1 < max_attempts, F.lit("retry")).otherwise(F.lit("reject")).alias("route"),
        F.when(hit, att + 1).otherwise(att).cast("int").alias("next_attempt"))


def ineligible_rejects(pages: DataFrame, attempt_col: str = "attempt") -> DataFrame:
    """K8 + P4: the log rows of pages whose URL no visit key can be made of."""
    attempt = F.coalesce(F.col(attempt_col), F.lit(0)) if attempt_col in pages.columns else F.lit(0)
    return pages.where(F.coalesce(~U.is_eligible("url"), F.lit(True))).select(
        "url", F.lit("url").alias("stage"), F.lit("ineligible URL").alias("reason"), attempt.cast("int").alias("attempt"))


def with_attempts(pages: DataFrame, retries: DataFrame) -> DataFrame:
    """Fetched pages with the attempt number that the retry table holds
    for their URL (its highest), or their own if they carry a higher one; 0
    for pages that were never sent back."""
    last = retries.groupBy("url").agg(F.max("attempt").alias("_sent"))
    own = F.coalesce(F.col("attempt"), F.lit(0)) if "attempt" in pages.columns else F.lit(0)
    return (pages.withColumn("_own", own).drop("attempt").join(last.hint("shuffle_hash"), "url", "left")
            .withColumn("attempt", F.greatest("_own", F.coalesce("_sent", F.lit(0))).cast("int")).drop("_own", "_sent"))


def rejects_table(extracted: DataFrame, stage: str, attempt: int = 0) -> DataFrame:
    """K8: ``rejects(url, stage, reason, attempt)`` from an extract output."""
    return extracted.where(F.col("reject_reason").isNotNull()).select(
        "url", F.lit(stage).alias("stage"), F.col("reject_reason").alias("reason"),
        F.lit(attempt).cast("int").alias("attempt"))


def severity_route(records: DataFrame, level_col: str = "level", error_value: str = "error",
                   tee_all: bool = False) -> DataFrame:
    """K9: label each record with its sink.  Intended split: ``error``
    records to the error sink, all others to the main sink.  ``tee_all``
    gives the reference's actual wiring, where the main sink also receives
    the error records (one extra row per error)."""
    is_err = F.coalesce(F.col(level_col).rlike("(?i)^\\Q" + error_value + "\\E$"), F.lit(False))
    if not tee_all:
        return records.withColumn("sink", F.when(is_err, F.lit("error")).otherwise(F.lit("main")))
    # error records go to both sinks, in one pass over the input
    sinks = F.when(is_err, F.array(F.lit("error"), F.lit("main"))).otherwise(F.array(F.lit("main")))
    return records.withColumn("sink", F.explode(sinks))


def write_sinks(routed: DataFrame, path: str, mode: str = "append") -> None:
    """Every sink in one pass -- ``sink=<name>`` folders under
    ``path`` (the error log and the main log are read from their folders)."""
    routed.write.mode(mode).partitionBy("sink").parquet(path)


_WRITES = "write"   # the set's members of this name are the writes whose keys it holds


def _index_writes(spark: SparkSession, table_path: str, schema: T.StructType, url_col: str, meta: str, held: V.VisitedTable) -> None:
    """Add to ``held`` the keys of the table's writes that it does not know, and the writes."""
    names = {n.removeprefix("write=") for n in list_names(spark, table_path) if n.startswith("write=")}
    known = held.read()
    if known is not None:
        names -= {r["key"] for r in known.where(F.col("meta") == _WRITES).select("key").distinct().toLocalIterator()}
    if names:
        new = spark.read.schema(schema).parquet(table_path).where(F.col("write").isin(*names)).select(url_col)
        marks = spark.createDataFrame([(_WRITES, n) for n in sorted(names)], "meta string, key string")
        held.append(V.keyed(new, url_col, meta).select(*V.SET_COLS).distinct().unionByName(marks))


def write_then_mark(records: DataFrame, table_path: str, visited: DataFrame | None,
                    meta: str, url_col: str = "url", mode: str = "append", held: V.VisitedTable | None = None):
    """K3: store the records whose key the table does not hold yet, then mark
    as visited the keys of the rows just stored -- a key never counts as
    visited unless its record was stored.

    Each call writes one ``write=<n>`` partition and reads back that one;
    running the same records again stores nothing.  Without ``held`` the keys
    the table holds are read from its URL column, all of it; ``held`` (a
    :class:`~webcorpus.operators.visited.VisitedTable`) keeps them in buckets,
    so that a call shuffles its batch only.  Writes that ``held`` does not
    know (a job that died before it recorded them) are indexed first.  Of records with one key the smallest row is stored; records
    without a key are not (log them with :func:`ineligible_rejects`).
    Returns ``(stored table, new visited set)``."""
    spark = records.sparkSession
    schema = T.StructType([*records.schema.fields, T.StructField("write", T.StringType())])
    rows = V.keyed(records, url_col, meta)
    rows = rows.groupBy(*V.SET_COLS).agg(F.min(F.struct(*[F.col(c) for c in records.columns])).alias("r"))
    if held is not None:
        _index_writes(spark, table_path, schema, url_col, meta, held)
        stored_keys = held.read()
    elif path_exists(spark, table_path):
        stored_keys = V.keyed(spark.read.schema(schema).parquet(table_path).select(url_col), url_col, meta).select(*V.SET_COLS).distinct()
    else:
        stored_keys = None
    if stored_keys is not None:
        rows = rows.join(stored_keys, V.SET_COLS, "left_anti")
    write = uuid.uuid4().hex
    (rows.select("r.*").withColumn("write", F.lit(write)).write.mode(mode).partitionBy("write").parquet(table_path))
    if held is not None:
        _index_writes(spark, table_path, schema, url_col, meta, held)
    table = spark.read.schema(schema).parquet(table_path)
    written = V.keyed(table.where(F.col("write") == write).select(url_col), url_col, meta).select(*V.SET_COLS).distinct()
    stored = table.drop("write")
    if visited is None:
        return stored, written
    return stored, V.mark(visited, written)
