"""Random shards by a two-pass external shuffle.

Pass one scatters the rows into buckets by a seeded hash of id and text;
the number of buckets follows from the table's bytes, so that each fits a
task's memory.  Pass two brings a bucket into a canonical order, shuffles
it with Fisher-Yates under the bucket's own seed and writes it.  The
buckets in order are one uniformly shuffled table; shard k of n is the
k-th of n runs of it whose lengths differ by one row at most (law ``rows``).

The result depends on the rows and the seed alone: a task that is run
again writes the same bucket.

Defined results: a null text has size 8 and the checksum of no bytes (0).
Rows that are equal in id and text are interchangeable and fall into one
bucket.  An empty table gives empty shards.  Columns of the table that are
named ``shard`` or ``slot`` give way to the operator's.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W
from webcorpus.session import scratch_path

BUCKET_BYTES = 24 << 20
OWN = ("shard", "slot")
BROADCAST_BUCKETS = 1 << 18   # offsets of more buckets than these are joined, not broadcast
ROW_BYTES = 8          # counted for a row besides its text


def row_size(text_col: str = "text"):
    """UTF-8 bytes of the text plus :data:`ROW_BYTES`."""
    return F.coalesce(F.octet_length(W.quoted(text_col)), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def scatter(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
            bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Both passes: the table, all columns, written to ``path`` with ``__bucket`` and ``__place`` (from 0, shuffled)."""
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in OWN]
    total = docs.select(F.sum(row_size(text_col)).alias("s")).first()["s"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    where = F.pmod(F.xxhash64(F.lit(seed), W.quoted(id_col), W.quoted(text_col)), F.lit(buckets)).cast("int")
    src = docs.select(*[W.quoted(c).alias(f"c{i}") for i, c in enumerate(columns)], where.alias("bucket"),
                      W.quoted(id_col).alias("o1"), F.xxhash64(W.quoted(text_col)).alias("o2"))
    src = src.repartitionById(buckets, "bucket").sortWithinPartitions("o1", "o2")
    n = len(columns)
    out = T.StructType([*src.schema.fields[:n + 1], T.StructField("place", T.LongType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        batches = list(batches)  # one bucket, about bucket_bytes
        if not batches:
            return
        table = pa.Table.from_batches(batches).select([*range(n + 1)])
        bucket = table.column(n)[0].as_py()
        order = np.arange(table.num_rows)
        np.random.default_rng([seed, bucket]).shuffle(order)  # Fisher-Yates
        for lo in range(0, len(order), 1024):
            part = table.take(pa.array(order[lo:lo + 1024])).append_column("place", pa.array(np.arange(lo, min(lo + 1024, len(order))), pa.int64()))
            yield from part.cast(schema).combine_chunks().to_batches()

    got = src.mapInArrow(run, out).toDF(*columns, "__bucket", "__place")
    got.write.parquet(path)
    return spark.read.schema(got.schema).parquet(path)


def shards(scattered: DataFrame, n_shards: int) -> DataFrame:
    """The scattered table with ``shard`` and ``slot`` (gapless from 0 in each shard) instead of bucket and place."""
    sizes = scattered.groupBy(F.col("__bucket").alias("bucket")).agg(F.count("*").alias("n"))
    seen = sizes.agg(F.sum("n").alias("rows"), F.count("*").alias("buckets")).first()
    rows = seen["rows"] or 1
    # one short row per BUCKET_BYTES of the table
    before = sizes.select(F.col("bucket").alias("__bucket"), (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("__first"))
    if seen["buckets"] <= BROADCAST_BUCKETS:
        before = F.broadcast(before)
    # run k starts at row floor(k * rows / n_shards)
    out = scattered.join(before, "__bucket").withColumn("__rank", F.col("__first") + F.col("__place"))
    out = out.withColumn("shard", F.expr(f"cast(((__rank + 1) * {n_shards}L - 1) div {rows}L as int)"))
    out = out.withColumn("slot", F.expr(f"__rank - (shard * {rows}L) div {n_shards}L"))
    return out.drop("__bucket", "__place", "__first", "__rank")


def shard(docs: DataFrame, n_shards: int, *, path: str | None = None, **options) -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot``; the shuffled buckets are files under ``path``."""
    return shards(scatter(docs, path or scratch_path(docs.sparkSession, "shards"), **options), n_shards)
