"""Building a corpus from stored articles, and keeping the
visited sets in step with the stored records.

E2 is one lazy plan per output -- scan, project the body, strip markup,
drop blank documents, then JSON Lines and sentence/character tokens --
with no files in between and no shuffle (beyond spreading a small input
over the cores).  E3 is two scans and one join: the stale keys are
reported, the kept ones become the next version of the set, written to a
new versioned path that readers switch to only after the write succeeded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import corpus as C
from ..operators import visited as V


@dataclass
class CorpusPaths:
    json: str      # K4: JSON Lines of the cleaned documents
    tokens: str    # T9: (doc_id, sent_no, line) parquet


def build_corpus(articles: DataFrame, paths: CorpusPaths, id_col: str = "doc_id",
                 content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """S3/R2 -> T1-T3 -> P6 -> K4 and T8/T9.  Returns the two written
    tables read back (cleaned documents, character-token lines)."""
    docs = C.drop_blank(C.strip_markup(articles.select(id_col, content_col), content_col, id_col, "text"))
    docs = docs.withColumnRenamed(id_col, "doc_id")
    C.write_json_corpus(docs, paths.json)
    spark = articles.sparkSession
    cleaned = C.read_json_corpus(spark, paths.json)
    # tokens from the written corpus: the cleaning is not computed twice
    C.char_tokens(cleaned).write.mode("overwrite").parquet(paths.tokens)
    return cleaned, spark.read.parquet(paths.tokens)


def refresh_visited(visited: DataFrame, stored: DataFrame, meta: str, base_path: str, version: str,
                    url_col: str = "url") -> tuple[str, DataFrame]:
    """D4 + D5 + K7: reconcile one named set with the stored records and
    write its next version (kept keys only).  Returns the new version's
    path and the report of stale keys (read from the written version's
    complement, so it is exactly what was left out)."""
    status = V.reconcile(visited, stored, meta, url_col)
    path = V.snapshot(status.where(F.col("status") == "kept").select("meta", "key"), base_path, version)
    return path, status.where(F.col("status") == "stale").select("meta", "key")
