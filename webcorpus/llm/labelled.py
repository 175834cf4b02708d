"""Labelled documents, and bounded samples of them, for the trained operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm import textwords as W


def held_out(id_col: str, folds: int = 5):
    """Column: crc32 of the id as text leaves remainder 0 (a null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(W.quoted(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def known(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of all labelled ids that are not held out, each once with its larger label; no null ids or labels."""
    return (labels.where(W.quoted(id_col).isNotNull() & W.quoted(label_col).isNotNull())
            .select(W.quoted(id_col).alias("id"), W.quoted(label_col).cast("int").alias("label"))
            .where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label")))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, *, id_col: str = "doc_id",
           text_col: str = "text", per_class: bool = False, seed: int = 5) -> DataFrame:
    """(id, text, label) of at most ``rows`` labelled documents that are not held out.

    Rows are chosen by a seeded hash of their id, ``rows // 2`` of each
    label with ``per_class``.  The chosen ids number at most ``rows``, so
    they are broadcast and the documents are filtered in their scan.  Null
    labels and null ids are left out; of contradicting labels of one id the
    larger counts.
    """
    ranked = known(labels, label_col, id_col).withColumn("h", F.xxhash64(F.lit(seed), F.col("id").cast("string")))
    if per_class:
        ids = ranked.where("label = 0").orderBy("h", "id").limit(rows // 2).unionByName(ranked.where("label != 0").orderBy("h", "id").limit(rows // 2))
    else:
        ids = ranked.orderBy("h", "id").limit(rows)
    texts = docs.select(W.quoted(id_col).alias("id"), W.quoted(text_col).alias("text"))
    return texts.join(F.broadcast(ids.select("id", "label")), "id")
