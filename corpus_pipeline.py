"""Documents to packed training sequences: each stage calls one operator of ``webcorpus.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but
the last return the columns of documents, other columns included.

Ids name documents: rows that share an id stay or go together in the
near-duplicate stage.  Null texts pass as empty ones, empty tables give
empty tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from webcorpus.llm import decontamination, neardup, packing, quality, secrets
from webcorpus.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on their labels, accepts."""
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model, docs.columns, accepted_only=True)


def near_duplicates_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return neardup.deduplicate(docs, shingle=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that hold benchmark passages."""
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts masked."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token ids in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", accepted),
    ("minhash_neardup", near_duplicates_removed),
    ("benchmark_decontamination", decontaminated),
    ("secret_scans", secrets_masked),
    ("packing", packed),
]

#: A trained model, minhash components and tokenising are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's rows go through a written table in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
