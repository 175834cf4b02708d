"""One registered query per operator, over whole tables with production parameters.

The queries derive the contract's columns from the operators' outputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm import chat, collocations, decontamination, labelled, langid, neardup, packing, passages, quality, rules, secrets, sharding, tokenalign, toxicity
from webcorpus.llm.oracle import ORACLE  # noqa: F401  registered beside the queries


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", sharding.row_size().alias("size"),
                         F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.annotate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link_components(_table(spark, sf_dir, "documents"), shingle=4)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"), ["doc_id"])
    count = {k: F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in secrets.STRONG}
    return found.select("doc_id", *count.values(), F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model, ["doc_id"]).withColumn("held_out", labelled.held_out("doc_id"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(_table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.format_turns(turns.unionByName(extra)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.fit(docs, _table(spark, sf_dir, "labels")), ["doc_id"])


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scorer = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, scorer, ["doc_id"]).withColumn("held_out", labelled.held_out("doc_id"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs), ["doc_id"]).withColumn("held_out", labelled.held_out("doc_id"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenalign.align(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_minhash_neardup": op3_minhash_neardup,
    "op4_secret_scans": op4_secret_scans,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_language_id": op11_language_id,
    "op12_collocations": op12_collocations,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
