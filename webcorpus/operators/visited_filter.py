"""A partitioned Bloom filter beside a visited set.

A key's hash names one of ``blocks`` small filters and ``PROBES`` bits in it.
A table holds one row per block, ``(block, bits)``, some 16 bits a key, so a
batch meets one short row per key instead of the history: keys that the
filter does not know are new for sure and take no part in the join with
the stored set.  Everything is native expressions; filters of two sets
are merged by OR, so appends do not read the history either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .visited import SET_COLS, is_member

PROBES = 6
WORDS = 128            # 64-bit words of a block: 1 KB
BITS_PER_KEY = 16


def blocks_for(keys: int) -> int:
    """Blocks that give ``keys`` keys :data:`BITS_PER_KEY` bits each."""
    return max(1, -(-keys * BITS_PER_KEY // (64 * WORDS)))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64(*SET_COLS), F.lit(blocks)).cast("int")


def _probes() -> Column:
    """The places of a key's bits in its block."""
    return F.array(*[F.pmod(F.xxhash64(*SET_COLS, F.lit(i)), F.lit(64 * WORDS)).cast("int") for i in range(1, PROBES + 1)])


def _joined(words: DataFrame) -> DataFrame:
    """(block, bits) of (block, word, bits) rows; a block's bits are an array of all its words."""
    once = words.groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    found = once.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))   # at most WORDS entries
    return found.select("block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long"))).alias("bits"))


def build(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of ``(meta, key)`` rows; repeats do no harm, null keys are left out."""
    spots = keys.where(F.col("key").isNotNull() & F.col("meta").isNotNull()).select(_block(blocks).alias("block"), F.explode(_probes()).alias("p"))
    return _joined(spots.select("block", F.floor(F.col("p") / 64).cast("int").alias("word"),
                                F.expr("shiftleft(1L, p % 64)").alias("bits")))


def merge(*filters: DataFrame) -> DataFrame:
    """The filter of all the keys of filters with the same number of blocks."""
    parts = [f.select("block", F.posexplode("bits").alias("word", "bits")).where("bits != 0") for f in filters]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _joined(out)


def maybe_known(candidates: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """``candidates`` with ``maybe``: false for keys that are in no set for sure (null keys among them)."""
    found = candidates.withColumn("_block", _block(blocks)).join(filter_.select(F.col("block").alias("_block"), "bits"), "_block", "left")
    hit = F.forall(_probes(), lambda p: F.get("bits", F.floor(p / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p % 64)) != 0)
    known = F.col("key").isNotNull() & F.col("meta").isNotNull() & F.col("bits").isNotNull()
    return found.withColumn("maybe", F.coalesce(F.when(known, hit), F.lit(False))).drop("_block", "bits")


def is_member_filtered(candidates: DataFrame, visited: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """D3: as ``is_member``, with only those candidates in the join that the filter may know."""
    told = maybe_known(candidates, filter_, blocks)
    new = told.where(~F.col("maybe")).drop("maybe").withColumn("is_member", F.lit(False))
    return is_member(told.where("maybe").drop("maybe"), visited).unionByName(new)
