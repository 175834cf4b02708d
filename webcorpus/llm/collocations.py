"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: for each word its lead columns, the
words that follow it in its piece of text, padded behind the piece's end.
Spark's ROLLUP then sums the counts of all shorter prefixes, so phrases of
every length and the word total of a language come from one counted table
and no n-gram of another length is ever emitted.

A phrase that occurs ``least`` times has only words and neighbouring words
that do so, too.  So one pass first counts words and pairs of neighbours
under 64-bit hashes; those that reach ``least`` go into a Bloom filter,
sized by their number up to ``FILTER_BITS``, and a window ends (is padded)
where a word or a pair is not in it.  That loses no phrase: a filter
that is too small lets more windows through and costs time, not results.

Words are compared by 64-bit hashes of their bytes; their text is joined to
the ranked phrases.  Products are decimals of 38 digits, divided exactly.

Defined results: A-Z count as a-z; a null text has no words; rows with a
null language belong to ``und``; each repeated row counts; languages
without a candidate give no rows; phrases never cross ``.,;:!?``, a line end
or the end of a row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W
from webcorpus.llm.scratch import Scratch

LONGEST = 5
LEAST = 100
TOP = 2000
KEEP_PERCENT = 100             # a candidate goes if a longer one around it reaches this share of its count
CHUNK_BYTES = 2 << 20
WINDOW_BLOCK = 1 << 18         # windows built at a time
FILTER_BITS = 1 << 28          # the Bloom filter's largest size: 32 MB
BLOCK_BYTES = 1 << 15          # of the filter, in the table it is gathered from
U64 = np.uint64
_BREAKS = [*b".,;:!?", *range(0x0A, 0x0E)]
_IN_PIECE = W.byte_class(_BREAKS)
_IN_WORD = W.byte_class([0x20, 0x09, *_BREAKS])
LEADS = [f"w{i}" for i in range(1, LONGEST + 1)]


class _Chunk:
    """Words of a chunk of texts: hash, hash of their row's language, whether the next word follows in the same piece."""

    def __init__(self, text, lang):
        data, offsets = W.text_buffers(text)
        self.low = W.LOWER[data]
        self.starts, self.ends, off = W.find_words(self.low, offsets, _IN_WORD)
        self.words = W.hash_words(self.low, self.starts, self.ends)
        self.words[self.words == 0] = 1  # 0 is the pad
        names = lang.dictionary_encode()
        self.names, code = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False)
        raw = [n.encode() for n in self.names]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        joined = np.frombuffer(b"".join(raw), dtype=np.uint8)
        tags = W.hash_words(joined, np.r_[0, ends[:-1]], ends) if len(joined) else np.ones(len(raw), dtype=U64)
        tags = W.mix(tags + U64(0x51ED27))  # a word may be spelt like a language
        self.code = np.repeat(code.astype(np.int32), np.diff(off))
        self.tag = tags[self.code] if len(self.code) else np.zeros(0, dtype=U64)
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))
        piece = np.searchsorted(np.flatnonzero(~_IN_PIECE[data]), self.starts)
        self.followed = np.zeros(len(self.words), dtype=bool)
        self.followed[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of each word, and of each word with its follower (of followed words only)."""
        at = np.flatnonzero(self.followed)
        return W.mix(self.words ^ self.tag), W.mix(self.words[at] * U64(3) + self.words[at + 1] + self.tag[at])


def _rows_of(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(W.quoted(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(W.quoted(text_col).cast("string"), F.lit("")).alias("text"))


def _frequent(rows: DataFrame, least: int) -> DataFrame:
    """(unit, lang, hash, word) of the words and the pairs of neighbours (word null) that occur often enough."""
    out = T.StructType([T.StructField("unit", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("hash", T.LongType()),
                        T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in W.regroup(batches, 1, CHUNK_BYTES):
            c = _Chunk(batch.column(1), batch.column(0))
            words, pairs = c.units()
            unit, at, n = np.unique(words, return_index=True, return_counts=True)
            raw = c.low.tobytes()
            texts = [raw[a:b] for a, b in zip(c.starts[at].tolist(), c.ends[at].tolist())]
            lang = pa.array(c.names, pa.string()).take(pa.array(c.code[at]))
            yield pa.RecordBatch.from_arrays([pa.array(unit.view(np.int64)), lang, pa.array(c.words[at].view(np.int64)),
                                              pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n)], names=out.names)
            unit, n = np.unique(pairs, return_counts=True)
            nothing = [pa.nulls(len(unit), t) for t in (pa.string(), pa.int64(), pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(unit.view(np.int64)), *nothing, pa.array(n)], names=out.names)

    counted = rows.mapInArrow(run, out).groupBy("unit", "lang", "hash", "word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least).drop("n")


def _places(units: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each unit."""
    return units & U64(mask), (units >> U64(32)) * U64(0x9E3779B1) + U64(7) & U64(mask)


def _bloom(frequent: DataFrame, max_bits: int) -> np.ndarray:
    """The units as a bit filter, 16 bits each and ``max_bits`` at most, joined in Spark block by block."""
    wanted = 16 * max(1, frequent.count())
    bits = min(max_bits, max(8 * BLOCK_BYTES, 1 << (wanted - 1).bit_length()))
    out = T.StructType([T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        held = np.zeros(bits, dtype=bool)
        for batch in batches:
            for place in _places(batch.column(0).to_numpy().view(U64), bits - 1):
                held[place.astype(np.int64)] = True
        packed = np.packbits(held).reshape(-1, BLOCK_BYTES)
        full = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array([packed[i].tobytes() for i in full], pa.binary())], names=out.names)

    def joined(parts):
        import pyarrow as pa

        held = np.zeros(BLOCK_BYTES, dtype=np.uint8)
        for part in parts["bits"].to_pylist():
            held |= np.frombuffer(part, dtype=np.uint8)
        return pa.table([parts["block"][:1], pa.array([held.tobytes()], pa.binary())], names=out.names)

    # parts that many tasks made are joined in two steps, so that none reads a part of every task
    parts = frequent.select("unit").mapInArrow(run, out).withColumn("way", F.pmod(F.spark_partition_id(), F.lit(64)))
    once = parts.groupBy("block", "way").applyInArrow(joined, out)
    packed = np.zeros((bits // 8 // BLOCK_BYTES, BLOCK_BYTES), dtype=np.uint8)
    for r in once.groupBy("block").applyInArrow(joined, out).toLocalIterator():
        packed[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return packed.reshape(-1)


def _holds(filter_: np.ndarray, units: np.ndarray) -> np.ndarray:
    found = np.ones(len(units), dtype=bool)
    for place in _places(units, 8 * len(filter_) - 1):
        found &= (filter_[(place >> U64(3)).astype(np.int64)] >> (U64(7) - (place & U64(7))).astype(np.uint8)) & 1 == 1
    return found


def _windows(rows: DataFrame, held, longest: int) -> DataFrame:
    """(lang, w1 .. w5, n): the lead columns of every word, 0 behind the window's end, counted per chunk."""
    out = T.StructType([T.StructField("lang", T.StringType()), *[T.StructField(w, T.LongType()) for w in LEADS], T.StructField("n", T.LongType())])

    def run(batches):
        import pyarrow as pa

        filter_ = held.value
        for batch in W.regroup(batches, 1, CHUNK_BYTES):
            c = _Chunk(batch.column(1), batch.column(0))
            words, pairs = c.units()
            alive = _holds(filter_, words)
            linked = np.zeros(len(alive), dtype=bool)
            linked[np.flatnonzero(c.followed)] = _holds(filter_, pairs)
            for lo in range(0, len(alive), WINDOW_BLOCK):
                hi = min(len(alive), lo + WINDOW_BLOCK)
                leads = np.zeros((LONGEST, hi - lo), dtype=U64)
                open_ = alive[lo:hi].copy()
                leads[0][open_] = c.words[lo:hi][open_]
                key = W.mix(leads[0] ^ c.tag[lo:hi])
                for k in range(1, longest):
                    end = max(lo, min(hi, len(alive) - k))
                    open_[end - lo:] = False
                    open_[:end - lo] &= linked[lo + k - 1:end + k - 1] & alive[lo + k:end + k]
                    at = np.flatnonzero(open_)
                    leads[k][at] = c.words[lo + k + at]
                    key[at] = W.mix(key[at] * U64(31) + leads[k][at])
                _, at, n = np.unique(key, return_index=True, return_counts=True)
                lang = pa.array(c.names, pa.string()).take(pa.array(c.code[lo + at]))
                yield pa.RecordBatch.from_arrays([lang, *[pa.array(w[at].view(np.int64)) for w in leads], pa.array(n)], names=out.names)

    return rows.mapInArrow(run, out).groupBy("lang", *LEADS).agg(F.sum("n").alias("n"))


def _phrases(windows: DataFrame, least: int) -> DataFrame:
    """(lang, size, phrase, f) of all phrases that occur often enough, size 0 the word total: ROLLUP over the lead columns."""
    keys = ", ".join(LEADS)
    rolled = windows.sparkSession.sql(
        f"SELECT lang, {keys}, grouping_id() AS level, sum(n) AS f FROM {{windows}} GROUP BY lang, ROLLUP({keys})", windows=windows)
    # level: one bit for each column summed over, lang's first
    size = F.lit(LONGEST) - F.bit_count("level").cast("int")
    phrase = F.filter(F.array(*LEADS), lambda w: w.isNotNull())
    return (rolled.select("lang", size.alias("size"), phrase.alias("phrase"), "f")
            .where((F.col("size") == 0) | ((F.col("f") >= least) & ~F.array_contains("phrase", F.lit(0).cast("long")))))


def _lowest_cut(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with n and l, r and score of their lowest-scoring cut (ties: the shortest first part)."""
    part = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    for side, taken in (("l", F.slice("phrase", F.lit(1), F.col("k"))), ("r", F.slice("phrase", F.col("k") + 1, F.col("size") - F.col("k")))):
        cuts = cuts.withColumn("part", taken).join(part, ["lang", "part"]).withColumnRenamed("part_f", side).drop("part")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = (cuts.join(totals, "lang").withColumn("up", (F.lit(1000).cast("decimal(4,0)") * wide("f")).cast("decimal(19,0)") * wide("n"))
            .withColumn("down", wide("l") * wide("r")).withColumn("score", F.expr("up div down")))
    best = cuts.groupBy("lang", "phrase", "size", F.col("f").alias("a"), "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "size", "a", "n", "cut.l", "cut.r", "cut.score")


def _not_inside_longer(candidates: DataFrame, scored: DataFrame, percent: int) -> DataFrame:
    """Without candidates inside a longer one of (nearly) their count.

    What lies inside a longer candidate also lies inside one that is one word longer and at least as frequent."""
    longer = candidates.where("size > 2").select("lang", "f", F.explode(F.array(
        F.slice("phrase", F.lit(1), F.col("size") - 1), F.slice("phrase", F.lit(2), F.col("size") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    return scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("around") < percent * F.col("a"), F.lit(True))).drop("around")


def mine(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
         top: int | None = TOP, keep_percent: int = KEEP_PERCENT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` collocations (None: all)."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = docs.sparkSession
    store = Scratch(spark, "collocations")
    rows = _rows_of(docs, text_col, lang_col)
    frequent = store.save(_frequent(rows, least), "frequent")
    held = spark.sparkContext.broadcast(_bloom(frequent, filter_bits))  # at most filter_bits
    windows = store.save(_windows(rows, held, longest), "windows")
    phrases = store.save(_phrases(windows, least), "phrases")
    held.destroy()
    totals = phrases.where("size = 0").select("lang", F.col("f").alias("n"))
    phrases = phrases.where("size > 0")
    candidates = phrases.where("size > 1")
    scored = _not_inside_longer(candidates, _lowest_cut(candidates, phrases, totals), keep_percent)
    order: list[Column] = [F.desc("score"), F.desc("a")]
    if top is not None:  # ties at the limit stay until their text is known
        scored = scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place")
    scored = store.save(scored, "scored")
    names = frequent.where("word IS NOT NULL").select("lang", "hash", "word")
    spelt = scored.select("lang", "phrase", F.posexplode("phrase").alias("at", "hash")).join(names, ["lang", "hash"])
    spelt = spelt.groupBy("lang", "phrase").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
    spelt = spelt.select("lang", "phrase", F.array_join(F.transform("parts", lambda p: p["word"]), " ").alias("words"))
    ranked = scored.join(spelt, ["lang", "phrase"]).drop("phrase").withColumnRenamed("words", "phrase")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    out = store.save(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "ranked", keep=True)
    store.clear()
    return out
