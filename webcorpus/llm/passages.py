"""Repeated passages: confirmed by counting, located by sharded Aho-Corasick automata, removed but for the first.

1. Every window of ``window`` words has an anchor, the least hash among its
   short word runs.  One pass emits each document's anchors (some 5 per 100
   words) and counts its words; anchors of one text only cannot lie in a
   repeated window.  Whole copies of a smaller document are settled here.
2. The windows around recurring anchors are confirmed: counted by hash, with
   the first document and place.  Neighbouring confirmed windows of one
   first document form a passage.
3. Documents with recurring anchors are dealt to shards of bounded text.
   A shard gets the passages that some window of its documents belongs to,
   compiles phrases of them, at least one in each window, into automata of
   bounded size, and streams its documents through.  Each hit is extended
   verbatim; a match of at least a window marks words whose passage starts
   in a smaller document.

Since a passage is compared word by word, an accidental equal hash can only
cost work, never a wrong removal.

Defined results: words are blank-separated and unchanged; a null, short or
unrepeated text loses nothing; a whole copy of a smaller document loses all
its words.  Of rows with one id none counts as smaller than the other; rows
with a null id neither lose words nor cause it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W
from webcorpus.llm.scratch import Scratch

WINDOW = 50
RUN = 10                    # words of an anchor
PHRASE = 10                 # words of a phrase in an automaton
SHARD_BYTES = 4 << 20       # text of one shard
AUTOMATON_PHRASES = 20_000  # in one automaton
CHUNK_BYTES = 2 << 20
U64 = np.uint64


def _anchors_of(words: np.ndarray, off: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (all texts concatenated) at which a window starts, and those windows' anchors."""
    runs = W.window_hashes(words, RUN)
    width, least = 1, runs
    span = window - RUN + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
        width *= 2
    if span > width:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:]) if len(least) > span - width else least[:0]
    at = np.flatnonzero(W.window_starts(off, window))
    return at, least[at]


def _summaries(docs: DataFrame, window: int) -> DataFrame:
    """Of each (id, mark, text): one row (id, mark, n_words, kept_sha256), and one row (id, mark, anchor) per anchor."""
    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("mark", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("kept_sha256", T.StringType()), T.StructField("anchor", T.LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in W.regroup(batches, 2, CHUNK_BYTES):
            data, offsets = W.text_buffers(batch.column(2))
            starts, ends, off = W.find_words(data, offsets, W.BLANK_SEPARATED)
            at, anchors = _anchors_of(W.hash_words(data, starts, ends), off, window)
            doc = np.searchsorted(off, at, side="right") - 1
            new = np.ones(len(at), dtype=bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
            raw = data.tobytes()
            digests = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
            n, m = batch.num_rows, int(new.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(off)), pa.array(digests, pa.string()),
                                              pa.nulls(n, pa.int64())], names=out.names)
            if m:
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(doc[new])) for i in (0, 1)), pa.nulls(m, pa.int64()),
                                                  pa.nulls(m, pa.string()), pa.array(anchors[new].view(np.int64))], names=out.names)

    return docs.select("id", "mark", "text").mapInArrow(run, out)


def _windows(candidates: DataFrame, window: int) -> DataFrame:
    """(hash, id, place) of the windows whose anchor recurs."""
    out = T.StructType([T.StructField("hash", T.LongType()), T.StructField("id", T.LongType()), T.StructField("place", T.IntegerType())])

    def run(batches):
        import pyarrow as pa

        for batch in W.regroup(batches, 1, CHUNK_BYTES):
            starts, ends, off = W.find_words(*(buffers := W.text_buffers(batch.column(1))), W.BLANK_SEPARATED)
            words = W.hash_words(buffers[0], starts, ends)
            at, anchors = _anchors_of(words, off, window)
            doc = np.searchsorted(off, at, side="right") - 1
            lists = batch.column(2)
            wanted = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            tagged = np.sort(W.mix(wanted + owner.astype(U64) * U64(0x9E3779B97F4A7C15)))
            key = W.mix(anchors + doc.astype(U64) * U64(0x9E3779B97F4A7C15))
            place = np.minimum(np.searchsorted(tagged, key), max(0, len(tagged) - 1))
            hit = tagged[place] == key if len(tagged) else np.zeros(len(key), dtype=bool)
            at, doc = at[hit], doc[hit]
            hashes = W.window_hashes(words, window)[at]
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column(0).take(pa.array(doc)),
                                              pa.array((at - off[doc]).astype(np.int32))], names=out.names)

    return candidates.select("id", "text", "anchors").mapInArrow(run, out)


def _cut(sources: DataFrame, window: int) -> DataFrame:
    """(shard, first, passage) of (id, text, parts), parts being (shard, start, n) of confirmed windows."""
    out = T.StructType([T.StructField("shard", T.LongType()), T.StructField("first", T.LongType()), T.StructField("passage", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        for batch in W.regroup(batches, 1, CHUNK_BYTES):
            rows = []
            for doc, text, parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = text.encode().split()
                rows += [(p["shard"], doc, b" ".join(words[p["start"]:p["start"] + p["n"] + window - 1])) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names=out.names)

    return sources.select("id", "text", "parts").mapInArrow(run, out)


class Automata:
    """Phrases of passages in Aho-Corasick automata, and their extension to whole verbatim matches."""

    def __init__(self, passages: list[tuple[int, bytes]], window: int):
        import ahocorasick

        self.window = window
        self.first = [f for f, _ in passages]
        self.words = [p.split() for _, p in passages]
        phrases: dict[str, list[tuple[int, int]]] = {}
        for i, words in enumerate(self.words):
            # so many words apart, some phrase lies within any window
            for at in range(0, len(words) - PHRASE + 1, max(1, window - PHRASE + 1)):
                phrases.setdefault((b" " + b" ".join(words[at:at + PHRASE]) + b" ").decode("latin-1"), []).append((i, at))
        keys = list(phrases)
        self.automata = []
        for lo in range(0, len(keys), AUTOMATON_PHRASES):
            a = ahocorasick.Automaton()
            for key in keys[lo:lo + AUTOMATON_PHRASES]:
                a.add_word(key, phrases[key])
            a.make_automaton()
            self.automata.append(a)

    def covered(self, doc: int, words: list[bytes]) -> np.ndarray:
        """Which words lie in a match of at least a window with a passage of a smaller document."""
        marks = np.zeros(len(words) + 1, dtype=np.int32)
        text = (b" " + b" ".join(words) + b" ").decode("latin-1")
        starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum([len(w) + 1 for w in words], out=starts[1:])
        done: dict[tuple[int, int], int] = {}
        for automaton in self.automata:
            for end, found in automaton.iter(text):
                x = int(np.searchsorted(starts, end, side="left")) - PHRASE  # the phrase's first word
                for i, at in found:
                    if self.first[i] >= doc or done.get((i, x - at), -1) > x:
                        continue
                    other, lo, hi = self.words[i], 0, PHRASE
                    while x - lo > 0 and at - lo > 0 and words[x - lo - 1] == other[at - lo - 1]:
                        lo += 1
                    while x + hi < len(words) and at + hi < len(other) and words[x + hi] == other[at + hi]:
                        hi += 1
                    done[i, x - at] = x + hi
                    if lo + hi >= self.window:
                        marks[x - lo] += 1
                        marks[x + hi] -= 1
        return np.cumsum(marks)[:-1] > 0


def _streamer(window: int):
    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("mark", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("left_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])

    def stream(docs, passages):
        import pyarrow as pa

        automata = Automata(sorted(set(zip(passages["first"].to_pylist(), passages["passage"].to_pylist()))), window)
        rows = []
        for doc, mark, text in zip(docs["id"].to_pylist(), docs["mark"].to_pylist(), docs["text"].to_pylist()):
            words = text.encode().split()
            gone = automata.covered(doc, words)
            if gone.any():
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
                rows.append((doc, mark, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
        return pa.table([pa.array(c, type=t) for c, t in zip(list(zip(*rows)) or [()] * 5, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                        names=out.names)

    return stream, out


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Two tables: (id, mark, n_words, kept_sha256) of every row as it is, and (id, mark, n_removed,
    left_sha256, kept) of the texts that lose words; ``mark`` tells texts of one id apart."""
    store = Scratch(docs.sparkSession, "passages")
    src = docs.select(W.quoted(id_col).cast("long").alias("id"), F.coalesce(W.quoted(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("mark", F.xxhash64("text"))
    seen = store.save(_summaries(src, window), "seen", keep=True)
    rows = seen.where("anchor is null").select("id", "mark", "n_words", "kept_sha256")
    # a whole copy of a smaller document needs no passages: all its windows start there
    whole = rows.where((F.col("n_words") >= window) & F.col("id").isNotNull())
    firsts = whole.groupBy("kept_sha256").agg(F.min("id").alias("first"))
    copies = store.save(whole.join(firsts, "kept_sha256").where("id > first").select("id", "mark", "n_words").distinct(), "copies")
    anchors = seen.where("anchor is not null and id is not null").select("id", "mark", "anchor")
    recurring = anchors.groupBy("anchor").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo < hi").select("anchor")
    lists = anchors.join(recurring, "anchor").groupBy("id", "mark").agg(F.collect_set("anchor").alias("anchors"))
    lists = lists.join(copies, ["id", "mark"], "left_anti")
    candidates = store.save(src.join(lists, ["id", "mark"]), "candidates")
    size = candidates.select(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n_shards = max(1, -(-size // shard_bytes))
    shard = F.pmod(F.xxhash64("id"), F.lit(n_shards))
    confirmed = (_windows(candidates, window).groupBy("hash")
                 .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min_by("place", "id").alias("place"), F.collect_set(shard).alias("shards"))
                 .where("first < last").select("first", "place", F.explode("shards").alias("shard")))
    order = Window.partitionBy("shard", "first").orderBy("place")
    parts = (confirmed.withColumn("island", F.col("place") - F.row_number().over(order))
             .groupBy("shard", "first", "island").agg(F.min("place").alias("start"), F.count("*").cast("int").alias("n")))
    parts = parts.groupBy("first").agg(F.collect_list(F.struct("shard", "start", "n")).alias("parts"))
    passages = _cut(candidates.select("id", "text").join(parts, F.col("id") == F.col("first")), window)
    stream, out = _streamer(window)
    lost = (candidates.select(shard.alias("shard"), "id", "mark", "text").groupBy("shard")
            .cogroup(passages.groupBy("shard")).applyInArrow(stream, out))
    nothing = F.lit(b"")
    lost = lost.unionByName(copies.select("id", "mark", F.col("n_words").alias("n_removed"), F.sha2(nothing, 256).alias("left_sha256"), nothing.alias("kept")))
    lost = store.save(lost.dropDuplicates(["id", "mark"]), "lost", keep=True)
    store.clear()
    return rows, lost


def report(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``id_col``, n_words, n_removed and the digest of the kept words of every document."""
    every, lost = find(docs, id_col=id_col, **options)
    out = every.join(lost.drop("kept"), ["id", "mark"], "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                      F.coalesce("left_sha256", "kept_sha256").alias("kept_sha256"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All documents, all columns; a text that loses words becomes its kept words joined by one space."""
    _, lost = find(docs, id_col=id_col, text_col=text_col, **options)
    lost = lost.select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.col("kept").cast("string").alias("__kept"))
    mark = F.xxhash64(F.coalesce(W.quoted(text_col).cast("string"), F.lit("")))
    got = docs.join(lost, (W.quoted(id_col).cast("long") == F.col("__id")) & (mark == F.col("__mark")), "left")
    return got.select(*[F.coalesce(F.col("__kept"), W.quoted(c)).alias(c) if c == text_col else W.quoted(c) for c in docs.columns])
