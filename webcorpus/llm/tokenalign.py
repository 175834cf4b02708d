"""Alignment of two tokenizers over a corpus, with minimal perfect hashing of the linked id pairs.

1. A byte-level BPE (A) and a piece BPE with byte fallback (B) encode every
   text; the ids are written once to the shared folder, so nothing is
   tokenised twice.  Tokens of both whose byte ranges end together are
   linked; such ends cut the tokens into groups.  Each task reports its
   distinct linked pairs.
2. A minimal perfect hash is built for the distinct pairs (hash and
   displace).  Each task counts its links in dense vectors indexed by the
   hash, block by block; the vectors are summed in a tree.
3. The documents are aligned a second time and look their counts up; a
   pair's key is verified in its slot.

Two tokens that end together are suffixes of one another, so at most one
pair exists for each suffix of each token: the hash, its keys and counts
number no more than the bytes of both vocabularies (some 600,000),
whatever the corpus.  That bounds what is collected and broadcast.

Texts are compared byte by byte: a text whose joined token bytes differ from
space + text (a U+2581 in it, say) has no tokens.  Long texts reach B in parts
cut before a space that follows something else, which no piece spans.

Defined results: null and empty texts, and those that do not join, have
zeros and an empty digest; repeated rows each count; tables without tokens
give zeros; columns beside id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W
from webcorpus.llm.scratch import Scratch

CHUNK_BYTES = 1 << 20
PART_CHARS = 1 << 16        # of a text that B encodes at once
VECTOR_BLOCK = 1 << 14      # slots of a dense vector in one row
FAN_IN = 32                 # vectors summed by one step of the tree
KEYS_PER_BUCKET = 3
U64, I64 = np.uint64, np.int64
FIELDS = T.StructType([T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
                      + [T.StructField("groups_sha256", T.StringType())])


def vocabulary_files(a: str = "byte_bpe_50k", b: str = "piece_bpe_32k") -> tuple[str, str, str, str]:
    """A's ranks, split pattern and vocabulary, and B's model; looked up where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(f"{a}.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path(f"{a}.json"), public_tokenizers.path(f"{b}.model")


class Tokens:
    """Concatenated bytes of a vocabulary's tokens, by id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=I64)
        self.start = np.r_[0, np.cumsum(self.size)][:-1]
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all tokens in a row."""
        n = self.size[ids]
        before = np.cumsum(n) - n
        return self.data[np.repeat(self.start[ids] - before, n) + np.arange(int(n.sum()))]


class Encoders:
    """Ids of both tokenizers, special tokens' strings being plain text."""

    def __init__(self, ranks: str, pattern: str, vocabulary: str, model: str):
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.vocabulary, self.slow = vocabulary, None
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        of = [b""] * (max(table.values()) + 1)
        for t, i in table.items():
            of[i] = t
        self.a = Tokens(of)
        self.b = Tokens([self._piece(i) for i in range(self.pieces.get_piece_size())])

    def _piece(self, i: int) -> bytes:
        p = self.pieces
        if p.is_byte(i):
            return bytes([int(p.id_to_piece(i)[3:5], 16)])
        if p.is_control(i) or p.is_unknown(i) or p.is_unused(i):
            return b""
        return p.id_to_piece(i).replace("▁", " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype=I64)
        except Exception:  # its pattern matcher gives up on very long blank runs
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.vocabulary)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=I64)

    def ids_b(self, texts: list[str]) -> list[np.ndarray]:
        parts, owner = [], []
        for i, text in enumerate(texts):
            at = 0
            while len(text) - at > 2 * PART_CHARS:
                # before a space that follows another character; the space is the part's own prefix
                cut = text.find(" ", at + PART_CHARS)
                while cut > 0 and text[cut - 1] in " ▁":
                    cut = text.find(" ", cut + 1)
                if cut < 0:
                    break
                parts.append(text[at:cut])
                owner.append(i)
                at = cut + 1
            parts.append(text[at:])
            owner.append(i)
        found = self.pieces.encode(parts, num_threads=1) if parts else []
        if len(parts) == len(texts):
            return [np.array(x, dtype=I64) for x in found]
        out: list[list[int]] = [[] for _ in texts]
        for i, ids in zip(owner, found):
            out[i] += ids
        return [np.array(x, dtype=I64) for x in out]


class Aligned:
    """Ends, links and groups of a chunk of documents: ids of both tokenizers, and each document's number of them."""

    def __init__(self, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, size_a: np.ndarray, size_b: np.ndarray):
        self.a, self.b, self.na, self.nb = a, b, na, nb
        # ends in bytes from the chunk's first; documents have equally many in both
        ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        at = np.searchsorted(ends_b, ends_a)
        self.link_a = np.flatnonzero(ends_b[np.minimum(at, max(0, len(ends_b) - 1))] == ends_a) if len(ends_b) else at[:0]
        self.link_b = at[self.link_a]
        self.pair = (a[self.link_a].astype(U64) << U64(32)) | b[self.link_b].astype(U64)
        self.off_a, self.off_b = np.r_[0, np.cumsum(na)], np.r_[0, np.cumsum(nb)]
        self.off = np.searchsorted(self.link_a, self.off_a)  # links before each document

    def digests(self, text_a: tuple, text_b: tuple) -> list[str]:
        """Digest of each document's groups written out."""
        mark_a, mark_b = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        mark_a[self.link_a], mark_b[self.link_b] = True, True
        # a group's A tokens come before its B tokens
        group_a, group_b = np.cumsum(mark_a) - mark_a, np.cumsum(mark_b) - mark_b
        place_a = np.arange(len(self.a)) + np.r_[0, self.link_b + 1][group_a]
        place_b = np.arange(len(self.b)) + (self.link_a + 1)[group_b]
        n = len(self.a) + len(self.b)
        cells, width = np.empty((n, 6), dtype=np.uint8), np.empty(n, dtype=I64)
        for ids, marks, place, (cell, size, last) in ((self.a, mark_a, place_a, text_a), (self.b, mark_b, place_b, text_b)):
            rows = cell[ids]
            at = np.flatnonzero(marks)
            rows[at, size[ids[at]] - 1] = last
            cells[place], width[place] = rows, size[ids]
        flat = cells[np.arange(6) < width[:, None]].tobytes()
        ends = np.r_[0, np.cumsum(width)][self.off_a + self.off_b]
        return [hashlib.sha256(flat[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _decimal(n: int, last: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids below ``n`` as digits with a comma, their lengths, and the byte that stands after a group's last."""
    names = [b"%d," % i for i in range(n)]
    cell = np.frombuffer(b"".join(x.ljust(6, b"\0") for x in names), dtype=np.uint8).reshape(n, 6)
    return cell, np.array([len(x) for x in names], dtype=I64), last[0]


class PairHash:
    """Minimal perfect hash of distinct 64-bit keys: a slot below their number for each, the key verified there."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        self.keys = np.zeros(self.n, dtype=U64)
        self.shift = np.zeros(max(1, -(-self.n // KEYS_PER_BUCKET)), dtype=np.int64)
        if self.n:
            self._place(keys.astype(U64))

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return (W.mix(keys + U64(0x632BE5AB)) % U64(len(self.shift))).astype(I64)

    def _base(self, keys: np.ndarray, seed) -> np.ndarray:
        return (W.mix(keys ^ W.mix(np.asarray(seed).astype(U64) + U64(1))) % U64(self.n)).astype(I64)

    def _place(self, keys: np.ndarray) -> None:
        """Largest buckets first, each at the first shift (of the first seed without a clash) that finds free slots."""
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=len(self.shift))
        first = np.r_[0, np.cumsum(sizes)]
        taken = np.zeros(self.n, dtype=bool)
        step = np.arange(4096)
        by_size = np.argsort(-sizes, kind="stable")
        for b in by_size[:int((sizes > 1).sum())].tolist():
            mine = keys[order[first[b]:first[b + 1]]]
            seed = found = -1
            while found < 0:
                seed += 1
                base = self._base(mine, seed)
                if len(np.unique(base)) < len(base):
                    continue
                for lo in range(0, self.n, len(step)):
                    d = lo + step[:self.n - lo]
                    free = ~taken[(base[:, None] + d) % self.n].any(axis=0)
                    if free.any():
                        found = lo + int(np.argmax(free))
                        break
            self.shift[b] = seed * self.n + found
            slots = (base + found) % self.n
            taken[slots], self.keys[slots] = True, mine
        single = by_size[int((sizes > 1).sum()):int((sizes > 0).sum())]
        slots, mine = np.flatnonzero(~taken), keys[order[first[single]]]
        self.shift[single] = (slots - self._base(mine, 0)) % self.n
        self.keys[slots] = mine

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for a key that is none of the hash's."""
        if not self.n:
            return np.full(len(keys), -1)
        shift = self.shift[self._bucket(keys)]
        slot = (self._base(keys, shift // self.n) + shift % self.n) % self.n
        return np.where(self.keys[slot] == keys, slot, -1)


def _tokenised(docs: DataFrame, files) -> DataFrame:
    """(id, a, b) of every row, ids as two bytes each, and at a task's end its distinct pairs (row with ``pairs``)."""
    out = T.StructType([T.StructField("id", docs.schema["id"].dataType), T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()),
                        T.StructField("pairs", T.BinaryType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, enc, seen = to_arrow_schema(out), Encoders(*files()), np.zeros(0, dtype=U64)
        for batch in W.regroup(batches, 1, CHUNK_BYTES):
            texts = batch.column(1).to_pylist()
            ids_a = [enc.ids_a(" " + t) if t else np.zeros(0, dtype=I64) for t in texts]
            ids_b = enc.ids_b(texts)
            kept_a, kept_b = [], []
            for text, a, b in zip(texts, ids_a, ids_b):
                raw = (" " + text).encode() if text else b""
                whole = raw == enc.a.joined(a).tobytes() == enc.b.joined(b).tobytes() and enc.b.size[b].all()
                kept_a.append(a if whole else a[:0])
                kept_b.append(b if whole else b[:0])
            x = Aligned(np.concatenate(kept_a), np.concatenate(kept_b), np.array([len(k) for k in kept_a]), np.array([len(k) for k in kept_b]), enc.a.size, enc.b.size)
            seen = np.union1d(seen, x.pair)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([k.astype("<u2").tobytes() for k in kept], pa.binary()) for kept in (kept_a, kept_b)),
                                              pa.nulls(batch.num_rows, pa.binary())], schema=schema)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.nulls(1, schema.field(0).type), *[pa.nulls(1, pa.binary())] * 2, pa.array([seen.tobytes()], pa.binary())], schema=schema)

    return docs.mapInArrow(run, out)


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of bytes, and each row's number of them."""
    raw, offsets = W.text_buffers(column)
    return np.frombuffer(raw.tobytes(), dtype="<u2").astype(I64), np.diff(offsets) // 2


def _chunks(batches, first: int):
    """Batches of bounded size of (..., a, b), with their alignment's inputs."""
    for batch in W.regroup(batches, first, CHUNK_BYTES // 2):
        (a, na), (b, nb) = _ids(batch.column(first)), _ids(batch.column(first + 1))
        yield batch, a, b, na, nb


def _distinct_pairs(tokens: DataFrame) -> np.ndarray:
    """Every distinct linked pair, bounded by the vocabularies."""
    out = T.StructType([T.StructField("pair", T.LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, dtype=I64))], names=["pair"])

    pairs = tokens.where("pairs IS NOT NULL").select("pairs").mapInArrow(run, out).distinct()
    got = pairs.toArrow()["pair"].to_numpy()
    return np.sort(got).astype(U64)


def _counted(tokens: DataFrame, hash_, sizes, n: int) -> np.ndarray:
    """How many links hold each pair: dense vectors by slot, summed in a tree whose steps join ``FAN_IN`` of them."""
    out = T.StructType([T.StructField("part", T.LongType()), T.StructField("block", T.LongType()), T.StructField("counts", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        index, (size_a, size_b), counts = hash_.value, sizes.value, np.zeros(n, dtype=I64)
        for _, a, b, na, nb in _chunks(batches, 0):
            counts += np.bincount(index.find(Aligned(a, b, na, nb, size_a, size_b).pair), minlength=n)
        part = TaskContext.get().partitionId()
        for block in range(-(-n // VECTOR_BLOCK)):
            mine = counts[block * VECTOR_BLOCK:(block + 1) * VECTOR_BLOCK]
            if mine.any():
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([block]), pa.array([mine.tobytes()], pa.binary())], names=out.names)

    def summed(rows):
        import pyarrow as pa

        total = 0
        for raw in rows["counts"].to_pylist():
            total = total + np.frombuffer(raw, dtype=I64)
        return pa.table([rows["part"][:1], rows["block"][:1], pa.array([total.tobytes()], pa.binary())], names=out.names)

    docs = tokens.where("pairs IS NULL").select("a", "b")
    vectors, parts = docs.mapInArrow(run, out), max(1, docs.rdd.getNumPartitions())
    while parts > 1:
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "block").applyInArrow(summed, out)
        parts = -(-parts // FAN_IN)
    counts = np.zeros(n, dtype=I64)
    for r in vectors.toLocalIterator():
        block = np.frombuffer(r["counts"], dtype=I64)
        counts[r["block"] * VECTOR_BLOCK:][:len(block)] += block
    return counts


def align(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", files=vocabulary_files) -> DataFrame:
    """``id_col`` and :data:`FIELDS` of every document."""
    spark = docs.sparkSession
    store = Scratch(spark, "tokenalign")
    src = docs.select(W.quoted(id_col).alias("id"), F.coalesce(W.quoted(text_col).cast("string"), F.lit("")).alias("text"))
    tokens = store.save(_tokenised(src, files), "tokens", keep=True)
    pairs = PairHash(_distinct_pairs(tokens))
    enc = Encoders(*files())
    sizes = spark.sparkContext.broadcast((enc.a.size, enc.b.size))
    index = spark.sparkContext.broadcast(pairs)  # bounded by the vocabularies
    counts = _counted(tokens, index, sizes, pairs.n)
    b_of = (pairs.keys & U64(0xFFFFFFFF)).astype(I64)
    highest = np.zeros(len(enc.b.size), dtype=I64)
    np.maximum.at(highest, b_of, counts)
    known = spark.sparkContext.broadcast((counts, counts == highest[b_of] if pairs.n else np.zeros(0, dtype=bool)))
    out = T.StructType([T.StructField("id", src.schema["id"].dataType), *FIELDS])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, hash_, (count, best), (size_a, size_b) = to_arrow_schema(out), index.value, known.value, sizes.value
        text_a, text_b = _decimal(len(size_a), b"|"), _decimal(len(size_b), b";")
        for batch, a, b, na, nb in _chunks(batches, 1):
            x = Aligned(a, b, na, nb, size_a, size_b)
            slot = hash_.find(x.pair)
            n = np.diff(x.off)
            cols = [na, nb, n, n, W.per_text(best[slot], x.off), W.per_text(count[slot], x.off)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c.astype(I64)) for c in cols], pa.array(x.digests(text_a, text_b), pa.string())], schema=schema)

    found = tokens.where("pairs IS NULL").select("id", "a", "b").mapInArrow(run, out)
    return found.withColumnRenamed("id", id_col)
