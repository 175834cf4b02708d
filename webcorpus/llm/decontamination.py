"""Benchmark decontamination with sharded suffix arrays.

Each chunk of training texts becomes one suffix array over its words,
sorted to the depth of a window.  Every suffix of the benchmark items is
binary-searched in it; the interval found holds all verbatim occurrences
of that suffix's window, and occurrences that continue are followed word
by word to the longest match.  The documents are read once and never
shuffled; only the benchmark, in blocks of bounded size, goes to the tasks.

Words outside the benchmark's vocabulary become 0 and match nothing, so
suffixes that reach one within the shortest window cannot hold a window
and are left out of the array.

Defined results: a null or wordless text has no words, no hits and is
clean.  An item with fewer words than a window (but not none) is one
window; items without words or with a null id name nothing, yet words of
null-id items still count as hits.  Repeated documents are judged row by
row, repeated items by their distinct ids.  With an empty benchmark every
document is clean.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W
from webcorpus.session import remove_scratch, scratch_path

WINDOW = 13
SHARD_BYTES = 12 << 20          # text of one suffix array
BLOCK_BYTES = 32 << 20          # benchmark text searched in one pass over the documents
U64 = np.uint64

FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()), T.StructField("longest_words", T.LongType()),
    T.StructField("longest_item", T.StringType()), T.StructField("longest_start", T.LongType()),
    T.StructField("longest_item_start", T.LongType()),
    # how far the search has come, for a benchmark of several blocks
    T.StructField("hit_spans", T.ArrayType(T.LongType())), T.StructField("hit_items", T.ArrayType(T.StringType())),
])
REPORT = FIELDS.names[:9]


def _lower_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, per_doc = W.find_words(data, offsets, W.ALPHANUMERIC)
    return W.hash_words(W.LOWER[data], starts, ends), per_doc


class Items:
    """The benchmark block in the form in which shards search it."""

    def __init__(self, rows: list[tuple[str | None, str | None]], window: int):
        texts = [(t or "").encode() for _, t in rows]
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        words, off = _lower_words(data, np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64))
        self.names = np.array([i for i, _ in rows], dtype=object)
        self.vocabulary, ids = np.unique(words, return_inverse=True)
        self.bits = max(1, int(len(self.vocabulary) + 1).bit_length())
        self.step = max(1, 63 // self.bits)
        # a 0 after every item, as in the shards, so that no suffix runs on into the next item
        self.ids = np.zeros(len(ids) + len(rows) + window + 4 * self.step, dtype=np.int64)
        item_of_word = np.repeat(np.arange(len(rows)), np.diff(off))
        self.ids[np.arange(len(ids)) + item_of_word] = ids + 1
        size = np.diff(off)
        self.first = off[:-1] + np.arange(len(rows))
        n = np.where(size >= window, size - window + 1, np.minimum(size, 1))
        item = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(item)) - np.repeat(np.r_[0, np.cumsum(n)][:-1], n)
        length = np.minimum(size[item], window)
        start = self.first[item] + at
        grid = start[:, None] + np.arange(window) if len(start) else np.zeros((0, window), dtype=np.int64)
        rows_of = np.where(np.arange(window) < length[:, None], self.ids[grid], 0)
        self.windows, which = np.unique(rows_of, axis=0, return_inverse=True)
        self.length = (self.windows > 0).sum(axis=1)
        self.shortest = int(self.length.min()) if len(self.length) else 0
        order = np.argsort(which.ravel(), kind="stable")  # windows -> (item, start)
        self.item, self.start = item[order], start[order]
        self.csr = np.searchsorted(which.ravel()[order], np.arange(len(self.windows) + 1))
        self.table = np.zeros(1 << 16, dtype=bool)
        self.table[(self.vocabulary & U64(0xFFFF)).astype(np.int64)] = True


def _packed(ids: np.ndarray, bits: int, step: int) -> np.ndarray:
    """One sortable key a position: its word and the next ``step - 1``."""
    n = len(ids) - step + 1
    key = np.zeros(n, dtype=U64)
    for j in range(step):
        key = (key << U64(bits)) | ids[j:j + n].astype(U64)
    return key


def suffix_array(key: np.ndarray, positions: np.ndarray, step: int, depth: int) -> np.ndarray:
    """``positions`` sorted by the next ``depth`` words; ties are refined with the key ``step`` words on."""
    order = positions[np.argsort(key[positions], kind="quicksort")]
    group = np.r_[0, np.cumsum(np.diff(key[order]) != 0)] if len(order) else order
    for at in range(step, depth, step):
        if not len(order):
            break
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        sub, g, k = order[tied], group[tied], key[order[tied] + at]
        o = np.lexsort((k, g))
        sub, g, k = sub[o], g[o], k[o]
        order[tied] = sub
        new = np.ones(len(order), dtype=np.int64)
        same = np.zeros(len(tied), dtype=bool)
        same[1:] = (g[1:] == g[:-1]) & (k[1:] == k[:-1])
        new[0] = 0
        new[tied[same]] = 0
        group = np.cumsum(new)
    return order


def intervals(array: np.ndarray, key: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """For each benchmark window the first and past-the-last place of its occurrences in the suffix array."""
    width, step, bits = items.windows.shape[1], items.step, items.bits
    n_keys = -(-width // step)
    full = np.zeros((len(items.windows), n_keys * step), dtype=np.int64)
    full[:, :width] = items.windows
    past = np.arange(n_keys * step)[None, :] >= items.length[:, None]

    def keys(fill: int) -> list[np.ndarray]:
        filled = np.where(past, fill, full).reshape(len(full), n_keys, step)
        out = []
        for c in range(n_keys):
            k = np.zeros(len(full), dtype=U64)
            for j in range(step):
                k = (k << U64(bits)) | filled[:, c, j].astype(U64)
            out.append(k)
        return out

    def bound(wanted: list[np.ndarray], or_equal: bool) -> np.ndarray:
        lo, hi = np.zeros(len(full), dtype=np.int64), np.full(len(full), len(array), dtype=np.int64)
        while len(array) and (lo < hi).any():
            mid = np.minimum((lo + hi) >> 1, len(array) - 1)
            at = array[mid]
            less, equal = np.zeros(len(full), dtype=bool), np.ones(len(full), dtype=bool)
            for c, want in enumerate(wanted):
                here = key[at + c * step]
                less |= equal & (here < want)
                equal &= here == want
            go = (lo < hi) & (less | (equal & or_equal))
            stay = (lo < hi) & ~go
            lo = np.where(go, mid + 1, lo)
            hi = np.where(stay, mid, hi)
        return lo

    return bound(keys(0), False), bound(keys((1 << bits) - 1), True)


def _searcher(items: Items, window: int):
    def search(data: np.ndarray, offsets: np.ndarray):
        words, off = _lower_words(data, offsets)
        n_docs = len(offsets) - 1
        doc_of_word = np.repeat(np.arange(n_docs), np.diff(off))
        known = np.flatnonzero(items.table[(words & U64(0xFFFF)).astype(np.int64)]) if len(items.windows) else np.zeros(0, dtype=np.int64)
        ids = np.zeros(len(words) + n_docs + window + 4 * items.step, dtype=np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(items.vocabulary, words[known]), len(items.vocabulary) - 1)
            hit = items.vocabulary[at] == words[known]
            ids[known[hit] + doc_of_word[known[hit]]] = at[hit] + 1
        first = off[:-1] + np.arange(n_docs)
        n_words = np.diff(off)
        cover = np.zeros(len(ids) + 1, dtype=np.int32)
        doc_items = [np.zeros((2, 0), dtype=np.int64)]
        longest = np.zeros((4, n_docs), dtype=np.int64)  # words, item, start, start in the item
        zero = np.flatnonzero(ids == 0)
        run = np.repeat(zero, np.diff(np.r_[-1, zero])) - np.arange(len(ids))  # known words from here on
        positions = np.flatnonzero(run >= max(1, items.shortest)) if len(items.windows) else zero[:0]
        if len(positions):
            key = _packed(np.r_[ids, np.zeros(items.step, dtype=np.int64)], items.bits, items.step)
            array = suffix_array(key, positions, items.step, window)
            lo, hi = intervals(array, key, items)
            found = np.flatnonzero(hi > lo)
            # all occurrences of some windows at a time
            sizes = (hi - lo)[found]
            parts = np.split(found, np.searchsorted(np.cumsum(sizes), np.arange(1 << 20, int(sizes.sum()), 1 << 20))) if len(found) else []
            for part in parts:
                n = (hi - lo)[part]
                if not len(part):
                    continue
                win = np.repeat(part, n)
                pos = array[np.repeat(lo[part] - np.r_[0, np.cumsum(n)][:-1], n) + np.arange(n.sum())]
                np.add.at(cover, pos, 1)
                np.add.at(cover, pos + items.length[win], -1)
                doc = np.searchsorted(first, pos, side="right") - 1
                pairs = np.unique(doc * len(items.windows) + win)
                d, w = np.divmod(pairs, len(items.windows))
                m = items.csr[w + 1] - items.csr[w]
                it = items.item[np.repeat(items.csr[w] - np.r_[0, np.cumsum(m)][:-1], m) + np.arange(m.sum())]
                doc_items.append(np.unique(np.stack([np.repeat(d, m), it]), axis=1))
                _longest(items, ids, first, pos, win, doc, longest)
        covered = (np.cumsum(cover)[:-1] > 0)
        return words, off, n_words, first, covered, np.unique(np.concatenate(doc_items, axis=1), axis=1), longest
    return search


def _longest(items: Items, ids, first, pos, win, doc, longest) -> None:
    """Follow the occurrences at which a match begins (the word before differs) to its end."""
    m = items.csr[win + 1] - items.csr[win]
    step = 1 << 20
    cuts = np.searchsorted(np.cumsum(m), np.arange(step, int(m.sum()), step)) if len(m) else []
    for part in np.split(np.arange(len(pos)), cuts):
        n = m[part]
        if not len(part):
            continue
        p, d = np.repeat(pos[part], n), np.repeat(doc[part], n)
        at = np.repeat(items.csr[win[part]] - np.r_[0, np.cumsum(n)][:-1], n) + np.arange(n.sum())
        s, it = items.start[at], items.item[at]
        begins = (s == items.first[it]) | (p == first[d]) | (ids[p - 1] != items.ids[s - 1])
        p, d, s, it = p[begins], d[begins], s[begins], it[begins]
        length = np.repeat(items.length[win[part]], n)[begins]
        live = np.arange(len(p))
        while len(live):
            a, b = ids[p[live] + length[live]], items.ids[s[live] + length[live]]
            live = live[(a == b) & (a > 0)]
            length[live] += 1
        order = np.lexsort((s, it, p, -length, d))
        lead = order[np.r_[True, np.diff(d[order]) != 0]] if len(order) else order
        lead = lead[length[lead] > longest[0, d[lead]]]
        longest[:, d[lead]] = np.stack([length[lead], it[lead], p[lead] - first[d[lead]], s[lead] - items.first[it[lead]]])


def _report(names: list[list[str]], n_words, n_hit, min_words: int, share: int) -> dict:
    return {
        "n_items": [len(x) for x in names],
        "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names],
        "contaminated": (n_hit >= min_words) & (share * n_hit >= n_words),
    }


def annotate(docs: DataFrame, benchmark: DataFrame, keep: list[str], *, text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
             share: int = 20, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
             clean_only: bool = False) -> DataFrame:
    """Columns ``keep`` plus :data:`REPORT` for every document.

    ``contaminated``: some words are hit, and at least one in ``share``.
    ``longest_*``: the longest verbatim match, its item and where it starts
    in the document and in the item (words, from 0; null without a match).
    The benchmark is read in blocks of some ``block_bytes`` of text, one of
    which is collected, indexed and broadcast at a time: the documents with
    what a block found are written to the shared folder before the next
    block is read.  A benchmark of one block needs no written table.
    """
    spark = docs.sparkSession
    items = benchmark.select(W.quoted(item_col).cast("string").alias("i"), W.quoted(item_text_col).alias("t"))
    items = items.withColumn("b", F.coalesce(F.octet_length("t"), F.lit(0)) + F.lit(16))
    total = items.agg(F.sum("b").alias("s")).first()["s"] or 0
    blocks = max(1, -(-2 * total // block_bytes))
    report = [f.name for f in FIELDS]
    out, written = docs, None
    carried: list[str] = []
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        held = spark.sparkContext.broadcast(Items([(r["i"], r["t"]) for r in part.select("i", "t").orderBy("i", "t").collect()], window))
        last = b == blocks - 1
        out = _pass(out, held, keep, text_col, window, share, shard_bytes, bool(carried), last, clean_only)
        if not last:
            path = scratch_path(spark, "decontamination")
            out.write.parquet(path)
            held.destroy()
            if written:
                remove_scratch(spark, written)
            out, written = spark.read.schema(out.schema).parquet(path), path
        carried = report
    return out.select(*[W.quoted(c) for c in keep], *[F.col(f"__{c}").alias(c) for c in REPORT]) if not clean_only else out.select(*[W.quoted(c) for c in keep])


def _pass(df, held, keep, text_col, window, share, shard_bytes, carried, last, clean_only):
    fields = T.StructType([T.StructField(f"__{f.name}", f.dataType) for f in FIELDS])
    if clean_only:
        fields = fields.add("__clean", T.BooleanType())
    prior = [f"__{f.name}" for f in FIELDS] if carried else []

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    cols = list(dict.fromkeys([*keep, *([] if last else [text_col])]))
    src = df.select(W.quoted(text_col).cast("string").alias("t"), *[W.quoted(c).alias(f"c{i}") for i, c in enumerate(cols)],
                    *[W.quoted(c).alias(f"p{i}") for i, c in enumerate(prior)])
    out_schema = T.StructType([T.StructField(f"c{i}", src.schema[f"c{i}"].dataType) for i in range(len(cols))]
                              + [T.StructField(f.name, f.dataType) for f in fields])

    def run(batches):
        schema = to_arrow_schema(out_schema)
        items = held.value
        search = _searcher(items, window)
        for batch in W.regroup(batches, 0, shard_bytes):
            words, off, n_words, first, covered, pairs, longest = search(*W.text_buffers(batch.column(0)))
            n = batch.num_rows
            cut = np.searchsorted(pairs[0], np.arange(n + 1))
            names = [sorted({x for x in items.names[pairs[1, cut[i]:cut[i + 1]]] if x is not None}) for i in range(n)]
            had = {f.name: batch.column(1 + len(cols) + i).to_pylist() for i, f in enumerate(FIELDS)} if prior else None
            if had:
                names = [sorted({*a, *(b or [])}) for a, b in zip(names, had["hit_items"])]
                for i, spans in enumerate(had["hit_spans"]):
                    for s, e in zip(spans[::2], spans[1::2]):
                        covered[first[i] + s:first[i] + e] = True
            # the separator after a text is never covered, so each text can be summed alone
            n_hit = W.per_text(covered, np.r_[first, len(covered)]) if n else n_words
            best = [[int(x) for x in longest[0]], [items.names[k] if w else None for w, k in zip(longest[0], longest[1])],
                    [int(x) for x in longest[2]], [int(x) for x in longest[3]]] if len(items.names) else [[0] * n, [None] * n, [0] * n, [0] * n]
            if had:
                old = ("longest_words", "longest_item", "longest_start", "longest_item_start")
                for i in range(n):
                    if (had["longest_words"][i] or 0) > best[0][i]:
                        for k, c in enumerate(old):
                            best[k][i] = had[c][i]
            got = _report(names, n_words, n_hit, 1, share)
            got |= {"n_words": n_words, "n_hit": n_hit, "longest_words": best[0], "longest_item": best[1],
                    "longest_start": [s if w else None for w, s in zip(best[0], best[2])],
                    "longest_item_start": [s if w else None for w, s in zip(best[0], best[3])],
                    "hit_items": [None if last else x for x in names], "hit_spans": [None if last else _runs(covered[first[i]:first[i] + n_words[i]]) for i in range(n)]}
            arrays = [batch.column(1 + i).cast(schema.field(i).type) for i in range(len(cols))]
            arrays += [pa.array(got[f.name], type=schema.field(len(cols) + i).type) for i, f in enumerate(FIELDS)]
            clean = pa.array(~got["contaminated"])
            if clean_only:
                arrays.append(clean)
            out = pa.RecordBatch.from_arrays(arrays, schema=schema)
            yield out.filter(clean) if clean_only and last else out

    out = src.mapInArrow(run, out_schema)
    return out.toDF(*cols, *[f.name for f in fields])


def _runs(flags: np.ndarray) -> list[int]:
    edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edges.tolist()


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns, without the contaminated ones."""
    return annotate(docs, benchmark, docs.columns, clean_only=True, **options)
