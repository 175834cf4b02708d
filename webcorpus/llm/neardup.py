"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian pruning, exact links.

1. One pass over the texts gives each document its shingle-set size, a
   digest of the set (64 bits of two 64-bit sums), band keys and one-bit
   minhash batches of 64.  Documents with equal sets become one node.
2. Nodes that share a band key are candidates.  Every node is paired with
   the smallest node of its bucket, never with all of them.  Batches of
   signature bits are compared one after the other; a pair is dropped as
   soon as the posterior probability of reaching the similarity falls below
   ``miss``.  Survivors are verified on the full sets.
3. Buckets in which nodes of different components are left go through a
   second, complete step, so no link is lost to the choice of the first
   step's centres: nodes of which enough occurs in other components at all
   are compared with those components' nodes, first with the best centre,
   then with all, by joins that yield links only.  Inside one component
   nothing more is compared.
4. Components are found by label propagation with pointer jumping.

Defined results: words are blank-separated, A-Z lower-cased; a text with
fewer words than a shingle is one shingle; a null or wordless text has an
empty set (size 0) and is linked with nothing.  Repeated rows with one id
share a component.  A null id never names a component unless all its
documents have null ids.  An empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import textwords as W
from webcorpus.llm.scratch import Scratch

BANDS, ROWS = 28, 5             # at similarity 0.8 a linked pair shares no band with probability 1.5e-5
BATCHES = 3                     # of 64 one-bit minhashes
MISS = 1e-6                     # chance, under a uniform prior, that a pruned pair is a link
CHUNK_BYTES = 2 << 20
U64, U32 = np.uint64, np.uint32

FIELDS = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("node", T.LongType()),
    *[T.StructField(f"b{i}", T.LongType()) for i in range(BATCHES)],
    T.StructField("bands", T.ArrayType(T.LongType())),
])


def least_matches(n: int, similarity: float = 0.8, miss: float = MISS) -> int:
    """Fewest equal bits of ``n`` with which a pair stays a candidate.

    Equal one-bit minhashes have probability (1 + similarity) / 2; with a
    uniform prior on the similarity, the posterior mass at or above the
    wanted one is integrated numerically for each number of matches.
    """
    grid = (np.arange(4000) + 0.5) / 4000
    p = (1 + grid) / 2
    for m in range(n + 1):
        ll = m * np.log(p) + (n - m) * np.log1p(-p)
        w = np.exp(ll - ll.max())
        if w[grid >= similarity].sum() >= miss * w.sum():
            return m
    return n


def document_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and their offsets."""
    starts, ends, off = W.find_words(data, offsets, W.BLANK_SEPARATED)
    words = W.hash_words(W.LOWER[data], starts, ends)
    shingles = W.window_hashes(words, k)
    sets = []
    for lo, hi in zip(off[:-1], off[1:]):
        if hi - lo >= k:
            sets.append(np.unique(shingles[lo:hi - k + 1]))
        else:
            sets.append(W.window_hashes(words[lo:hi], hi - lo) if hi > lo else words[:0])
    sizes = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int64)
    return (np.concatenate(sets) if sets else words[:0]), sizes


def node_ids(hashes: np.ndarray, off: np.ndarray) -> list[int | None]:
    """One id per set, equal for equal sets: two independent sums over the mixed members and the size; null if empty."""
    size = np.diff(off)
    sums = np.zeros((2, len(hashes) + 1), dtype=U64)
    np.cumsum(W.mix(hashes), out=sums[0, 1:])
    np.cumsum(W.mix(hashes ^ U64(0xA5A5A5A5A5A5A5A5)), out=sums[1, 1:])
    both = sums[:, off[1:]] - sums[:, off[:-1]]
    ids = W.mix(both[0] ^ W.mix(both[1] + size.astype(U64))).view(np.int64)
    return [int(x) if s else None for x, s in zip(ids, size)]


def _signer(k: int, seed: int):
    rng = np.random.default_rng(seed)
    n = max(BANDS * ROWS, 64 * BATCHES)
    xor = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(U32)
    mul = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(U32) | U32(1)

    def sign(data: np.ndarray, offsets: np.ndarray) -> dict:
        hashes, off = document_sets(data, offsets, k)
        n_docs, size = len(offsets) - 1, np.diff(off)
        full = np.flatnonzero(size)
        low = np.zeros((n, len(full)), dtype=U32)
        short, at = (hashes >> U64(32)).astype(U32), 0
        while at < len(full):  # some 64k shingles at a time stay in cache
            to = max(at + 1, int(np.searchsorted(off[full + 1], off[full[at]] + (1 << 16), side="right")))
            x = short[off[full[at]]:off[full[to - 1] + 1]]
            cuts = off[full[at:to]] - off[full[at]]
            for p in range(n):
                y = (x ^ xor[p]) * mul[p]
                y ^= y >> U32(16)
                low[p, at:to] = np.minimum.reduceat(y, cuts)
            at = to
        wide = W.mix(low.astype(U64) + (np.arange(n, dtype=U64)[:, None] << U64(32)))
        out = {"n": size}
        bits = (wide[:64 * BATCHES] & U64(1)).reshape(BATCHES, 64, -1)
        for b in range(BATCHES):
            col = np.zeros(n_docs, dtype=U64)
            col[full] = (bits[b] << np.arange(64, dtype=U64)[:, None]).sum(axis=0, dtype=U64)
            out[f"b{b}"] = col.view(np.int64)
        keys = np.zeros((BANDS, len(full)), dtype=U64)
        for r in range(ROWS):
            keys = W.mix(keys * U64(31) + wide[r:BANDS * ROWS:ROWS])
        keys = W.mix(keys + np.arange(1, BANDS + 1, dtype=U64)[:, None]).view(np.int64).T
        bands: list[np.ndarray | None] = [None] * n_docs
        for i, d in enumerate(full):
            bands[d] = keys[i]
        out["bands"] = bands
        out["node"] = node_ids(hashes, off)
        return out
    return sign


def signatures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, seed: int = 7) -> DataFrame:
    """(id, n, node, bit batches, band keys) of every document; no shuffle."""
    return W.annotate(docs, text_col, [id_col], FIELDS, lambda: _signer(shingle, seed), CHUNK_BYTES).withColumnRenamed(id_col, "id")


def _pruned(pairs: DataFrame, nodes: DataFrame, similarity: float, miss: float) -> DataFrame:
    """Pairs (a, b) whose sizes and batches of bits allow the similarity, with the larger batches read later."""
    bits = ["n", *[f"b{i}" for i in range(BATCHES)]]
    side = {s: nodes.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in bits]) for s in "ab"}
    got = pairs.join(side["a"], "a").join(side["b"], "b")
    percent = round(similarity * 100)
    ok = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    equal = F.lit(0)
    for i in range(BATCHES):
        equal = equal + 64 - F.bit_count(F.col(f"a_b{i}").bitwiseXOR(F.col(f"b_b{i}")))
        ok = ok & (equal >= least_matches(64 * (i + 1), similarity, miss))  # short-circuits batch by batch
    return got.where(ok).select(*pairs.columns)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that reach the similarity on their full shingle sets."""
    a = sets.select(F.col("node").alias("a"), F.col("members").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    percent = round(similarity * 100)
    return (pairs.select("a", "b").join(b, "b").join(a, "a")
            .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def components(links: DataFrame, labels: DataFrame | None = None, store: Scratch | None = None) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of ``links`` (a, b).

    Each round takes the smallest label among the neighbours and then the
    label's own label, so paths shrink by half; rounds end when no label
    changes.  Every round is a written table in the shared folder.  Labels
    of an earlier run can be carried on: links then join whole components.
    """
    store = store or Scratch(links.sparkSession, "components")
    if labels is not None:  # links between components only
        lab = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lbb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        joined = links.join(lab, "a", "left").join(lbb, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        roots = components(joined.where("a != b"), store=store)
        new = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels.select("node"), "node", "left_anti").withColumn("label", F.col("node"))
        every = labels.unionByName(new)
        return store.save(every.join(roots.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
                      .select("node", F.coalesce("root", "label").alias("label")), "labels")
    edges = links.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
                                           F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e")).select("e.x", "e.y").distinct()
    edges = store.save(edges, "edges")
    now = store.save(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y")).select("node", F.least("node", "y").alias("label")), "labels")
    while True:
        best = (edges.join(now.select(F.col("node").alias("y"), F.col("label").alias("ly")), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("ly").alias("seen")))
        hop = now.join(best, "node").select("node", "label", F.least("label", "seen").alias("near"))
        far = now.select(F.col("node").alias("near"), F.col("label").alias("jump"))
        step = hop.join(far, "near", "left").select("node", F.least("near", F.coalesce("jump", "near")).alias("label"), "label", "near")
        changes = Observation(f"labels-{uuid.uuid4().hex}")
        step = step.toDF("node", "label", "old", "near").observe(changes, F.count_if(F.col("label") != F.col("old")).alias("moved"))
        now = store.save(step, "labels").select("node", "label")
        if not changes.get["moved"]:
            return now


def link_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    similarity: float = 0.8, miss: float = MISS, seed: int = 7) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id (smallest id reachable), kept."""
    store = Scratch(docs.sparkSession, "neardup")
    sig = store.save(signatures(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed), "signatures")
    bits = [f"b{i}" for i in range(BATCHES)]
    nodes = store.save(sig.where("node is not null").groupBy("node", "n", *bits)
                   .agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    centre = buckets.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a != z").select("key", "a")
    shared = store.save(buckets.join(centre, "key").withColumnRenamed("node", "b"), "shared")
    star = shared.where("a != b").groupBy("a", "b").agg(F.count("*").alias("bands"))
    star = store.save(_pruned(star, nodes, similarity, miss), "pairs")
    # full sets of all nodes that share a bucket
    wanted = nodes.join(shared.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select(F.col("id").alias("wanted")).distinct()
    texts = docs.select(W.quoted(id_col).alias("id"), W.quoted(text_col).alias("text")).join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = store.save(_sets(texts, shingle), "sets")
    # each node's likeliest centre first: most of the other pairs then lie within one component
    first = star.groupBy("b").agg(F.max_by("a", F.struct("bands", "a")).alias("a")).select("a", "b")
    links = store.save(_verified(first, sets, similarity), "links")
    labels = components(links, store=store)
    rest = _across(star.join(first, ["a", "b"], "left_anti"), labels)
    labels = components(store.save(_verified(rest, sets, similarity), "links"), labels, store)
    labels = _completed(shared.withColumnRenamed("b", "node").select("key", "node"), nodes, sets, labels, similarity, miss, store)
    named = sig.select("id", "n", "node").join(labels, "node", "left").select("id", "n", F.coalesce("label", "node").alias("root"))
    named = store.save(named, "named", keep=True)
    store.clear()
    least = named.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    out = named.join(least, "root", "left").select(
        F.col("id"), F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _mixed(buckets: DataFrame) -> DataFrame:
    """Rows (key, node, label) of the buckets that hold more than one label."""
    keys = buckets.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key")
    return buckets.join(keys, "key", "left_semi")


def _completed(buckets: DataFrame, nodes: DataFrame, sets: DataFrame, labels: DataFrame, similarity: float, miss: float,
               store: Scratch) -> DataFrame:
    """The labels after all nodes of different components that share a bucket have been compared.

    A linked node shares the wanted part of its set with one node of another
    component.  So nodes of which too few members occur in any other
    component are left out first, by counting and without pairs; in a large
    group of loose copies, whose changed passages are their own, those are
    nearly all.  Of the rest, each bucket is compared with the node of which
    the most occurs elsewhere, the likeliest to be linked with the others, so
    that what belongs together joins one component; then the few buckets that
    still hold several are compared whole.  The joins test sizes, the counts,
    bits and full sets, and yield links only.
    """
    percent = round(similarity * 100)

    def named(rows: DataFrame) -> DataFrame:
        return _mixed(rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))

    first = store.save(named(buckets), "mixed")
    member = (first.select("node", "label").distinct().join(sets, "node")
              .select("node", "label", F.size("members").alias("size"), F.explode("members").alias("member")))
    common = member.groupBy("member").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("member")
    able = (member.join(common, "member", "left_semi").groupBy("node", "size").agg(F.count("*").alias("found"))
            .where(100 * F.col("found") >= percent * F.col("size")).select("node", "found", (F.col("found") / F.col("size")).alias("part")))
    able = store.save(first.select("key", "node").join(able, "node"), "able")
    bits = [f"b{i}" for i in range(BATCHES)]
    for whole in (False, True):
        rows = store.save(named(able), "open")
        if rows.isEmpty():
            break
        full = rows.join(nodes.select("node", "n", *bits), "node").join(sets, "node")
        y = full
        if not whole:
            centres = rows.groupBy("key").agg(F.max_by("node", "part").alias("node"))
            y = full.join(centres, ["key", "node"], "left_semi")
        x, y = (f.select("key", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "label", "n", "found", *bits, "members")]) for s, f in (("x", full), ("y", y)))
        ok = F.col("x_label") < F.col("y_label") if whole else F.col("x_label") != F.col("y_label")
        ok = ok & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
        # the intersection is at most what of either set occurs elsewhere
        ok = ok & ((100 + percent) * F.least("x_found", "y_found") >= percent * (F.col("x_n") + F.col("y_n")))
        equal = F.lit(0)
        for i, c in enumerate(bits):
            equal = equal + 64 - F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}")))
            ok = ok & (equal >= least_matches(64 * (i + 1), similarity, miss))
        both = F.size(F.array_intersect("x_members", "y_members"))
        ok = ok & (100 * both >= percent * (F.col("x_n") + F.col("y_n") - both))
        links = x.join(y, (x["key"] == y["key"]) & ok).select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
        links = store.save(links, "links")
        if not links.isEmpty():
            labels = components(links, labels, store)
    return labels


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that are not in one component yet."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, members) of texts, one row per distinct set."""
    fields = T.StructType([T.StructField("node", T.LongType()), T.StructField("members", T.ArrayType(T.LongType()))])

    def make():
        def sets(data, offsets):
            hashes, off = document_sets(data, offsets, shingle)
            return {"node": node_ids(hashes, off), "members": [hashes[lo:hi].view(np.int64) for lo, hi in zip(off[:-1], off[1:])]}
        return sets
    got = W.annotate(texts, "text", [], fields, make, CHUNK_BYTES).where("node is not null")
    return got.groupBy("node").agg(F.first("members").alias("members"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """All columns of the documents that are the smallest of their group; rows with a null id stay."""
    gone = link_components(docs, id_col=id_col, **options).where("not kept").select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, W.quoted(id_col) == F.col("__gone"), "left_anti")
