"""Quality rules: exact rule statistics, a hard floor, and an isolation forest over the statistics.

A document fails outright when it is short or made of repeated three-word
windows.  For the rest, an isolation forest decides: each tree splits
random statistics of a random subsample at random values, and documents
that few splits set apart get a short mean path and a high anomaly score.
The score above which a document goes is calibrated on labelled documents,
as the one that best separates good from bad while at most ``may_lose`` of
the good ones go.

Every tree has a subsample of its own from all documents: those with the
smallest seeded hashes of id and text, one seed a tree, found in one pass
over the table.  The threshold is fitted on all labelled documents that
are not held out.  The statistics cover every whole text, in one pass
without a shuffle.

Defined results: a null or wordless text has all counts 0 and fails the
floor; lines without words never count as repeated; repeated rows get
equal verdicts and count once in a subsample; null ids are ids like others.
Without labels of both kinds only the floor decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import labelled, textstats
from webcorpus.llm import textwords as W
from webcorpus.llm.scratch import Scratch

TREES, SUBSAMPLE = 200, 256
MAY_LOSE = 0.005
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
CHUNK_BYTES = 2 << 20
BINS = 4096
U64 = np.uint64
#: statistics the trees split on; the length of a text is no fault, so it is none of them
SPLIT_ON = [n for n in textstats.RATIOS if n not in ("log_words", "line_words", "wide", "distinct_words")]
FIELDS = T.StructType([T.StructField(n, T.LongType()) for n in textstats.COUNTS]
                      + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
                         T.StructField("anomaly", T.DoubleType())])


class IsolationForest:
    """Random split trees as arrays; all trees of a chunk of rows are walked together."""

    def __init__(self, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 11):
        self.trees, self.subsample, self.seed = trees, subsample, seed
        self.limit = 1.0  # anomaly above which a row goes

    @staticmethod
    def _expected(n) -> np.ndarray:
        """Mean path length of an unsuccessful search among n points."""
        n = np.maximum(np.asarray(n, dtype=np.float64), 1)
        return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, (n == 2) * 1.0)

    def fit(self, x: np.ndarray) -> "IsolationForest":
        """Trees on seeded subsamples of ``x``."""
        rng = np.random.default_rng(self.seed)
        size = min(self.subsample, len(x))
        return self.fit_each([x[rng.choice(len(x), size, replace=False)] if len(x) else x for _ in range(self.trees)])

    def fit_each(self, samples: list[np.ndarray]) -> "IsolationForest":
        """One tree on each subsample."""
        size = max((len(x) for x in samples), default=0)
        self.depth = max(1, int(np.ceil(np.log2(max(2, size)))))
        self.norm = float(self._expected(max(2, size)))
        n = 2 ** (self.depth + 1)
        self.feature = np.zeros((self.trees, n), dtype=np.int32)
        self.value = np.full((self.trees, n), -np.inf)  # at a leaf every row goes on to the right, to equal paths
        self.path = np.zeros((self.trees, n))
        for t, rows in enumerate(samples):
            rng = np.random.default_rng([self.seed, t])
            stack = [(1, rows, 0, None)]
            while stack:
                node, part, level, done = stack.pop()
                if done is None:
                    low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
                    split = np.flatnonzero(high > low)
                    if level == self.depth or not len(split):
                        done = level + float(self._expected(len(part)))
                if done is not None:
                    self.path[t, node] = done
                    if level < self.depth:
                        stack += [(2 * node, part, level + 1, done), (2 * node + 1, part, level + 1, done)]
                    continue
                j = rng.choice(split)
                v = rng.uniform(low[j], high[j])
                self.feature[t, node], self.value[t, node] = j, v
                left = part[:, j] < v
                stack += [(2 * node, part[left], level + 1, None), (2 * node + 1, part[~left], level + 1, None)]
        return self

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path), 0 to 1."""
        out = np.empty(len(x))
        for lo in range(0, len(x), 2048):
            part = x[lo:lo + 2048]
            rows, trees = np.arange(len(part))[:, None], np.arange(self.trees)[None, :]
            node = np.ones((len(part), self.trees), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + (part[rows, self.feature[trees, node]] >= self.value[trees, node])
            out[lo:lo + 2048] = 2.0 ** (-self.path[trees, node].mean(axis=1) / self.norm)
        return out


def _matrix(stats: dict) -> np.ndarray:
    return np.stack([np.asarray(stats[n], dtype=np.float64) for n in SPLIT_ON], axis=1)


def _base_failed(stats: dict, min_words: int, max_percent: int) -> np.ndarray:
    return (stats["n_words"] < min_words) | (100 * stats["n_repeat_words"] > max_percent * stats["n_words"])


def _limit(scores: DataFrame, may_lose: float) -> float | None:
    """The anomaly above which rows go: the one that best separates good from bad ``(anomaly, good)``
    rows while at most ``may_lose`` of the good ones go; None without both kinds or without such a one.

    Exact over all rows.  The rows are counted per value, and their running
    counts are taken in ``BINS`` equal parts of 0 to 1; only the parts' sums
    pass through the driver."""
    spark = scores.sparkSession
    kept = Scratch(spark, "rules")
    try:
        part = F.floor(F.col("anomaly") * BINS).cast("int").alias("part")
        values = kept.save(scores.groupBy("anomaly").agg(F.sum(F.col("good").cast("long")).alias("g"), F.count("*").alias("n"))
                           .select(part, "anomaly", "g", (F.col("n") - F.col("g")).alias("b")), "scores")
        parts = values.groupBy("part").agg(F.sum("g"), F.sum("b")).orderBy(F.desc("part")).collect()
        good, bad = sum(r[1] for r in parts), sum(r[2] for r in parts)
        if not good or not bad:
            return None
        above, rows = (0, 0), []
        for r in parts:
            rows.append((r[0], *above))
            above = (above[0] + r[1], above[1] + r[2])
        # a part of which even the first row loses too many cannot hold the limit
        rows = [r for r in rows if r[1] / good <= may_lose]
        before = spark.createDataFrame(rows, "part int, g0 long, b0 long")
        so_far = Window.partitionBy("part").orderBy(F.desc("anomaly")).rowsBetween(Window.unboundedPreceding, 0)
        ranked = values.join(F.broadcast(before), "part").select(
            "anomaly", ((F.col("g0") + F.sum("g").over(so_far)) / F.lit(float(good))).alias("lost"),
            ((F.col("b0") + F.sum("b").over(so_far)) / F.lit(float(bad))).alias("caught"))
        value = (F.col("caught") - F.col("lost")).alias("value")
        best = ranked.where(F.col("lost") <= may_lose).select("anomaly", value).where("value > 0").orderBy(F.desc("value"), F.desc("anomaly")).first()
        if best is None:
            return None
        below = values.where(F.col("anomaly") < F.lit(best["anomaly"])).agg(F.max("anomaly")).first()[0]
        return 0.0 if below is None else (best["anomaly"] + below) / 2
    finally:
        kept.clear()


def _subsamples(docs: DataFrame, id_col: str, text_col: str, trees: int, size: int) -> list[np.ndarray]:
    """Statistics of each tree's documents: those of the ``size`` smallest hashes under the tree's seed.

    A document is a candidate if its hash is below a limit that some 1.5 times
    as many pass, so a task sends few rows however many it reads."""
    src = docs.select(F.xxhash64(F.lit(23), W.quoted(id_col).cast("string"), W.quoted(text_col).cast("string")).alias("h"), W.quoted(text_col).cast("string").alias("text"))
    n = src.select("h").distinct().count()
    limit = min(1.0, (1.5 * size + 100) / max(1, n))
    out = T.StructType([T.StructField("tree", T.IntegerType()), T.StructField("rank", T.LongType()), T.StructField("x", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        top = U64(min(2 ** 64 - 1, int(limit * 2.0 ** 64)))
        for batch in W.regroup(batches, 1, CHUNK_BYTES):
            h = batch.column(0).to_numpy().view(U64)
            ranks = np.stack([W.mix(h + U64(t) * U64(0x9E3779B97F4A7C15)) for t in range(trees)])
            tree, row = np.nonzero(ranks <= top)
            some = np.unique(row)
            if len(some):
                x = _matrix(textstats.statistics(*W.text_buffers(batch.column(1).take(pa.array(some)))))
                raw = [r.tobytes() for r in x]
                yield pa.RecordBatch.from_arrays([pa.array(tree.astype(np.int32)), pa.array((ranks[tree, row] >> U64(1)).astype(np.int64)),
                                                  pa.array([raw[i] for i in np.searchsorted(some, row)], pa.binary())], names=out.names)

    near = src.mapInArrow(run, out).dropDuplicates(["tree", "rank"])
    place = F.row_number().over(Window.partitionBy("tree").orderBy("rank"))
    got = near.withColumn("place", place).where(F.col("place") <= size).select("tree", "rank", "x").toArrow().sort_by([("tree", "ascending"), ("rank", "ascending")])
    tree = got["tree"].to_numpy()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), dtype=np.float64).reshape(-1, len(SPLIT_ON))
    return [x[tree == t] for t in range(trees)]


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        may_lose: float = MAY_LOSE, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> IsolationForest:
    """Forest on subsamples of all documents, its limit from all labelled ones (1: good) outside the held-out fold that pass the floor."""
    forest = IsolationForest()
    forest.fit_each(_subsamples(docs, id_col, text_col, forest.trees, forest.subsample))
    # only the scores are joined with the labels; the texts are not shuffled
    text = W.quoted(text_col).cast("string")
    rows = docs.select(W.quoted(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")).where(F.col("id").isNotNull() & ~labelled.held_out("id"))
    scored = judge(rows, forest, ["id", "h"], min_words=min_words, max_repeat_percent=max_repeat_percent)
    scored = scored.where("not base_failed").select("id", "h", "anomaly").dropDuplicates(["id", "h"])
    scores = scored.join(labelled.known(labels, label_col, id_col), "id").select("anomaly", (F.col("label") != 0).alias("good"))
    limit = _limit(scores, may_lose)
    if limit is not None:
        forest.limit = limit
    return forest


def judge(docs: DataFrame, forest: IsolationForest, keep: list[str], *, text_col: str = "text",
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Columns ``keep``, the exact counts, ``base_failed``, ``kept`` and the anomaly score of every document."""
    held = docs.sparkSession.sparkContext.broadcast(forest)  # fixed number of trees of fixed size

    def make():
        forest = held.value

        def run(data, offsets):
            stats = textstats.statistics(data, offsets)
            out = {n: stats[n] for n in textstats.COUNTS}
            out["base_failed"] = _base_failed(stats, min_words, max_repeat_percent)
            out["anomaly"] = forest.anomaly(_matrix(stats))
            out["kept"] = ~out["base_failed"] & (out["anomaly"] <= forest.limit)
            return out
        return run

    return W.annotate(docs, text_col, keep, FIELDS, make, CHUNK_BYTES)
