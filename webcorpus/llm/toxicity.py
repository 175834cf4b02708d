"""Toxicity by class-conditional Kneser-Ney models.

One model of toxic and one of ordinary text, both with absolute
discounting: a word after its predecessor backs off to the word by its
continuation count (distinct predecessors), the word to its stem (first
bytes) by the stem's, and the stem to counts that both classes share: how
often every stem, and every word within it, occurs in the whole corpus,
whatever the labels.  The shared counts are exact and grow with the corpus,
in a written table.  A text is scored by its length-normalised
log-likelihood ratio: over all its words, and over its most toxic stretch
of ``STRETCH`` words, joined by a logistic that is calibrated on labelled
documents the counts have not seen.

All probabilities are computed in Spark.  The tasks get the logarithms of
the ratios of those words, stems, predecessors and pairs that keep a count
after discounting; all others have the ratio of what they back off to, so
nothing is lost.  Their number is bounded by the sample.

Labels are read from at most ``sample_rows`` documents that are not held
out, half of either kind (a documented bound); every document adds to the
shared counts, and every whole text is scored.

Defined results: a null or wordless text gets the score of a ratio of 0,
below the threshold; without labels of both kinds all scores are 0.
Repeated rows get equal scores.  Of sampled rows with one id and different
texts each counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import labelled
from webcorpus.llm import textwords as W
from webcorpus.llm.scratch import Scratch

SAMPLE_ROWS = 16_000
THRESHOLD = 0.5
DISCOUNT = 1.5        # above 1: a word seen after one predecessor only tells nothing of its own
STEM_BYTES = 6
STRETCH = 8
STRONG = 1.5          # ratios above it are told apart from a text's many slight ones
CHUNK_BYTES = 2 << 20
U64 = np.uint64
FIELDS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Words, stems and predecessors (a start mark first) of all texts, and word offsets."""
    starts, ends, off = W.find_words(data, offsets, W.ALPHANUMERIC)
    low = W.LOWER[data]
    words = W.hash_words(low, starts, ends)
    stems = W.mix(W.hash_words(low, starts, np.minimum(ends, starts + STEM_BYTES)) + U64(1))
    before = np.r_[U64(0), words[:-1]] if len(words) else words
    first = off[:-1][np.diff(off) > 0]
    before[first] = U64(1)
    return words, stems, before, off


def _pair_keys(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    return W.mix(words + before * U64(3))


def _counted(rows: DataFrame) -> DataFrame:
    """(label, word, stem, before, pair, n): occurrences of words after predecessors in labelled texts, summed over tasks."""
    names = ("word", "stem", "before", "pair", "n")
    out = T.StructType([T.StructField("label", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in names]])
    src = rows.select("text", (F.col("label") != 0).cast("int").alias("label"))

    def run(batches):
        import pyarrow as pa

        for batch in W.regroup(batches, 0, 4 * CHUNK_BYTES):
            words, stems, before, off = _tokens(*W.text_buffers(batch.column(0)))
            label = np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32), np.diff(off))
            pair = _pair_keys(words, before)
            _, at, n = np.unique(pair ^ label.astype(U64), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(label[at]), *[pa.array(x[at].view(np.int64)) for x in (words, stems, before, pair)],
                                              pa.array(n.astype(np.int64))], names=out.names)

    return src.mapInArrow(run, out).groupBy("label", "word", "stem", "before", "pair").agg(F.sum("n").alias("n"))


class KneserNey:
    """Log-likelihood ratios of both models by the keys of words, stems, predecessors and pairs."""

    def __init__(self, tables: dict[str, tuple[np.ndarray, np.ndarray]], rest: float):
        """``tables``: keys and ratios of each kind; ``rest``: the ratio of a word whose stem has none."""
        self.tables, self.rest = tables, rest
        self._index()

    def _index(self) -> None:
        self.index = {kind: W.HashIndex(keys) for kind, (keys, _) in self.tables.items()}

    def __getstate__(self):
        return self.tables, self.rest  # the indexes are made anew where the model is used

    def __setstate__(self, state):
        self.tables, self.rest = state
        self._index()

    def _look_up(self, kind: str, keys: np.ndarray, out: np.ndarray) -> None:
        """Ratios of the keys that the table holds, into ``out``."""
        at = self.index[kind].find(keys)
        hit = np.flatnonzero(at >= 0)
        out[hit] = self.tables[kind][1][at[hit]]

    def ratios(self, words, stems, before) -> np.ndarray:
        """log P(word | before, toxic) - log P(word | before, ordinary) of every word."""
        out, weight = np.full(len(words), self.rest), np.zeros(len(words))
        self._look_up("stem", stems, out)
        self._look_up("word", words, out)
        self._look_up("before", before, weight)  # what the predecessor's discounts leave
        out += weight
        self._look_up("pair", _pair_keys(words, before), out)
        return out

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: mean ratio, mean of the most toxic stretch, log of the number of words."""
        words, stems, before, off = _tokens(data, offsets)
        r = self.ratios(words, stems, before)
        n = np.diff(off)
        out = np.zeros((len(n), 4))
        sums = np.r_[0.0, np.cumsum(r)]
        full = n > 0
        out[full, 0] = (sums[off[1:]] - sums[off[:-1]])[full] / n[full]
        out[:, 3] = np.log1p(n)
        # sums of up to STRETCH words that end in the same text
        if len(r):
            text_end = np.repeat(off[1:], n)
            at = np.arange(len(r))
            stretch = sums[np.minimum(at + STRETCH, text_end)] - sums[at]
            out[full, 1] = np.maximum.reduceat(stretch, off[:-1][full]) / STRETCH
            strong = np.r_[0.0, np.cumsum(np.maximum(r - STRONG, 0))]
            out[full, 2] = 100 * (strong[off[1:]] - strong[off[:-1]])[full] / n[full]
        return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (constant last), means and scales of a ridge logistic with both kinds weighing the same."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum())) * len(y)
    b = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(h, z.T @ (weight * (y - p)) - ridge @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b, mean, scale


class Scorer:
    def __init__(self, model: KneserNey | None, weights=None):
        self.model, self.weights = model, weights

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(offsets) - 1)
        b, mean, scale = self.weights
        x = self.model.evidence(data, offsets)
        s = 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ b[:-1] + b[-1], -30, 30)))
        return np.where(x[:, 3] == 0, np.minimum(s, 0.25), s)


def _shared(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, stem, n): occurrences of every word of the corpus."""
    out = T.StructType([T.StructField(c, T.LongType()) for c in ("word", "stem", "n")])

    def run(batches):
        import pyarrow as pa

        for batch in W.regroup(batches, 0, CHUNK_BYTES):
            words, stems, _, _ = _tokens(*W.text_buffers(batch.column(0)))
            word, at, n = np.unique(words, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(stems[at].view(np.int64)), pa.array(n)], names=out.names)

    return (docs.select(W.quoted(text_col).cast("string").alias("t")).mapInArrow(run, out)
            .groupBy("word", "stem").agg(F.sum("n").alias("n")))


def _of_class(value, c: int):
    return F.sum(F.when(F.col("label") == c, value).otherwise(0))


def _above(column, discount: float = DISCOUNT):
    return F.greatest(F.col(column) - F.lit(discount), F.lit(0.0))


def _log_ratio(p: list):
    return F.log(F.greatest(p[1], F.lit(1e-300))) - F.log(F.greatest(p[0], F.lit(1e-300)))


def _masses(counts: DataFrame) -> list[tuple[float, float]]:
    """(continuation counts of all units, at least 1; share that discounting leaves to the backoff) of either class."""
    got = counts.agg(*[f(f"c{c}") for c in (0, 1) for f in (F.sum, lambda x: F.sum(F.least(F.col(x).cast("double"), F.lit(DISCOUNT))))]).first()
    total = [max(1.0, float(got[i] or 0)) for i in (0, 2)]
    return [(t, max(1e-9, float(got[i] or 0) / t)) for t, i in zip(total, (1, 3))]


def _ratios(pairs: DataFrame, shared: DataFrame, store: Scratch) -> tuple[dict[str, DataFrame], float]:
    """(key, ratio) tables of the units that keep a count after discounting, and the ratio of all others."""
    classes, d = (0, 1), DISCOUNT
    stem_shared = shared.groupBy("stem").agg(F.sum("n").alias("shared"), F.sum(F.col("n") + 0.5).alias("of_words"))
    mass = float(stem_shared.agg(F.sum(F.col("shared") + 0.5)).first()[0] or 0)

    # one row of ``pairs`` is one predecessor of its word in a class; of a stem several words may share it
    word_counts = pairs.groupBy("word", "stem").agg(*[_of_class(1, c).alias(f"c{c}") for c in classes])
    stem_counts = pairs.select("label", "stem", "before").distinct().groupBy("stem").agg(*[_of_class(1, c).alias(f"c{c}") for c in classes])
    word_mass, stem_mass = _masses(word_counts), _masses(stem_counts)

    base = (F.col("shared") + 0.5) / F.lit(mass + 0.5)
    stems = store.save(stem_counts.join(stem_shared, "stem").select(
        "stem", "c0", "c1", "of_words", *[(_above(f"c{c}") / F.lit(stem_mass[c][0]) + F.lit(stem_mass[c][1]) * base).alias(f"s{c}") for c in classes]), "stems")
    within = (F.col("n") + 0.5) / F.greatest(F.col("of_words"), F.lit(1e-9))
    words = store.save(word_counts.join(shared, ["word", "stem"]).join(stems.drop("c0", "c1"), "stem").select(
        "word", "c0", "c1", *[(_above(f"c{c}") / F.lit(word_mass[c][0]) + F.lit(word_mass[c][1]) * F.col(f"s{c}") * within).alias(f"u{c}") for c in classes]), "words")

    seen = pairs.groupBy("pair", "before", "word").agg(*[_of_class(F.col("n"), c).alias(f"n{c}") for c in classes])
    left = [F.greatest(F.lit(1e-3), F.least(F.lit(1.0), 1 - F.sum(_above(f"n{c}")) / F.greatest(F.sum(f"n{c}"), F.lit(1)))).alias(f"left{c}") for c in classes]
    before = store.save(seen.groupBy("before").agg(*left, *[F.greatest(F.sum(f"n{c}"), F.lit(1)).alias(f"all{c}") for c in classes]), "before")
    often = seen.where(F.greatest("n0", "n1") > d).join(before, "before").join(words.select("word", "u0", "u1"), "word")
    p = [_above(f"n{c}") / F.col(f"all{c}") + F.col(f"left{c}") * F.col(f"u{c}") for c in classes]
    kept = F.greatest("c0", "c1") > d
    tables = {
        "pair": often.select(F.col("pair").alias("key"), _log_ratio(p).alias("ratio")),
        "before": before.where("left0 != left1").select(F.col("before").alias("key"), _log_ratio([F.col("left0"), F.col("left1")]).alias("ratio")),
        "word": words.where(kept).select(F.col("word").alias("key"), _log_ratio([F.col("u0"), F.col("u1")]).alias("ratio")),
        "stem": stems.where(kept).select(F.col("stem").alias("key"), _log_ratio([F.col(f"s{c}") * F.lit(word_mass[c][1]) for c in classes]).alias("ratio")),
    }
    rest = float(sum(s * np.log(stem_mass[c][1] * word_mass[c][1]) for c, s in ((1, 1), (0, -1))))
    return tables, rest


def _arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A table of ratios as keys and 32-bit floats, in Arrow batches."""
    got = table.withColumn("ratio", F.col("ratio").cast("float")).toArrow()
    return got["key"].to_numpy().view(U64), got["ratio"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """Both models and the calibration; the ratios of the sample's units are all that reaches the driver."""
    spark = docs.sparkSession
    sample = labelled.sample(docs, labels, label_col, sample_rows, id_col=id_col, text_col=text_col, per_class=True)
    store = Scratch(spark, "toxicity")
    sample = sample.dropDuplicates(["id", "text"]).withColumn("later", F.pmod(F.xxhash64(F.lit(99), F.col("id").cast("string")), F.lit(4)) == 0)
    sample = store.save(sample, "sample")
    kinds = {r["y"] for r in sample.where("not later").select((F.col("label") != 0).alias("y")).distinct().collect()}
    if len(kinds) < 2:
        store.clear()
        return Scorer(None)
    pairs = store.save(_counted(sample.where("not later")), "pairs")
    shared = store.save(_shared(docs, text_col), "shared")
    tables, rest = _ratios(pairs, shared, store)
    model = KneserNey({kind: _arrays(table) for kind, table in tables.items()}, rest)
    held = spark.sparkContext.broadcast(model)
    fields = T.StructType([T.StructField(n, T.DoubleType()) for n in ("mean", "stretch", "strong", "length")])

    def make():
        model = held.value

        def run(data, offsets):
            e = model.evidence(data, offsets)
            return {n: e[:, i] for i, n in enumerate(fields.names)}
        return run

    got = W.annotate(sample.where("later"), "text", ["id", "label"], fields, make, CHUNK_BYTES).toPandas().sort_values(["id", *fields.names], kind="stable")
    store.clear()
    y = got["label"].to_numpy() != 0
    if not len(y) or y.all() or not y.any():  # too few to calibrate: the ratio itself, at even odds
        return Scorer(model, (np.array([1.0, 1.0, 1.0, 0.0, -1.0]), np.zeros(4), np.ones(4)))
    return Scorer(model, _logistic(got[fields.names].to_numpy(), y))


def score(docs: DataFrame, scorer: Scorer, keep: list[str], *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` with ``score`` and ``predicted`` for every document."""
    held = docs.sparkSession.sparkContext.broadcast(scorer)  # arrays over the bounded sample's vocabulary

    def make():
        scorer = held.value

        def run(data, offsets):
            s = scorer.score(data, offsets)
            return {"score": s, "predicted": (s >= threshold).astype(np.int32)}
        return run

    return W.annotate(docs, text_col, keep, FIELDS, make, CHUNK_BYTES)
