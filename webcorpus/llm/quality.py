"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees on one feature at a time, boosted in cycles over the
features, add up to one lookup table per feature; the strongest pairs of
features get a two-way table each in the same way.  A text's score is the
logistic of the sum of its bins' entries: one addition per table, for all
texts of a chunk at once.

The model is fitted on at most ``sample_rows`` labelled documents that are
not held out (a documented bound; the tables are some kilobytes).  Labels,
language, source and id are no inputs of a score.  Documents are scored in
one pass without a shuffle.

Defined results: a null or wordless text has all statistics 0 and is
scored like any other; without labels of both kinds every score is the
labels' mean (0.5 without any).  Repeated rows get equal scores.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from webcorpus.llm import labelled, textstats
from webcorpus.llm import textwords as W

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
CHUNK_BYTES = 2 << 20
FIELDS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


class AdditiveModel:
    """Lookup tables per feature and per chosen pair of features."""

    def __init__(self, bins: int = 32, cycles: int = 120, rate: float = 0.1, pairs: int = 6,
                 pair_bins: int = 8, pair_cycles: int = 40, l2: float = 5.0):
        self.bins, self.cycles, self.rate, self.n_pairs = bins, cycles, rate, pairs
        self.pair_bins, self.pair_cycles, self.l2 = pair_bins, pair_cycles, l2

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)

    def _steps(self, g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
        """Leaf values of a depth-2 tree over ordered bins with gradients ``g`` and curvatures ``h``."""
        value = np.full(len(g), g.sum() / (h.sum() + self.l2))
        if depth and len(g) > 1:
            cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
            gain = cg ** 2 / (ch + self.l2) + (g.sum() - cg) ** 2 / (h.sum() - ch + self.l2)
            cut = int(np.argmax(gain)) + 1
            if gain[cut - 1] > g.sum() ** 2 / (h.sum() + self.l2) + 1e-9:
                value[:cut] = self._steps(g[:cut], h[:cut], depth - 1)
                value[cut:] = self._steps(g[cut:], h[cut:], depth - 1)
        return value

    def _grid(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """A tree that splits along one feature and then, on either side, along the other."""
        best, value = -1.0, np.zeros_like(g)
        for flip in (False, True):
            a, b = (g.T, h.T) if flip else (g, h)
            for cut in range(1, len(a)):
                out, total = np.empty_like(a), 0.0
                for rows in (slice(None, cut), slice(cut, None)):
                    sg, sh = a[rows].sum(axis=0), b[rows].sum(axis=0)
                    step = self._steps(sg, sh, 1)
                    out[rows] = step
                    total += float((sg * step - 0.5 * (sh + 1e-9) * step ** 2).sum())
                if total > best:
                    best, value = total, out.T if flip else out
        return value

    def fit(self, x: np.ndarray, y: np.ndarray) -> "AdditiveModel":
        n, d = x.shape
        self.edges = [self._edges(x[:, j], self.bins) for j in range(d)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs, self.grids = [], []
        rate = (y.sum() + 0.5) / (n + 1) if n else 0.5
        self.base = float(np.log(rate / (1 - rate)))
        if not n or y.min() == y.max():
            return self
        binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
        f = np.full(n, self.base)
        for _ in range(self.cycles):
            for j in range(d):
                p = 1 / (1 + np.exp(-f))
                m = len(self.tables[j])
                step = self.rate * self._steps(np.bincount(binned[j], y - p, m), np.bincount(binned[j], p * (1 - p), m))
                self.tables[j] += step
                f += step[binned[j]]
        # pairs by the gain of one two-way tree on what the single tables leave
        coarse = [self._edges(x[:, j], self.pair_bins) for j in range(d)]
        cell = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

        def sums(a: int, b: int):
            p = 1 / (1 + np.exp(-f))
            shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
            at = cell[a] * shape[1] + cell[b]
            return (np.bincount(at, y - p, shape[0] * shape[1]).reshape(shape),
                    np.bincount(at, p * (1 - p), shape[0] * shape[1]).reshape(shape))

        gains = sorted(((float((sums(a, b)[0] ** 2 / (sums(a, b)[1] + self.l2)).sum()), a, b) for a, b in combinations(range(d), 2)), reverse=True)
        self.pairs = [(a, b, coarse[a], coarse[b]) for _, a, b in gains[:self.n_pairs]]
        self.grids = [np.zeros((len(ea) + 1, len(eb) + 1)) for _, _, ea, eb in self.pairs]
        for _ in range(self.pair_cycles):
            for k, (a, b, _, _) in enumerate(self.pairs):
                step = self.rate * self._grid(*sums(a, b))
                self.grids[k] += step
                f += step[cell[a], cell[b]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            f += t[np.searchsorted(e, x[:, j], side="right")]
        for (a, b, ea, eb), g in zip(self.pairs, self.grids):
            f += g[np.searchsorted(ea, x[:, a], side="right"), np.searchsorted(eb, x[:, b], side="right")]
        return 1 / (1 + np.exp(-f))


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    stats = textstats.statistics(data, offsets)
    return np.stack([stats[n] for n in textstats.RATIOS], axis=1)


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """The model; what reaches the driver is one row of numbers per sampled document."""
    rows = labelled.sample(docs, labels, label_col, sample_rows, id_col=id_col, text_col=text_col)
    fields = T.StructType([T.StructField(n, T.DoubleType()) for n in textstats.RATIOS])

    def make():
        return lambda data, offsets: {n: v for n, v in textstats.statistics(data, offsets).items() if n in fields.names}

    got = W.annotate(rows, "text", ["id", "label"], fields, make, CHUNK_BYTES).dropDuplicates(["id"]).toPandas().sort_values(["id", *fields.names], kind="stable")
    x, y = got[fields.names].to_numpy(dtype=np.float64), (got["label"] != 0).to_numpy(dtype=np.float64)
    return AdditiveModel().fit(x, y)


def score(docs: DataFrame, model: AdditiveModel, keep: list[str], *, text_col: str = "text",
          threshold: float = THRESHOLD, accepted_only: bool = False) -> DataFrame:
    """Columns ``keep`` with ``score`` and ``predicted``; or, ``accepted_only``, just ``keep`` of the accepted rows."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # lookup tables of some kilobytes

    def make():
        model = held.value

        def run(data, offsets):
            s = model.score(_features(data, offsets))
            return {"score": s, "predicted": (s >= threshold).astype(np.int32), "__accepted": s >= threshold}
        return run

    if accepted_only:
        fields = T.StructType([T.StructField("__accepted", T.BooleanType())])
        return W.annotate(docs, text_col, keep, fields, make, CHUNK_BYTES, keep_if="__accepted").select(*[W.quoted(c) for c in keep])
    return W.annotate(docs, text_col, keep, FIELDS, make, CHUNK_BYTES)
