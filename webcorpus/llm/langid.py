"""Language identification by hierarchical discrimination.

A linear support vector machine per family (one against the rest) predicts a
text's language family; within it, one linear machine for each pair of
languages separates the closely related ones by vote.  Features are the
shares of hashed byte n-grams (1 to 4) and words of the lower-cased text,
all characters but letters being blanks.  The machines minimise the squared
hinge loss with Newton steps.

They are fitted on at most ``sample_rows`` documents that have a language
and are not held out, the same number of each of at most ``languages``
values (the most frequent), chosen by a seeded hash of id and text over the
whole table.  Every whole text is scored, in one pass without a shuffle.

The score is the family's probability times the mean probability with which
the language wins its pairs; both from logistics calibrated on sampled
documents that the machines have not seen.

Defined results: a text that is null or has no letter is ``und`` with score
0; so is every text where nothing could be learned.  A single learned
language wins with score 1.  A language value that no family lists is a
family of its own.  Repeated rows count once in the sample and get equal
predictions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcorpus.llm import labelled
from webcorpus.llm import textwords as W

SAMPLE_ROWS = 6_000
LANGUAGES = 256
DIM = 2048              # features
ORDERS = (1, 2, 3, 4)   # bytes of an n-gram
PENALTY = 1e-3
CHUNK_BYTES = 2 << 20
TEXTS = 256             # whose features are held at a time
U64 = np.uint64
FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
UNKNOWN = "und"
# Language codes by family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "turkic": "az kk ky tk tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
}


def family_of(lang: str, families: dict[str, str] = FAMILIES) -> str:
    """Family of a language value by its code (region and script left out); one of its own if none lists it."""
    code = lang.replace("_", "-").split("-")[0].lower()
    return next((name for name, codes in families.items() if code in codes.split()), lang)


_BLANK = W.byte_class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])  # ASCII but for letters
_WORD = W.byte_class([0x20])


def _plain(column) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with one blank for each run of others than letters, and offsets."""
    import pyarrow.compute as pc

    data, offsets = W.text_buffers(pc.utf8_lower(column))
    data = np.where(_BLANK[data], np.uint8(0x20), data)
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    starts = offsets[:-1]
    keep[starts[starts < len(data)]] = True
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(keep, out=before[1:])
    return data[keep], before[offsets]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shares of the hashed n-grams and words of each text, a row of :data:`DIM` each; 0 for a text without any."""
    n = len(offsets) - 1
    out = np.zeros((n, DIM), dtype=np.float32)
    shift = np.uint32(32 - (DIM.bit_length() - 1))
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    for lo in range(0, len(data), W.BLOCK):
        hi = min(len(data), lo + W.BLOCK)
        t = owner[lo:hi]
        end = offsets[1:][t]
        first = int(t[0])
        sums = np.zeros((int(t[-1]) - first + 1) * DIM, dtype=np.int64)
        code = np.zeros(hi - lo, dtype=np.uint32)
        at = np.arange(lo, hi)
        for k in range(1, max(ORDERS) + 1):
            code = code * np.uint32(0x01000193) + data[np.minimum(at + k - 1, len(data) - 1)] + np.uint32(k)
            if k in ORDERS:
                ok = at + k <= end
                bins = ((code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> shift
                sums += np.bincount((t[ok] - first) * DIM + bins[ok], minlength=len(sums))
        out[first:int(t[-1]) + 1] += sums.reshape(-1, DIM)
    starts, ends, off = W.find_words(data, offsets, _WORD)
    bins = (W.hash_words(data, starts, ends) >> U64(64 - (DIM.bit_length() - 1))).astype(np.int64)
    out += np.bincount(np.repeat(np.arange(n), np.diff(off)) * DIM + bins, minlength=n * DIM).reshape(n, DIM)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def _machine(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights (constant last) of a linear machine with squared hinge loss, both sides weighing the same; y is 1 or -1."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    z = np.c_[x, np.ones(len(x), dtype=x.dtype)]
    ridge = np.r_[np.full(x.shape[1], penalty), 1e-9]
    b = np.zeros(z.shape[1])

    def loss(b):
        return float((weight * np.maximum(0, 1 - y * (z @ b.astype(z.dtype))) ** 2).sum() + (ridge * b * b).sum())

    now = loss(b)
    for _ in range(30):
        gap = 1 - y * (z @ b.astype(z.dtype))
        on = gap > 0
        zo, wo = z[on], weight[on]
        g = 2 * ridge * b - 2 * zo.T @ (wo * y[on] * gap[on]).astype(z.dtype)
        # conjugate gradients for the Newton step
        step, r = np.zeros_like(b), -g
        p, rr = r.copy(), float(r @ r)
        least = 1e-6 * rr
        for _ in range(60):
            if rr <= least or rr < 1e-20:
                break
            hp = 2 * ridge * p + 2 * zo.T @ (wo * (zo @ p.astype(z.dtype))).astype(z.dtype)
            a = rr / float(p @ hp)
            step, r = step + a * p, r - a * hp
            rr, old = float(r @ r), rr
            p = r + rr / old * p
        size = 1.0
        while size > 1e-4 and loss(b + size * step) > now:
            size /= 2
        b, was = b + size * step, now
        now = loss(b)
        if was - now < 1e-7 * max(was, 1e-9):
            break
    return b


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (at least slightly rising) and constant of the probability that y holds at a margin."""
    if y.all() or not y.any():
        return 2.0, 0.0
    z, b = np.c_[m, np.ones(len(m))], np.array([1.0, 0.0])
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (target - p) - 1e-3 * (b - [1.0, 0.0]))
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[0]), 0.05), float(b[1])


class Hierarchy:
    """Families and the machines that tell them and their languages apart."""

    def __init__(self, families: dict[str, str] = FAMILIES):
        self.families = families
        self.langs: list[str] = []

    def fit(self, x: np.ndarray, langs: np.ndarray, later: np.ndarray) -> "Hierarchy":
        """``later`` rows calibrate the logistics and take no part in the machines."""
        self.langs = sorted(set(langs[~later]))
        at = {lang: i for i, lang in enumerate(self.langs)}
        names = [family_of(lang, self.families) for lang in self.langs]
        self.groups = [[i for i, f in enumerate(names) if f == name] for name in dict.fromkeys(names)]
        known = np.array([lang in at for lang in langs], dtype=bool)
        code = np.array([at.get(lang, -1) for lang in langs], dtype=np.int64)
        train = known & ~later
        mean = x[train].mean(axis=0) if train.any() else np.zeros(x.shape[1])
        scale = 1 / (x[train].std(axis=0) + 1e-4) / np.sqrt(x.shape[1]) if train.any() else mean
        z = ((x - mean) * scale).astype(np.float32)
        columns, self.logistics = [], []

        def learn(some: np.ndarray, other: np.ndarray) -> None:
            rows = np.flatnonzero((some | other) & ~later)
            b = _machine(z[rows], np.where(some[rows], 1.0, -1.0))
            check = np.flatnonzero((some | other) & later)
            check = check if len(check) > 20 else rows
            self.logistics.append(_logistic(z[check] @ b[:-1] + b[-1], some[check]))
            w = b[:-1] * scale
            columns.append(np.r_[w, b[-1] - w @ mean])

        family = np.full(len(self.langs), -1)
        for g, members in enumerate(self.groups):
            family[members] = g
        of = np.where(known, family[code], -1) if len(self.langs) else code
        if len(self.groups) > 1:
            for g in range(len(self.groups)):
                learn(of == g, known & (of != g))
        self.pairs = [(i, j) for members in self.groups for n, i in enumerate(members) for j in members[n + 1:]]
        for i, j in self.pairs:
            learn(code == i, code == j)
        self.weights = np.array(columns, dtype=np.float64).T if columns else np.zeros((x.shape[1] + 1, 0))
        return self

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the predicted language of each row, and its score."""
        margin = x @ self.weights[:-1] + self.weights[-1]
        p = np.stack([1 / (1 + np.exp(-np.clip(a * margin[:, i] + c, -30, 30))) for i, (a, c) in enumerate(self.logistics)], axis=1) if self.logistics else margin
        n_families = len(self.groups) if len(self.groups) > 1 else 0
        family, sure = np.zeros(len(x), dtype=np.int64), np.ones(len(x))
        if n_families:
            share = p[:, :n_families] / np.maximum(p[:, :n_families].sum(axis=1, keepdims=True), 1e-12)
            family = np.argmax(margin[:, :n_families], axis=1)
            sure = share[np.arange(len(x)), family]
        votes, won = np.zeros((len(x), len(self.langs))), np.zeros((len(x), len(self.langs)))
        for k, (i, j) in enumerate(self.pairs, n_families):
            first = margin[:, k] >= 0
            votes[:, i] += first
            votes[:, j] += ~first
            won[:, i] += p[:, k]
            won[:, j] += 1 - p[:, k]
        out, score = np.zeros(len(x), dtype=np.int64), sure
        for g, members in enumerate(self.groups):
            rows = np.flatnonzero(family == g)
            m = np.array(members)
            if len(m) > 1:  # most votes, then the surer wins
                best = np.argmax(votes[np.ix_(rows, m)] + won[np.ix_(rows, m)] / len(m), axis=1)
                score[rows] *= won[rows, m[best]] / (len(m) - 1)
                out[rows] = m[best]
            else:
                out[rows] = m[0]
        return out, score


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int, languages: int) -> DataFrame:
    """(lang, h, text) of at most ``rows`` distinct documents with letters that are not held out, equally many a language."""
    known = docs.select(W.quoted(id_col).alias("id"), W.quoted(text_col).cast("string").alias("text"), W.quoted(lang_col).cast("string").alias("lang"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL").where(~labelled.held_out("id"))
    known = known.where(F.col("text").rlike(r"\p{L}")).select("lang", F.xxhash64(F.lit(31), F.col("id").cast("string"), "text").alias("h"), "text")
    counts = [(r["lang"], r["n"]) for r in known.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()]
    quota = max(1, rows // max(1, len(counts)))
    # hashes below the limit hold the smallest ``quota`` with ample room
    limits = [(lang, min(1.0, (1.3 * quota + 100) / n) * 2.0 ** 64 - 2.0 ** 63) for lang, n in counts]
    limit = docs.sparkSession.createDataFrame(limits, "lang string, top double")
    near = known.join(F.broadcast(limit), "lang").where(F.col("h").cast("double") <= F.col("top")).drop("top").dropDuplicates(["lang", "h"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return near.withColumn("place", place).where(F.col("place") <= quota).drop("place")


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS,
        languages: int = LANGUAGES, families: dict[str, str] = FAMILIES) -> Hierarchy:
    """The machines, fitted on the bounded sample's features."""
    out = T.StructType([T.StructField("lang", T.StringType()), T.StructField("h", T.LongType()), T.StructField("x", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        for batch in W.regroup(batches, 2, CHUNK_BYTES // 4):
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                x = features(*_plain(part.column(2)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=out.names)

    got = _sample(docs, id_col, text_col, lang_col, sample_rows, languages).mapInArrow(run, out).toArrow().combine_chunks().sort_by([("lang", "ascending"), ("h", "ascending")])
    x = np.frombuffer(b"".join(got["x"].to_pylist()), dtype=np.float32).reshape(-1, DIM)
    h = got["h"].to_numpy()
    return Hierarchy(families).fit(x, np.array(got["lang"].to_pylist(), dtype=object), h % 4 == 0)


def predict(docs: DataFrame, model: Hierarchy, keep: list[str], *, text_col: str = "text") -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score`` of every document."""
    from pyspark.sql.pandas.types import to_arrow_schema

    held = docs.sparkSession.sparkContext.broadcast(model)  # DIM weights a machine
    text = W.quoted(text_col).cast("string")
    # a text without a letter goes as null
    src = docs.select(F.when(text.rlike(r"\p{L}"), text).alias("t"), *[W.quoted(c).alias(f"c{i}") for i, c in enumerate(keep)])
    kept = [T.StructField(f"c{i}", src.schema[f"c{i}"].dataType) for i in range(len(keep))]
    inner = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        model, schema = held.value, to_arrow_schema(inner)
        for batch in W.regroup(batches, 0, CHUNK_BYTES):
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                lang, score = np.full(part.num_rows, UNKNOWN, dtype=object), np.zeros(part.num_rows)
                told = np.flatnonzero(part.column(0).is_valid().to_numpy(zero_copy_only=False))
                if model.langs and len(told):
                    place, sure = model.predict(features(*_plain(part.column(0).take(pa.array(told)))))
                    lang[told], score[told] = np.array(model.langs, dtype=object)[place], sure
                cols = [part.column(i + 1).cast(schema.field(i).type) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(lang, pa.string()), pa.array(score)], schema=schema)

    return src.mapInArrow(run, inner).toDF(*keep, "lang_pred", "score")
