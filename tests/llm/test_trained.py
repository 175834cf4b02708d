"""Quality classifier, quality rules and toxicity: exact counts, held-out labels, edge cases."""

import collections
import random
import zlib

import numpy as np
import pytest

from models import KneserNey, rule_counts
from webcorpus.llm import labelled, quality, rules, textstats, toxicity
from webcorpus.llm import queries as Q
from webcorpus.llm import textwords as W

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string"
ODD = [None, "", " \n ", "#", "a", "a\na\n", "\na b\n a b\na b\n", "é é é é", "x y z x y z", "w " * 3000, "a b", "|\n|\n|"]


def labels_of(spark, kind):
    return {r.doc_id: r[kind] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def held(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


@pytest.mark.parametrize("chunk", [64, 2 << 20])
def test_counts_against_brute_force(spark, frame, chunk, monkeypatch):
    monkeypatch.setattr(rules, "CHUNK_BYTES", chunk)
    r = random.Random(1)
    texts = ODD + ["".join(r.choices(["ab ", "c\n", "#%", " ", "\t", "é", "ab c\n", "z"], k=r.randint(0, 60))) for _ in range(120)]
    docs = list(enumerate(texts))
    got = rules.judge(frame(docs, DOC), rules.IsolationForest(trees=2).fit(np.zeros((0, len(rules.SPLIT_ON)))), ["doc_id"]).collect()
    assert {x.doc_id: tuple(x[n] for n in textstats.COUNTS) for x in got} == {d: rule_counts(t) for d, t in docs}
    for x in got:
        n, *_, repeated = rule_counts(dict(docs)[x.doc_id])
        assert x.base_failed == (n < 50 or 100 * repeated > 50 * n) and (not x.kept or not x.base_failed)


def test_counts_of_real_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = Q.op8_quality_rules(spark, "/root/testdata/sf0.001").collect()
    assert {x.doc_id: tuple(x[n] for n in textstats.COUNTS) for x in got} == {d: rule_counts(t) for d, t in docs.items()}


def test_quality_of_held_out_documents(spark):
    known, got = labels_of(spark, "quality"), {r.doc_id: r for r in Q.op5_quality_classifier(spark, SF).collect()}
    assert len(got) == 1000 and all(r.held_out == held(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    good = [got[d].predicted for d, y in known.items() if y and held(d)]
    bad = [got[d].predicted for d, y in known.items() if not y and held(d)]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35 and len(bad) > 5


def test_rules_keep_good_documents_and_drop_junk(spark):
    known, got = labels_of(spark, "quality"), {r.doc_id: r for r in Q.op8_quality_rules(spark, SF).collect()}
    assert np.mean([got[d].kept or got[d].base_failed for d, y in known.items() if y]) > 0.98
    assert np.mean([got[d].kept for d, y in known.items() if not y]) < 0.15


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    known = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r for r in Q.op10_toxicity(spark, sf).collect()}
    assert len(got) == 10_000 and all(r.held_out == held(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in got.items())
    toxic = [got[d].predicted for d, y in known.items() if y and held(d)]
    clean = [got[d].predicted for d, y in known.items() if not y and held(d)]
    assert len(toxic) > 90 and np.mean(toxic) > 0.92 and np.mean(clean) < 0.02


def test_toxicity_learns_expressions_and_leaves_clean_text(frame):
    r = random.Random(2)
    common = [f"w{i}" for i in range(60)]
    bad = ["grobian", "lumpsack", "blödmann"]
    docs, labels = [], []
    for d in range(600):
        w = r.choices(common, k=r.randint(20, 80)) + [f"rare{r.randrange(10**6)}"]
        toxic = int(d % 4 == 0)
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(bad))
        docs.append((d, " ".join(w).upper() if d % 7 == 0 else " ".join(w)))
        labels.append((d, toxic))
    df = frame(docs, DOC)
    scorer = toxicity.fit(df, frame(labels, "doc_id long, toxic int"))
    odd = [(1000 + i, t) for i, t in enumerate(ODD)]
    got = {x.doc_id: x for x in toxicity.score(df.unionByName(frame(odd, DOC)), scorer, ["doc_id"]).collect()}
    assert len(got) == 600 + len(ODD)
    right = [got[d].predicted == y for d, y in labels if held(d)]
    assert np.mean(right) > 0.97
    assert got[1000].predicted == got[1001].predicted == got[1002].predicted == 0


def test_toxicity_keeps_fixed_expressions_of_ordinary_first_words(frame):
    r = random.Random(3)
    common = [f"w{i}" for i in range(60)]
    docs, labels = [], []
    for d in range(600):
        toxic = int(d % 4 == 0)  # the second word follows the first only and ends the text
        docs.append((d, " ".join(r.choices(common, k=r.randint(20, 40)) + ["w0", "zzgrobian" if toxic else "w1"])))
        labels.append((d, toxic))
    df = frame(docs, DOC)
    scorer = toxicity.fit(df, frame(labels, "doc_id long, toxic int"))
    got = {x.doc_id: x.predicted for x in toxicity.score(df, scorer, ["doc_id"]).collect()}
    assert np.mean([got[d] == y for d, y in labels if held(d)]) > 0.97


def test_toxicity_shared_counts_are_exact_and_cover_the_whole_corpus(frame, monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK_BYTES", 5000)
    docs = [(d, "small large other small Other large") for d in range(40)]
    docs += [(100 + i, f"x{i} large" + (f" x{i} smallish" if i % 8 == 0 else "")) for i in range(4000)]  # no labels
    want = collections.Counter(w for _, t in docs for w in KneserNey.words(t))
    got = toxicity._shared(frame(docs, DOC).repartition(3), "text").collect()
    words = {w: h for w in want for h in toxicity._tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0].view(np.int64).tolist()}
    assert {r.word: r.n for r in got} == {words[w]: n for w, n in want.items()}
    assert want["large"] == 4080 and len({r.stem for r in got if r.word in (words["small"], words["smallish"])}) == 2


def test_toxicity_ratios_against_plain_kneser_ney(frame):
    r = random.Random(8)
    units = ["you", "are", "a", "stupid", "stupidly", "stupidest", "fine", "day", "grobian", "é", "x1"]
    docs = [(d, " ".join(r.choices(units, weights=[9, 9, 9, 1 + 6 * (d % 3 == 0), 1, 1, 4, 4, 1 + 3 * (d % 3 == 0), 1, 1], k=r.randint(0, 14)))) for d in range(90)]
    docs += [(1000, "stupidity unseen words you are"), (1001, None), (1002, "unknown")]
    labels = [(d, int(d % 3 == 0)) for d in range(90)]
    seen = {}

    class Spy(toxicity.Scorer):
        def __init__(self, model, weights=None):
            seen["model"] = model
            super().__init__(model, weights)

    original, toxicity.Scorer = toxicity.Scorer, Spy
    try:
        df, told = frame(docs, DOC), frame(labels, "doc_id long, toxic int")
        toxicity.fit(df, told)
    finally:
        toxicity.Scorer = original
    later = {x.id for x in frame([(d,) for d, _ in labels], "id long").where("pmod(xxhash64(99, cast(id as string)), 4) = 0").collect()}
    plain = KneserNey([(dict(docs)[d], y) for d, y in labels if not held(d) and d not in later], [t for _, t in docs])
    for _, text in docs:
        raw = (text or "").encode()
        words, stems, before, _ = toxicity._tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert np.allclose(seen["model"].ratios(words, stems, before), plain.ratios(text), atol=1e-5)


def test_toxicity_does_not_depend_on_partitions_with_repeated_ids(frame):
    docs = [(d % 50, f"some words number {d} " + ("grobian lump " if d % 5 == 0 else "fine day ") * 3) for d in range(200)]
    labels = frame([(d, int(d % 5 == 0)) for d in range(50)], "doc_id long, toxic int")
    df = frame(docs, DOC)
    one, two = (sorted((r.doc_id, round(r.score, 7)) for r in toxicity.score(df, toxicity.fit(x, labels), ["doc_id"]).collect()) for x in (df.repartition(7), df.coalesce(1)))
    assert one == two


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)], [(None, 1), (3, None)]])
def test_without_labels_of_both_kinds(frame, labels):
    docs = frame([(1, "a b"), (2, "c"), (3, None)], DOC)
    q = quality.score(docs, quality.fit(docs, frame(labels, "doc_id long, quality int")), ["doc_id"]).collect()
    t = toxicity.score(docs, toxicity.fit(docs, frame(labels, "doc_id long, toxic int")), ["doc_id"]).collect()
    k = rules.judge(docs, rules.fit(docs, frame(labels, "doc_id long, quality int")), ["doc_id"]).collect()
    assert len(q) == len(t) == len(k) == 3 and len({r.score for r in q}) == 1 and {r.score for r in t} == {0.0}
    assert all(r.kept != r.base_failed for r in k)


def test_empty_documents_and_clashing_columns(frame):
    docs = frame([(i, "some text of words " * (i % 9), "x", 1.0, 2) for i in range(40)], "doc_id long, text string, accepted string, score double, predicted int")
    labels = frame([(i, i % 2, i % 3 == 0) for i in range(40)], "doc_id long, quality int, toxic boolean")
    model = quality.fit(docs, labels)
    out = quality.score(docs, model, docs.columns, accepted_only=True)
    assert out.columns == docs.columns
    assert quality.score(docs.limit(0), model, ["doc_id"]).count() == 0
    assert quality.fit(docs.limit(0), labels).score(np.zeros((1, len(textstats.RATIOS)))).shape == (1,)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels), ["doc_id"]).count() == 0
    assert rules.judge(docs.limit(0), rules.fit(docs.limit(0), labels), ["doc_id"]).count() == 0


def _plain_limit(rows, may_lose):
    good, best = sum(g for _, g in rows), (0, None)
    bad, values = len(rows) - sum(g for _, g in rows), sorted({a for a, _ in rows}, reverse=True)
    for i, v in enumerate(values):
        lost = sum(g for a, g in rows if a >= v) / good
        caught = sum(not g for a, g in rows if a >= v) / bad
        if lost <= may_lose and caught - lost > best[0]:
            best = (caught - lost, (v + values[i + 1]) / 2 if i + 1 < len(values) else 0.0)
    return best[1]


def test_limit_of_rules_against_plain_model(frame):
    rng = random.Random(3)
    for n, may_lose in ((300, 0.05), (300, 0.0), (40, 1.0), (2, 1.0)):
        rows = [(round(min(1.0, rng.random() * (0.6 if i % 3 else 1.1)), 3), i % 3 != 0) for i in range(n)]
        got = rules._limit(frame(rows, "anomaly double, good boolean").repartition(5), may_lose)
        assert got == _plain_limit(rows, may_lose)
    assert rules._limit(frame([(0.5, True)], "anomaly double, good boolean"), 1.0) is None


def test_limit_of_rules_is_fitted_on_all_labelled_rows(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(rules, "_limit", lambda scores, _: seen.append(scores.count()))
    n = 26_000
    docs = frame([(i, f"{i} " + " ".join(f"w{j}" for j in range(60))) for i in range(n)], DOC)
    rules.fit(docs, frame([(i, i % 2) for i in range(n)], "doc_id long, quality int"))
    assert seen == [sum(not held(i) for i in range(n))] and seen[0] < n
    rules.fit(docs.limit(40), frame([(i, i % 2) for i in range(40)], "doc_id long, quality int"), max_repeat_percent=100)
    assert seen[1] == sum(not held(i) for i in range(40))


def test_sample_is_bounded_and_leaves_the_held_out_fold(frame):
    docs = frame([(i, "t") for i in range(500)], DOC)
    labels = frame([(i, int(i % 10 == 0)) for i in range(500)] + [(1, 1)], "doc_id long, y int")
    rows = labelled.sample(docs, labels, "y", 100, per_class=True).collect()
    assert len(rows) <= 100 and not any(held(r.id) for r in rows) and {r.label for r in rows} == {0, 1}
    assert len(labelled.sample(docs, labels, "y", 60).collect()) == 60


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = quality.AdditiveModel().fit(x, y)
    assert (0, 1) in [(a, b) for a, b, *_ in m.pairs]
    assert np.mean((m.score(x) > 0.5) == y) > 0.9


def test_forest_sets_outliers_apart():
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(0, 1, (1000, 3)), rng.normal(9, 1, (20, 3))]
    a = rules.IsolationForest().fit(x).anomaly(x)
    assert a[1000:].min() > np.quantile(a[:1000], 0.98)


def test_forest_against_plain_walks():
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=(300, 4)).round(1), [[9, 9, 9, 9]] * 3, [[0, 0, 0, 0]] * 40]
    f = rules.IsolationForest(trees=12, subsample=32).fit(x)

    def expected(n):  # mean path of an unsuccessful search
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def walk(t, row):
        node = 1
        for _ in range(f.depth):
            node = 2 * node + int(row[f.feature[t, node]] >= f.value[t, node])
        return f.path[t, node]

    want = [2 ** (-np.mean([walk(t, row) for t in range(12)]) / expected(32)) for row in x]
    assert np.allclose(f.anomaly(x), want)
    # a tree's paths: the depth of the leaf and what a search among its rows would take
    sample = x[:32]
    one = rules.IsolationForest(trees=1, subsample=32).fit_each([sample])

    def grown(rows, node, level):
        if one.value[0, node] == -np.inf or level == one.depth:
            return [(i, level + expected(len(rows))) for i in rows]
        right = [i for i in rows if sample[i, one.feature[0, node]] >= one.value[0, node]]
        return grown([i for i in rows if i not in right], 2 * node, level + 1) + grown(right, 2 * node + 1, level + 1)

    paths = dict(grown(range(32), 1, 0))
    assert np.allclose(one.anomaly(sample), [2 ** (-paths[i] / expected(32)) for i in range(32)])


def test_subsamples_are_drawn_from_all_documents(frame, monkeypatch):
    docs = [(d, f"word{d} " * (d % 50 + 1)) for d in range(3000)] + [(7, "word7 " * 8)] * 2000 + [(None, None)] * 3
    df = frame(docs, DOC)
    got = rules._subsamples(df.repartition(9), "doc_id", "text", 20, 64)
    assert [len(x) for x in got] == [64] * 20
    again = rules._subsamples(df.coalesce(1), "doc_id", "text", 20, 64)
    assert all(np.array_equal(a, b) for a, b in zip(got, again))
    # the smallest hashes of each seed, plainly
    hashes = np.array(sorted({r.h for r in df.selectExpr("xxhash64(23, cast(doc_id as string), text) as h").collect()}), dtype=np.int64).view(np.uint64)
    texts = {r.h: r.text for r in df.selectExpr("xxhash64(23, cast(doc_id as string), text) as h", "text").collect()}
    for t in (0, 13):
        least = hashes[np.argsort(W.mix(hashes + np.uint64(t) * np.uint64(0x9E3779B97F4A7C15)))[:64]]
        raw = [(texts[int(h)] or "").encode() for h in least.view(np.int64)]
        stats = textstats.statistics(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])])
        assert np.array_equal(got[t], rules._matrix(stats))
    assert [len(x) for x in rules._subsamples(frame(docs[:5], DOC), "doc_id", "text", 3, 64)] == [5] * 3
    assert [len(x) for x in rules._subsamples(frame([], DOC), "doc_id", "text", 3, 64)] == [0] * 3


def test_words_and_hashes():
    texts = ["a bb  ccc", "", "bb", " a\tbb\n", "é é"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in raw])]
    starts, ends, off = W.find_words(data, offsets, W.BLANK_SEPARATED)
    words = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert words == ["a", "bb", "ccc", "bb", "a", "bb", "é", "é"] and off.tolist() == [0, 3, 3, 4, 6, 8]
    h = W.hash_words(data, starts, ends)
    assert len(set(h.tolist())) == 4 and h[1] == h[3] == h[5]
    two = W.window_hashes(h, 2)
    assert two[0] == two[4] and W.window_starts(off, 2).tolist() == [True, True, False, False, True, False, True]
    keys = np.unique(W.mix(np.arange(5000, dtype=np.uint64)))
    index = W.HashIndex(keys)
    assert (index.find(keys) == np.arange(5000)).all() and (index.find(W.mix(np.arange(6000, 7000, dtype=np.uint64))) == -1).all()
