"""Language identification: held-out accuracy, the hierarchy, the machine against plain descent, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from webcorpus.llm import langid as L
from webcorpus.llm import queries as Q

DOC = "doc_id long, text string, lang string"
SYLLABLES = {"en": "the and ing tion ou sh", "de": "der und ung sch ei ß", "sv": "och det är för ng sk", "fr": "le que eau oi é ment", "es": "el que ción ado ñ mente", "ja": "日本 語の です", "ru": "при что ова ть"}


def held(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


def corpus(n=500, seed=1, langs=("en", "de", "sv", "fr", "es", "ja")):
    r = random.Random(seed)
    docs = []
    for d in range(n):
        lang = langs[d % len(langs)]
        part = SYLLABLES[lang].split()
        docs.append((d, " ".join("".join(r.choices(part, k=r.randint(1, 3))) for _ in range(r.randint(3, 60))), lang))
    return docs


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op11_language_id(spark, sf).collect()
    assert len(got) == len(want) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == want[r.doc_id] for r in got if r.held_out]) > 0.98


def test_families_and_pairs(frame):
    docs = corpus()
    model = L.fit(frame(docs, DOC))
    assert model.langs == ["de", "en", "es", "fr", "ja", "sv"] and len(model.groups) == 3
    assert sorted((model.langs[i], model.langs[j]) for i, j in model.pairs) == [("de", "en"), ("de", "sv"), ("en", "sv"), ("es", "fr")]
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, " 12 !? ", None), (1003, "THE AND", None), (1004, "É" * 50_000, None), (1005, "　、。", "ja")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(frame(docs + odd, DOC), model, ["doc_id"]).collect()}
    assert np.mean([got[d][0] == lang for d, _, lang in docs if held(d)]) > 0.95
    assert [got[i] for i in (1000, 1001, 1002, 1005)] == [("und", 0.0)] * 4 and got[1003][0] == "en" and got[1004][0] == "fr"


def test_values_and_held_out_labels_are_no_inputs(frame):
    docs = corpus(300)
    other = [(d, t, "ru" if held(d) else lang) for d, t, lang in docs]
    one, two = (L.fit(frame(x, DOC)) for x in (docs, other))
    assert one.langs == two.langs and np.array_equal(one.weights, two.weights)


def test_sample_is_bounded_and_repeated_rows_count_once(frame):
    docs = corpus(200, langs=("en", "de", "fr")) + [(7, "the same text again", "en")] * 500
    s = L._sample(frame(docs, DOC), "doc_id", "text", "lang", 60, 256).collect()
    per = {lang: sum(r.lang == lang for r in s) for lang in ("en", "de", "fr")}
    assert per == {"en": 20, "de": 20, "fr": 20} and len({(r.lang, r.h) for r in s}) == 60
    assert {r.lang for r in L._sample(frame(docs, DOC), "doc_id", "text", "lang", 60, 1).collect()} == {"en"}
    a, b = (L.fit(frame(docs, DOC).repartition(n), sample_rows=60) for n in (1, 6))
    assert np.array_equal(a.weights, b.weights)


@pytest.mark.parametrize("docs", [[], [(1, "a b", None)], [(2, "abc def", "en"), (3, "ghi", "en"), (4, "x y", "en")], [(d, "1 2 3", "en") for d in range(9)]])
def test_little_to_learn(frame, docs):
    model = L.fit(frame(docs, DOC))
    got = L.predict(frame([(1, "some text", None), (2, None, None)], DOC), model, ["doc_id"]).collect()
    assert [r.lang_pred for r in got] == [model.langs[0] if model.langs else "und", "und"] and [r.score for r in got] == [1.0 if model.langs else 0.0, 0.0]


def test_clashing_columns_and_families(frame):
    schema = "doc_id long, text string, lang string, lang_pred string, score double, t string"
    df = frame([(*r, "x", 2.0, "t") for r in corpus(60)], schema)
    out = L.predict(df, L.fit(df), ["doc_id", "t"])
    assert out.columns == ["doc_id", "t", "lang_pred", "score"] and out.count() == 60
    assert L.predict(df.limit(0), L.fit(df), ["doc_id"]).count() == 0
    assert [L.family_of(x) for x in ("de", "de-AT", "pt_BR", "EN", "tlh")] == ["germanic", "germanic", "romance", "germanic", "tlh"]


def test_features_against_plain_counts(monkeypatch):
    texts = ["Ab  c", "", "é9é ab", "x" * 50]
    whole = L.features(*L._plain(pa.array(texts)))
    monkeypatch.setattr(L.W, "BLOCK", 3)
    assert np.allclose(whole, L.features(*L._plain(pa.array(texts))))
    for t, row in zip(texts, whole):
        alone = L.features(*L._plain(pa.array([t])))[0]
        assert np.allclose(row, alone) and abs(row.sum() - bool(t)) < 1e-5
    assert np.allclose(L.features(*L._plain(pa.array(["AB!c"]))), L.features(*L._plain(pa.array(["ab  c"]))))


def test_machine_finds_the_least_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = np.where(x[:, 0] - 2 * x[:, 1] + 0.3 * rng.normal(size=400) > 0.2, 1.0, -1.0)
    w = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())

    def loss(b):
        return float((w * np.maximum(0, 1 - y * (x @ b[:-1] + b[-1])) ** 2).sum() + 1e-3 * (b[:-1] ** 2).sum())

    b = L._machine(x, y)
    best = loss(b)
    assert np.mean((x @ b[:-1] + b[-1] > 0) == (y > 0)) > 0.9
    assert all(loss(b + 0.01 * rng.normal(size=6)) >= best - 1e-6 for _ in range(200))
