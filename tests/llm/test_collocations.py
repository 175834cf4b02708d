"""Collocations against a plain model: counts, cuts, ties, exact arithmetic and odd rows."""

import collections
import random
import re

import pytest

from models import lower
from webcorpus.llm import collocations as C

DOC = "doc_id long, text string, lang string"


def phrases(docs, longest=5):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f, n


def model(docs, least, top=2000):
    f, n = phrases(docs)
    often = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    rows = collections.defaultdict(list)
    for (lang, p), a in often.items():
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        if any(len(q) > len(p) and x == lang and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (x, q), b in often.items()):
            continue
        rows[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, i): (p.decode(), -a, l, r, n[lang], -s) for lang, x in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1)}


def got(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def sample(seed, n):
    r = random.Random(seed)
    words = ["a", "B", "cc", "en", "de", "und", "dé", "e\x01", "ff", "Über", "<b>"]
    fixed = ["new york city hall park", "cc dé cc dé cc", "a a a a a a"]
    docs = []
    for d in range(n):
        parts = []
        for _ in range(r.randint(0, 30)):
            parts.append(r.choice(fixed) if r.random() < 0.15 else r.choice(words) if r.random() < 0.9 else f"rare{r.randrange(9999)}")
            parts.append(r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "; ", "\r"]))
        docs.append((d, "".join(parts), r.choice(["en", "en", "de", None])))
    return docs + [(n, None, "en"), (n + 1, "", None), (n + 2, " \n . ", "xx"), (n + 3, "lonely words", "yy")]


@pytest.mark.parametrize("chunk,block,bits", [(8 << 20, 1 << 20, 1 << 28), (200, 7, 1 << 18)])
def test_against_plain_model(frame, monkeypatch, chunk, block, bits):
    monkeypatch.setattr(C, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(C, "WINDOW_BLOCK", block)
    docs = sample(3, 300)
    out = got(C.mine(frame(docs + docs[:40], DOC), least=12, filter_bits=bits))
    assert out == model(docs + docs[:40], 12) and len(out) > 50


def test_a_full_filter_changes_nothing(frame, monkeypatch):
    docs = sample(4, 150)
    monkeypatch.setattr(C, "_holds", lambda f, units: units == units)
    assert got(C.mine(frame(docs, DOC), least=9)) == model(docs, 9)


def test_top_rows_with_ties_at_the_limit(frame):
    docs = [(i, ". ".join(f"x{j} y{j}" for j in range(40)), "en") for i in range(5)]  # 40 phrases of one score
    out = got(C.mine(frame(docs, DOC), least=5, top=7))
    assert out == model(docs, 5, top=7) and len(out) == 7


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000
    phrases_ = spark.createDataFrame([("en", 1, [1], big), ("en", 1, [2], big + 1), ("en", 2, [1, 2], big - 7)], "lang string, size int, phrase array<bigint>, f long")
    totals = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    r = C._lowest_cut(phrases_.where("size > 1"), phrases_, totals).first()
    assert r["score"] == 1000 * (big - 7) * 10**13 // (big * (big + 1)) and (r["l"], r["r"]) == (big, big + 1)


def test_empty_table_and_clashing_columns(frame):
    schema = "doc_id long, text string, lang string, w1 long, n long, unit string, phrase string"
    rows = [(i, "one two three", "en", 1, 2, "u", "p") for i in range(6)]
    assert got(C.mine(frame(rows, schema), least=5)) == model([r[:3] for r in rows], 5)
    assert C.mine(frame([], schema)).count() == 0


def test_one_very_long_text_and_one_hot_word(frame):
    docs = [(0, "the end " * 60_000, "en"), (1, "x" * 300_000, "en"), (2, "the " * 200, "de")]
    assert got(C.mine(frame(docs, DOC))) == model(docs, 100)
