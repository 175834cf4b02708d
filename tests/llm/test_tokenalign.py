"""Tokenizer alignment against a plain model on the libraries' own output; the perfect hash; odd and long texts."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from webcorpus.llm import queries as Q
from webcorpus.llm import tokenalign as A

DOC = "doc_id long, text string"
ODD = [None, "", " ", "   ", "a", " a", "  two  blanks ", "\n", "a\n\tb\0c", "x▁y", "▁", "ﬁ Å é", "<|endoftext|> <s> </s> <unk> <0x0A>", "日本語 テキスト", "🙂🙂 ok",
       "Don't you've   it's\r\n", "12345 67,89", "a" * 300, "éà" * 50, "#" * 40 + " ", "﻿bom", "é é"]


def byte_level():
    """Character of each byte in the byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            out[chr(256 + n)] = b
            n += 1
    return out


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), byte_level()


def model(docs, libraries):
    a, b, back = libraries
    links, rows, count = {}, {}, collections.Counter()
    for d, text in docs:
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ba = [bytes(back[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not text or b"".join(ba) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            ia, ib, ba, bb = [], [], [], []
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        links[d] = [(x, y) for x, p in zip(ia, ea) for y, q in zip(ib, eb) if p == q] if len(ea) < 200 else [(ia[ea.index(q)], y) for y, q in zip(ib, eb) if q in set(ea)]
        count.update(links[d])
        both, lo, parts = sorted(set(ea) & set(eb)), 0, []
        for hi in both:
            parts.append(",".join(str(x) for x, p in zip(ia, ea) if lo < p <= hi) + "|" + ",".join(str(y) for y, q in zip(ib, eb) if lo < q <= hi))
            lo = hi
        rows[d] = (len(ia), len(ib), len(both), hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "")
    high = collections.defaultdict(int)
    for (_, y), c in count.items():
        high[y] = max(high[y], c)
    return {d: (*rows[d][:3], len(links[d]), sum(count[p] == high[p[1]] for p in links[d]), sum(count[p] for p in links[d]), rows[d][3]) for d in rows}


def got(df):
    return {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect()}


def test_pairs_of_documents_against_plain_model(spark, frame, libraries, monkeypatch):
    docs = [(r.doc_id, r.text[:600]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(1000 + i, t) for i, t in enumerate(ODD)]
    want = model(docs, libraries)
    assert got(A.align(frame(docs, DOC).repartition(5))) == want and want[1009] == (0, 0, 0, 0, 0, 0, "")
    monkeypatch.setattr(A, "CHUNK_BYTES", 300)
    monkeypatch.setattr(A, "PART_CHARS", 20)
    monkeypatch.setattr(A, "VECTOR_BLOCK", 64)
    monkeypatch.setattr(A, "FAN_IN", 2)
    assert got(A.align(frame(docs, DOC).repartition(5))) == want


def test_query_on_whole_texts(spark, libraries):
    sf = "/root/testdata/sf0.001"
    out = got(Q.op13_tokenizer_alignment(spark, sf))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    a, b, _ = libraries
    assert {d: v[:2] for d, v in out.items()} == {d: (len(a.encode(" " + t, add_special_tokens=False).ids), len(b.encode(t))) if t else (0, 0) for d, t in docs}
    assert all(v[2] == v[3] >= v[4] and v[5] >= v[3] for v in out.values())


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 60_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n, dtype=np.uint64))
    h = A.PairHash(keys)
    assert sorted(h.find(keys).tolist()) == list(range(len(keys))) and (h.keys[h.find(keys)] == keys).all()
    other = np.setdiff1d(np.arange(500, dtype=np.uint64), keys)
    assert (h.find(other) == -1).all()


def test_linked_tokens_are_suffixes_so_pairs_are_bounded():
    enc = A.Encoders(*A.vocabulary_files())
    assert int(enc.a.size.sum() + enc.b.size.sum()) < 700_000


def test_long_texts_in_parts(frame, libraries):
    a, b, _ = libraries
    texts = [" " * 1_000_000, "word  and ▁ more " * 20_000, "ab" * 200_000, "x" + "\n" * 200_000 + "y", "é " * 150_000]
    out = got(A.align(frame(list(enumerate(texts)), DOC)))
    for d, t in enumerate(texts):
        if "▁" in t:
            assert out[d] == (0, 0, 0, 0, 0, 0, "")
        else:
            assert out[d][:2] == (len(a.encode(" " + t, add_special_tokens=False).ids), len(b.encode(t)))


def test_empty_table_repeated_rows_and_clashing_columns(frame, libraries):
    schema = "doc_id long, text string, a string, b long, pairs string, part long"
    assert A.align(frame([], schema)).count() == 0
    assert got(A.align(frame([(None, None, "x", 1, "p", 2)], schema))) == {None: (0, 0, 0, 0, 0, 0, "")}
    one, three = (got(A.align(frame([(1, "same old text", "x", 1, "p", 2)] * n, schema)))[1] for n in (1, 3))
    assert three[:5] == one[:5] and three[6] == one[6] and three[5] == 3 * one[5]
