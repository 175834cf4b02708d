import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenizers import Tokenizer

from webcorpus.llm import packing as P
from webcorpus.llm import queries as Q

ODD = ["a<|endoftext|>b", " \n\t x  ", "", "é中\U0001f600 it's we'll  　", "x" * 5000, "'s 's don't\r\n", None]


@pytest.fixture(scope="module")
def encoder():
    return P.Encoder(*P.vocabulary_files())


def check(rows, docs, encoder, window=2048):
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == {d for d, _ in docs}
    for d, text in docs:
        ids = encoder.slow.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids) == (at, len(ids), np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    total = sum(r.length for r in rows)
    return (len(sequences) * window - total) / max(1, total)


def test_ids_places_and_sequences(spark, frame, encoder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(10_000 + i, t) for i, t in enumerate(ODD)]
    df = frame(docs, "doc_id long, text string").coalesce(1)
    assert check(P.pack(df).collect(), docs, encoder) < 0.02


def test_query_digests(spark, encoder):
    got = Q.op9_packing(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in got[:200]:
        ids = [*encoder.slow.encode(texts[r.doc_id], add_special_tokens=False).ids, 1][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_small_windows_repeats_and_empty(frame, encoder):
    docs = [(i, "word " * (i % 23)) for i in range(80)]
    df = frame(docs, "doc_id long, text string").coalesce(1)
    check(P.pack(df, window=16, max_piece=8, least_piece=2, group=4, slack=1).collect(), docs, encoder, 16)
    twice = frame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    assert sorted(r.doc_tokens for r in P.pack(twice).collect()) == [1, 2, 2]
    assert P.pack(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=40), st.integers(1, 12))
def test_differencing_deals_out_every_piece_once(sizes, k):
    dealt = P.differencing(sizes, k)
    assert len(dealt) <= k and sorted(i for w in dealt for i in w) == list(range(len(sizes)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=40))
def test_windows_rise_until_the_capacity_holds(sizes):
    assert all(sum(sizes[i] for i in w) <= 100 for w in P.deal(sizes, 100))


def test_near_equal_windows():
    r = random.Random(3)
    sizes = [r.randint(1, 300) for _ in range(400)]
    sums = [sum(sizes[i] for i in w) for w in P.differencing(sizes, 30)]
    assert max(sums) - min(sums) <= 10
    # the textbook case: differencing ends two apart, 16 and 14
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in P.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]


ENCODER = P.Encoder(*P.vocabulary_files())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_fast_ids_equal_the_tokenizer_s(text):
    assert ENCODER.ids(text).tolist() == ENCODER.slow.encode(text, add_special_tokens=False).ids


def test_very_long_runs_are_packed_whole(frame):
    texts = [" " * 1_000_000, "\n" * 1_000_000, "#" * 1_000_000, " \n" * 400_000, "a" + " " * 700_000 + "b"]
    slow = Tokenizer.from_file(P.vocabulary_files()[0])
    got = P.pack(frame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for d, text in enumerate(texts):
        ids = b"".join(bytes(r.ids) for r in sorted((r for r in got if r.doc_id == d), key=lambda r: r.start))
        assert np.frombuffer(ids, "<u4").tolist() == [*slow.encode(text, add_special_tokens=False).ids, 1]
