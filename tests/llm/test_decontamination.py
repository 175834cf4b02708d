import hashlib
import random

import pytest

from models import decontaminated
from webcorpus.llm import decontamination as D

WORDS = [f"w{i}" for i in range(40)] + ["é", "Über", "don't", "x-y"]


def rows(seed=3, n=60):
    r = random.Random(seed)
    items = [(i, " ".join(r.choices(WORDS, k=r.choice([0, 1, 5, 13, 14, 40])))) for i in range(12)]
    docs = []
    for d in range(n):
        parts = [" ".join(r.choices(WORDS, k=r.randint(0, 60)))]
        if d % 3 == 0:
            parts.append(r.choice(items)[1].upper() if d % 2 else r.choice(items)[1])
        docs.append((d, ", ".join(parts + [" ".join(r.choices(WORDS, k=r.randint(0, 30)))])))
    return docs + [(900, None), (901, ""), (902, "  \n ")], items + [(12, None), (13, "...")]


@pytest.fixture(scope="module")
def case(frame):
    docs, items = rows()
    return docs, items, frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")


def check(got, expected):
    assert len(got) == len(expected)
    for r in got:
        n, hit, names, bad = expected[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(names), bad), r
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_against_brute_force(case):
    docs, items, d, b = case
    check(D.annotate(d, b, ["doc_id"]).collect(), decontaminated(docs, [(str(i), t) for i, t in items]))


def test_benchmark_in_many_blocks_and_small_shards(case):
    docs, items, d, b = case
    got = D.annotate(d, b, ["doc_id"], block_bytes=400, shard_bytes=300).collect()
    check(got, decontaminated(docs, [(str(i), t) for i, t in items]))
    whole = {r.doc_id: r for r in D.annotate(d, b, ["doc_id"]).collect()}
    assert {r.doc_id: r.longest_words for r in got} == {k: r.longest_words for k, r in whole.items()}


def test_one_benchmark_block_is_alive_at_a_time(case, spark, monkeypatch):
    docs, items, d, b = case
    alive, most, real = set(), [], spark.sparkContext.broadcast

    def broadcast(value):
        held = real(value)
        if isinstance(value, D.Items):
            alive.add(id(held))
            most.append(len(alive))
            destroy = held.destroy
            held.destroy = lambda *a: (alive.discard(id(held)), destroy(*a))
        return held

    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    check(D.annotate(d, b, ["doc_id"], block_bytes=400).collect(), decontaminated(docs, [(str(i), t) for i, t in items]))
    assert len(most) > 2 and max(most) == 1


def test_longest_match_and_its_places(frame):
    passage = " ".join(f"p{i}" for i in range(30))
    item = frame([(7, f"lead in {passage} tail")], "item_id long, text string")
    docs = frame([(1, f"a b c {passage} z"), (2, "nothing here")], "doc_id long, text string")
    got = {r.doc_id: r for r in D.annotate(docs, item, ["doc_id"]).collect()}
    assert (got[1].longest_words, got[1].longest_item, got[1].longest_start, got[1].longest_item_start) == (30, "7", 3, 2)
    assert got[2].longest_words == 0 and got[2].longest_item is None


def test_removal_keeps_all_columns_and_clean_rows(case, frame):
    docs, items, d, b = case
    wide = d.selectExpr("doc_id", "text", "'x' as n_words", "1 as contaminated", "text as item_id")
    kept = D.decontaminate(wide, b)
    assert kept.columns == wide.columns
    expected = decontaminated(docs, [(str(i), t) for i, t in items])
    assert {r.doc_id for r in kept.collect()} == {k for k, v in expected.items() if not v[3]}


def test_empty_tables_nulls_and_repeats(frame):
    docs = frame([(1, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id long, text string")
    none = frame([], "item_id long, text string")
    assert [r.contaminated for r in D.annotate(docs, none, ["doc_id"]).collect()] == [False] * 3
    assert D.annotate(docs.limit(0), frame([(1, "a b")], "item_id long, text string"), ["doc_id"]).count() == 0
    got = D.annotate(docs, frame([(None, "a b"), (5, "c"), (5, "c")], "item_id long, text string"), ["doc_id"]).collect()
    assert [(r.n_hit, r.n_items) for r in got] == [(3, 1)] * 3


def test_very_long_text(frame):
    long = "x y " * 200_000
    items = frame([(1, " ".join(["x", "y"] * 10)), (2, "q " * 20)], "item_id long, text string")
    got = D.annotate(frame([(1, long), (2, "q " * 12)], "doc_id long, text string"), items, ["doc_id"]).collect()
    assert [(r.doc_id, r.n_words, r.n_hit) for r in sorted(got)] == [(1, 400_000, 400_000), (2, 12, 0)]
