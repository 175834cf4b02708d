import hashlib
import random

from models import without_repeats
from webcorpus.llm import passages as P


def rows(seed=2):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(500)] + ["é", "A,", "a,"]
    new = lambda n: r.choices(vocab, k=n)
    shared = [new(n) for n in (49, 50, 51, 75, 140, 600)]
    line = new(12)
    docs = []
    for d in range(60):
        w = new(r.randint(0, 120))
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randrange(0, max(1, len(s) - 55))
            w += s[a:a + r.choice([30, 50, 60, 700])] + (line if r.random() < .5 else new(r.randint(0, 40)))
        docs.append("\n".join(" ".join(w[i:i + 9]) for i in range(0, len(w), 9)))
    docs += [docs[3], docs[3] + " tail", None, "", "x " * 200, "x " * 60, "a b " * 100]
    ids = r.sample(range(1000), len(docs))
    return list(zip(ids, docs))


def check(got, docs):
    expected = without_repeats(docs)
    assert len(got) == len(docs)
    for r in got:
        n, gone, kept = expected[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest()), r


def test_against_brute_force(frame):
    docs = rows()
    check(P.report(frame(docs, "doc_id long, text string")).collect(), docs)


def test_many_small_shards_and_automata(frame, monkeypatch):
    docs = rows(8)
    monkeypatch.setattr(P, "AUTOMATON_PHRASES", 3)
    check(P.report(frame(docs, "doc_id long, text string"), shard_bytes=2000).collect(), docs)


def test_text_without_repeats_is_unchanged_and_columns_stay(frame):
    docs = rows(4)
    df = frame([(d, t, "k") for d, t in docs], "doc_id long, text string, kept string")
    got = {r.doc_id: r for r in P.deduplicate(df).collect()}
    for d, (_, gone, kept) in without_repeats(docs).items():
        assert got[d].text == (" ".join(kept) if gone else dict(docs)[d]) and got[d].kept == "k"


def test_empty_table_null_and_repeated_ids(frame):
    text = " ".join(f"w{i}" for i in range(80))
    df = frame([(None, text), (5, text), (5, text), (8, text)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed) for r in P.report(df).collect())
    assert got == [("5", 0), ("5", 0), ("8", 80), ("None", 0)]
    assert P.report(df.limit(0)).count() == 0


def test_very_long_text_with_an_inner_repeat(frame):
    r = random.Random(1)
    long = [f"w{r.randrange(10**6)}" for _ in range(60_000)]
    docs = [(2, " ".join(long)), (9, "start " + " ".join(long[30_000:45_000]) + " end")]
    check(P.report(frame(docs, "doc_id long, text string")).collect(), docs)
