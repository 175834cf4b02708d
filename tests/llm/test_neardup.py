import random

import pytest

from models import components
from webcorpus.llm import neardup as N


def rows(seed=5):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(3000)]
    docs = []
    for g in range(25):
        base = r.choices(vocab, k=r.choice([6, 30, 120, 300]))
        for c in range(r.choice([1, 2, 5, 12])):
            w = list(base)
            for _ in range(int(len(w) * r.choice([0, 0, 0.01, 0.03, 0.05, 0.1]))):
                w[r.randrange(len(w))] = r.choice(vocab)
            docs.append(" ".join(w).upper() if c % 4 == 3 else "  ".join(w))
    docs += [None, "", " \t\n", "one", "one two three", "One two three", "one two three four"]
    r.shuffle(docs)
    return list(enumerate(docs))


def test_against_brute_force(frame):
    docs = rows()
    got = N.link_components(frame(docs, "doc_id long, text string"), shingle=4).collect()
    expected = components(docs)
    assert len(got) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {d: (n, c, d == c) for d, (n, c) in expected.items()}


def test_loose_group_around_a_base_is_linked_exactly(frame):
    """Many loose copies: some pairs reach the similarity, many just miss it, and centres are arbitrary."""
    r = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for d in range(120):
        w = list(base)
        for p in r.sample(range(150), r.choice([1, 2, 4, 6, 9, 14])):
            w[p] = f"u{d}_{p}"
        docs.append((d * 7 % 1201, " ".join(w)))
    got = N.link_components(frame(docs, "doc_id long, text string"), shingle=4).collect()
    expected = components(docs)
    assert {x.doc_id: x.component_id for x in got} == {d: c for d, (_, c) in expected.items()}
    assert 1 < len({c for _, c in expected.values()}) < len(docs)


def test_sets_of_one_size(frame):
    words = [f"w{i}" for i in range(40)]
    docs = [(3, " ".join(words)), (5, " ".join(["x", *words[1:]])), (8, " ".join(["y", *words[1:]]))]
    got = N.link_components(frame(docs, "doc_id long, text string").coalesce(1), shingle=4).collect()
    assert {x.doc_id: x.component_id for x in got} == {3: 3, 5: 3, 8: 3}


def test_chain_of_links(frame):
    words = [f"c{i}" for i in range(400)]
    docs = [(100 - i, " ".join(words[i * 4:i * 4 + 120])) for i in range(40)]
    got = N.link_components(frame(docs, "doc_id long, text string"), shingle=4).collect()
    assert {x.doc_id: x.component_id for x in got} == {d: c for d, (_, c) in components(docs).items()}


def test_null_ids_repeated_ids_and_empty_table(frame):
    text = " ".join(f"t{i}" for i in range(30))
    docs = frame([(None, text), (4, text), (4, text), (9, text + " more"), (None, "alone")], "doc_id long, text string")
    got = N.link_components(docs, shingle=4).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("4", "4", True), ("4", "4", True), ("9", "4", False), ("None", "4", False), ("None", "None", True)]
    assert N.link_components(docs.limit(0), shingle=4).count() == 0


def test_deduplicate_keeps_columns_and_one_of_each_group(frame):
    text = " ".join(f"t{i}" for i in range(30))
    docs = frame([(3, text, "a"), (5, text, "b"), (6, None, "c"), (7, "other", "d"), (None, "x", "e")], "doc_id long, text string, component_id string")
    out = N.deduplicate(docs, shingle=4)
    assert out.columns == docs.columns
    assert sorted(r.component_id for r in out.collect()) == ["a", "c", "d", "e"]


def test_pruning_keeps_what_could_be_a_link():
    for n in (64, 128, 192):
        least = N.least_matches(n)
        assert n * 0.5 < least < n * 0.9
        assert N.least_matches(n, miss=1e-3) > least
    # at the similarity itself, a link falls below the bound less often than once in ten thousand
    from math import comb
    assert sum(comb(192, m) * 0.9 ** m * 0.1 ** (192 - m) for m in range(N.least_matches(192))) < 1e-4


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(1, 2), (3, 2), (5, 4)], [(i, i + 1) for i in range(40)]])
def test_components(frame, edges):
    got = {r.node: r.label for r in N.components(frame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(len(edges) + 1):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
