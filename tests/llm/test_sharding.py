import collections
import random

from webcorpus.llm import sharding as S


def texts(n, seed=1):
    r = random.Random(seed)
    return [(i, None if i % 17 == 0 else "é" * r.randint(0, 300) if i % 5 else "same text", f"s{i % 3}") for i in range(n)]


SCHEMA = "doc_id long, text string, bucket string"


def placed(df, k, **options):
    return sorted(tuple(r) for r in S.shard(df, k, **options).collect())


def test_every_row_once_counts_one_apart_and_slots_gapless(frame):
    rows = texts(501)
    got = placed(frame(rows, SCHEMA), 24, bucket_bytes=4000)
    assert [r[:3] for r in got] == sorted(rows, key=lambda r: r[0])
    by = collections.defaultdict(list)
    for r in got:
        by[r[3]].append(r[4])
    assert sorted(by) == list(range(24)) and {len(v) for v in by.values()} == {20, 21}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_seed_decides_and_partitioning_does_not(frame):
    df = frame(texts(300), SCHEMA)
    a = placed(df.repartition(7), 8, bucket_bytes=3000)
    assert a == placed(df.coalesce(1), 8, bucket_bytes=3000)
    assert a != placed(df, 8, bucket_bytes=3000, seed=43)


def test_order_is_shuffled_across_and_within_buckets(frame):
    got = placed(frame([(i, f"t{i}", "") for i in range(2000)], SCHEMA), 4, bucket_bytes=6000)
    order = [r[0] for r in sorted(got, key=lambda r: (r[3], r[4]))]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20
    thirds = [sum(x < 1000 for x in order[i:i + 500]) for i in range(0, 2000, 500)]
    assert all(180 < t < 320 for t in thirds)


def test_fewer_rows_than_shards_repeats_nulls_and_empty(frame):
    df = frame([(1, "a", "x"), (1, "a", "x"), (None, None, None)], SCHEMA)
    got = S.shard(df.withColumn("shard", df.bucket), 24).collect()
    assert len(got) == 3 and {r.slot for r in got} == {0} and len({r["shard"] for r in got}) == 3
    assert S.shard(df.limit(0), 24).count() == 0


def test_size_counts_utf8_bytes(frame):
    got = frame([(1, "é"), (2, None), (3, "")], "doc_id long, text string").select("doc_id", S.row_size().alias("n")).collect()
    assert [r.n for r in got] == [10, 8, 8]
