"""Visited sets and crawl closure on hand-made inputs, against Python models."""

from collections import deque

from pyspark.sql import functions as F

from webcorpus.operators import frontier as G
from webcorpus.operators import routing as R
from webcorpus.operators import visited as V
from webcorpus.session import scratch_path

SET = "meta string, key string"


def test_first_seen_is_deterministic_and_skips_visited(spark):
    cand = spark.createDataFrame(
        [("blog", "a", 3, "u3"), ("blog", "a", 1, "u1"), ("user", "a", 2, "u2"), ("blog", "b", 5, "u5"),
         ("blog", None, 0, "n"), ("blog", "c", 4, "u4")], "meta string, key string, seq int, url string")
    visited = spark.createDataFrame([("blog", "c"), ("blog", None)], SET)
    first = V.first_seen(cand, visited)
    assert sorted(tuple(r) for r in first.collect()) == [("blog", "a", 1), ("blog", "b", 5), ("user", "a", 2)]
    got = sorted(tuple(r) for r in V.with_rows(first, cand, ("seq",)).select("meta", "key", "seq", "url").collect())
    assert got == [("blog", "a", 1, "u1"), ("blog", "b", 5, "u5"), ("user", "a", 2, "u2")]
    empty = spark.createDataFrame([], SET)
    assert V.first_seen(cand, empty).count() == 4


def test_forget_member_reconcile_rekey(spark):
    visited = spark.createDataFrame([("blog", "a"), ("blog", "b"), ("user", "a"), ("blog", None)], SET)
    forget = spark.createDataFrame([("blog", "a"), ("user", "zz")], SET)
    assert sorted(tuple(r) for r in V.forget_keys(visited, forget).collect() if r.key) == [("blog", "b"), ("user", "a")]
    cand = spark.createDataFrame([("blog", "a"), ("blog", "x"), ("blog", None)], SET)
    got = sorted((r.key or "", r.is_member) for r in V.is_member(cand, visited).collect())
    assert got == [("", False), ("a", True), ("x", False)]
    # stored URLs carry the prefix, set members may or may not: both sides re-keyed
    members = spark.createDataFrame([("blog", "a"), ("blog", "https://x.net/b"), ("blog", "c"), ("user", "a")], SET)
    stored = spark.createDataFrame([("https://blog.x.net/a",), ("https://blog.x.net/b",), (None,)], "url string")
    got = sorted(tuple(r) for r in V.reconcile(members, stored, "blog").collect())
    assert got == [("blog", "a", "kept"), ("blog", "b", "kept"), ("blog", "c", "stale")]
    assert V.reconcile(members, stored.limit(0), "blog").where("status = 'kept'").count() == 0
    keys = spark.createDataFrame([("blog", "https://blog.x.net/a"), ("blog", "a"), ("blog", "https://x.org/q")], SET)
    assert sorted(tuple(r) for r in V.rekey(keys).collect()) == [("blog", "a"), ("blog", "https://x.org/q")]


def test_frontier_union_drops_empty(spark):
    a = spark.createDataFrame([("blog", "https://x.net/a", 1), ("blog", "", 2)], "meta string, url string, seq int")
    b = spark.createDataFrame([("user", "https://x.net/u", 3), ("user", None, 4)], "meta string, url string, seq int")
    f = V.first_seen(V.keyed(V.frontier_union(a, b), "url"), None)
    assert sorted((r.meta, r.key) for r in f.collect()) == [("blog", "a"), ("user", "u")]


def bfs(edges, seeds):
    adj = {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    depth = {s: 0 for s in seeds}
    q = deque(seeds)
    while q:
        n = q.popleft()
        for m in adj.get(n, []):
            if m not in depth:
                depth[m] = depth[n] + 1
                q.append(m)
    return depth


def test_crawl_closure_against_bfs(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("c", "d"), ("x", "y"), ("d", "e"), ("e", "f")]
    e = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("lonely",)], "node string")
    got = {r.node: r.depth for r in G.crawl_closure(spark, e, seeds).collect()}
    assert got == bfs(edges, ["a", "lonely"])
    capped = {r.node: r.depth for r in G.crawl_closure(spark, e, seeds, max_depth=2).collect()}
    assert capped == {k: v for k, v in got.items() if v <= 2}


def test_challenge_split_and_severity(spark):
    pages = spark.createDataFrame([(1, "ok", 0), (2, "x arg1 y", 0), (3, "arg1", 2), (4, None, 0)],
                                  "page_id long, html string, attempt int")
    got = {r.page_id: (r.route, r.next_attempt) for r in R.challenge_split(pages, max_attempts=3).collect()}
    assert got == {1: ("content", 0), 2: ("retry", 1), 3: ("reject", 3), 4: ("content", 0)}
    ev = spark.createDataFrame([(1, "error"), (2, "view"), (3, "ERROR")], "id int, level string")
    assert sorted((r.id, r.sink) for r in R.severity_route(ev).collect()) == [(1, "error"), (2, "main"), (3, "error")]
    tee = sorted((r.id, r.sink) for r in R.severity_route(ev, tee_all=True).collect())
    assert tee == [(1, "error"), (1, "main"), (2, "main"), (3, "error"), (3, "main")]


def test_write_then_mark_is_idempotent(spark):
    recs = spark.createDataFrame([(1, "https://x.net/a"), (2, "https://x.net/b"), (3, "ftp://x.net/c")],
                                 "id long, url string")
    path = scratch_path(spark, "t_marked")
    _, v1 = R.write_then_mark(recs, path, None, "blog")
    v1 = spark.createDataFrame(v1.collect(), SET)
    _, v2 = R.write_then_mark(recs.limit(1), path, v1, "blog")
    assert sorted(tuple(r) for r in v2.collect()) == [("blog", "a"), ("blog", "b")]
    stored, v3 = R.write_then_mark(recs.unionByName(recs), path, v1, "blog")
    # run again, and with every record twice: nothing is stored a second time, and no ineligible URL at all
    assert sorted(tuple(r) for r in stored.collect()) == [(1, "https://x.net/a"), (2, "https://x.net/b")]
    assert sorted(tuple(r) for r in v3.collect()) == [("blog", "a"), ("blog", "b")]
    assert [r.url for r in R.ineligible_rejects(recs).collect()] == ["ftp://x.net/c"]


def test_write_then_mark_with_keys_in_buckets(spark, monkeypatch):
    recs = spark.createDataFrame([(i, f"https://x.net/k{i}") for i in range(30)], "id long, url string")
    path = scratch_path(spark, "t_marked_held")
    held = V.VisitedTable(spark, path + "_keys", buckets=4)
    R.write_then_mark(recs.where("id < 10"), path, None, "blog", held=held)
    stored, _ = R.write_then_mark(recs.where("id < 20"), path, None, "blog", held=held)
    assert sorted(r.id for r in stored.collect()) == list(range(20))

    class Gone(Exception):
        pass

    def crash(*_):
        raise Gone

    calls, real = [], R._index_writes
    with monkeypatch.context() as m:   # dies once the rows are written, before their keys are
        m.setattr(R, "_index_writes", lambda *a: calls.append(1) or (real if len(calls) == 1 else crash)(*a))
        try:
            R.write_then_mark(recs.where("id < 25"), path, None, "blog", held=held)
            raise AssertionError
        except Gone:
            pass
    stored, new = R.write_then_mark(recs, path, None, "blog", held=V.VisitedTable(spark, path + "_keys"))
    assert sorted(r.id for r in stored.collect()) == list(range(30)) and new.count() == 5
    assert held.read().where("meta = 'blog'").distinct().count() == 30


def test_first_seen_orders_by_two_columns(spark):
    big = 2**62
    rows = [("m", "k", -5, big), ("m", "k", -5, -big), ("m", "k", 7, 0), ("m", "l", 0, -1), ("m", "l", 0, 0), ("m", "n", 10**15, 1), ("m", "n", 10**15, -1)]
    cand = spark.createDataFrame(rows, "meta string, key string, a long, b long")
    got = sorted(tuple(r) for r in V.first_seen(cand, None, ("a", "b")).collect())
    assert got == [("m", "k", -5, -big), ("m", "l", 0, -1), ("m", "n", 10**15, -1)]


def test_visited_table_reads_history_without_a_shuffle(spark):
    import contextlib
    import io
    table = V.VisitedTable(spark, scratch_path(spark, "t_visited"), buckets=8)
    try:
        assert table.read() is None
        keys = spark.createDataFrame([("blog", f"k{i}") for i in range(50)], SET)
        table.append(keys)
        table.append(keys.limit(10))
        batch = V.keyed(spark.createDataFrame([(f"https://x.net/k{i}", i) for i in range(40, 60)], "url string, seq int"), "url", "blog")
        for _ in range(2):
            first = V.first_seen(batch, table.read())
            assert sorted(r.key for r in first.collect()) == [f"k{i}" for i in range(50, 60)]
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                first.explain()
            plan = buf.getvalue().split("== Initial Plan ==")[-1] if "== Initial Plan ==" in buf.getvalue() else buf.getvalue()
            assert plan.count("Exchange hashpartitioning") == 1, plan   # the batch's own
            table.compact()
        assert table.read().count() == 50
    finally:
        table.drop()


def test_attempts_are_carried_by_url(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "page_id long, url string, html string")
    retries = spark.createDataFrame([(1, "a", 1), (1, "a", 2)], "page_id long, url string, attempt int")
    got = {r.url: r.attempt for r in R.with_attempts(pages, retries).collect()}
    assert got == {"a": 2, "b": 0}


def test_closure_hubs_get_salts_by_their_degree(spark):
    edges = [("hub", f"n{i}") for i in range(100)] + [(f"n{i}", f"n{i + 1}") for i in range(100, 140)] + [("n5", "n100"), ("hub", "n0")]
    both = edges + [(b, a) for a, b in edges]
    e = spark.createDataFrame(both, "src string, dst string")
    seed = spark.createDataFrame([("n3",)], "node string")
    for symmetric in (False, True):
        got = {r.node: r.depth for r in G.crawl_closure(spark, e, seed, hub_edges=7, symmetric=symmetric).collect()}
        assert got == bfs(both, ["n3"])


def test_members_snapshot_and_edges(spark, tmp_root):
    raw = spark.createDataFrame([("blog", bytearray("键".encode())), ("blog", bytearray(b"a")), ("user", bytearray(b"a")),
                                 ("blog", bytearray(b"a"))], "meta string, key binary")
    assert sorted(r.key for r in V.members(raw, "blog").collect()) == ["a", "键"]
    path = V.snapshot(V.members(raw, "blog"), scratch_path(spark, "t_snap"), "1")
    assert sorted(r.key for r in spark.read.parquet(path).collect()) == ["a", "键"]
    feed = spark.createDataFrame([("L", "A", "U", None), ("L", None, None, "bad")],
                                 "url string, article_href string, user_href string, reject_reason string")
    prof = spark.createDataFrame([("https://b.net/u", 2, None)], "url string, page_count long, reject_reason string")
    edges = G.link_edges(G.feed_edges(feed), G.list_page_edges(prof))
    assert sorted(tuple(r) for r in edges.collect()) == [
        ("L", "A", "article"), ("L", "U", "author"),
        ("https://b.net/u", "https://b.net/u/article/list/1", "list"),
        ("https://b.net/u", "https://b.net/u/article/list/2", "list")]


def test_write_per_file(spark):
    from webcorpus.operators import corpus as C
    from webcorpus.sources import tables as S
    df = spark.createDataFrame([("a.txt", "x\n"), ("b.txt", "y\n")], "file_name string, text string")
    path = scratch_path(spark, "t_perfile")
    C.write_per_file(df, path)
    back = S.read_text_files(spark, path + "/file_name=a.txt")
    assert [r.text for r in back.collect()] == ["x\n"]


def test_files_are_written_by_the_tasks(spark):
    """Odd, empty, repeated and null names and texts as Spark's text writer stores them, without its cost for each file."""
    import os

    from webcorpus.operators import corpus as C
    rows = [("a/b:c=d%", "x\n\n"), ("e f.txt", None), ("", "empty"), (None, "none"), ("twice", "t"), ("twice", "t"), ("\x01{é}[^]\\", "你\r\n好")]
    df = spark.createDataFrame(rows, "file_name string, text string").repartition(3)
    one, two, each = (scratch_path(spark, n) for n in ("t_names", "t_names_spark", "t_each"))
    C.write_per_file(df, one)
    body = df.selectExpr("file_name", r"regexp_replace(text, '\\n\\z', '') AS text")
    body.repartition("file_name").write.partitionBy("file_name").text(two)

    def back(path):
        return sorted(((r.file_name or "", r.value) for r in spark.read.text(path, wholetext=True).collect()))
    assert back(one) == back(two) and len(back(one)) == 5
    C.write_each(df, each)
    assert sorted(r.value for r in spark.read.text(each, wholetext=True).collect()) == sorted((t or "") + "\n" for _, t in rows)
    for path in (one, each):
        names = [n for _, _, files in os.walk(path.removeprefix("file:")) for n in files]
        assert names and not [n for n in names if n.endswith(".crc")]


def _file_tasks(df):
    """Files that a plan makes the driver list."""
    return len(df.inputFiles())


def test_per_file_outputs_are_read_back_by_tasks(spark):
    """The driver lists no folder or file of them; names, nulls and bytes come back as Spark's reader gives them."""
    from webcorpus.operators import corpus as C
    from webcorpus.plans.queries import per_file_outputs
    rows = [("a/b:c=d%", "x\n\n"), ("%41 %zz%", "p"), ("e f.gz", None), ("", "empty"), (None, "none"), ("twice", "t"), ("twice", "u"), ("_h", ""), (".h", "\r\ny"), ("\x01{é}[^]\\\n%", "你\r\n好")]
    path, folder, empty = (scratch_path(spark, n) for n in ("t_back", "t_back_docs", "t_back_none"))
    C.write_per_file(spark.createDataFrame(rows, "file_name string, text string").repartition(3), path)
    spark_reads = sorted((r.file_name or "", r.value) for r in spark.read.text(path, wholetext=True).collect())
    back = C.read_per_file(spark, path)
    assert back.schema.simpleString() == "struct<file_name:string,text:string>" and not _file_tasks(back)
    got = sorted((r.file_name or "", r.text) for r in back.collect())
    assert got == spark_reads and len(got) == 8
    spark.createDataFrame([(1, "a\r\nb\n"), (2, ""), (3, None), (4, "a")], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    out = per_file_outputs(spark, folder)
    assert not _file_tasks(out) and sorted(map(tuple, out.collect())) == [("d1", "a\nb"), ("d2", ""), ("d3", ""), ("d4", "a")]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{empty}/documents.parquet")
    assert per_file_outputs(spark, empty).collect() == []


def test_text_folders_are_read_by_tasks(spark, tmp_path):
    """The driver lists none of a folder's files; the tasks read what Spark's reader reads, bytes as they are."""
    import gzip

    from webcorpus.plans.queries import wholetext_lines, wholetext_scan
    from webcorpus.sources import tables as S
    plain, packed, nested = tmp_path / "plain", tmp_path / "packed", tmp_path / "nested"
    for at in (plain, packed, nested / "k=1"):
        at.mkdir(parents=True)
    files = {"a.txt": b"x\r\ny\rz\n\n", "b%20é \n.txt": "你\r".encode(), "no end": b"\xef\xbb\xbfq", "bad": b"\xff\xfe\x00", "empty": b"", "_hidden": b"h", ".hidden": b"h", "_k=v": b"kv", "c._COPYING_": b"h", "large": b"w" * 9_000_000}
    for name, body in files.items():
        (plain / name).write_bytes(body)
    (packed / "a.gz").write_bytes(gzip.compress(b"zipped\n"))
    (packed / "b").write_bytes(b"plain\n")
    (nested / "k=1" / "a").write_bytes(b"deep\n")
    whole = F.regexp_replace("value", r"\r\n?", "\n")

    def spark_reads(path):
        return sorted(map(tuple, spark.read.text(str(path), wholetext=True).select("_metadata.file_name", F.hex(whole)).collect()))
    for path, n in ((plain, 6), (packed, 2), (nested, 1), (f"{plain}/a*", 1), (plain / "a.txt", 1)):
        got = S.read_text_files(spark, str(path))
        assert sorted(map(tuple, got.select("file_name", F.hex("text")).collect())) == spark_reads(path) and got.count() == n, path
    assert not _file_tasks(S.read_text_files(spark, str(plain)))
    folder = scratch_path(spark, "t_whole_docs")
    spark.createDataFrame([("a\r\nb\n",), ("",), ("a",), ("a",)], "text string").write.parquet(f"{folder}/documents.parquet")
    scan, lines = wholetext_scan(spark, folder), wholetext_lines(spark, folder)
    assert not _file_tasks(scan) and sorted(r.text for r in scan.collect()) == ["", "a", "a", "a\nb\n"]
    assert not _file_tasks(lines) and sorted(r.line for r in lines.collect()) == ["", "", "a", "a", "a", "b"]


def test_write_sinks_one_pass(spark):
    ev = spark.createDataFrame([(1, "error"), (2, "view"), (3, "click")], "id int, level string")
    path = scratch_path(spark, "t_sinks")
    R.write_sinks(R.severity_route(ev), path)
    assert sorted(r.id for r in spark.read.parquet(path + "/sink=error").collect()) == [1]
    assert sorted(r.id for r in spark.read.parquet(path + "/sink=main").collect()) == [2, 3]


def test_first_seen_rows_matches_first_seen(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    dup = p.unionByName(p.withColumn("page_id", F.col("page_id") + 100000))   # every key twice
    cand = V.keyed(dup, "url", "blog")
    visited = V.keyed(p.where(F.col("page_id") % 3 == 0).select("url"), "url", "blog").select("meta", "key")
    wide = V.first_seen_rows(cand, visited, "page_id").select("meta", "key", "page_id", "html")
    narrow = V.with_rows(V.first_seen(cand, visited, order_cols=("page_id",)), cand, ("page_id",)).select("meta", "key", "page_id", "html")
    assert wide.exceptAll(narrow).count() == 0 and narrow.exceptAll(wide).count() == 0
    assert wide.count() == narrow.count() > 0


def test_skewed_inputs_stay_exact(spark):
    """One key / one hub holding a third of all rows: results stay exact
    and whole (nothing dropped or capped)."""
    # hub node: a third of all edges leave "hub"
    edges = [("hub", f"n{i}") for i in range(300)] + [(f"n{i}", f"m{i}") for i in range(600)]
    e = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.depth for r in G.crawl_closure(spark, e, spark.createDataFrame([("hub",)], "node string"),
                                                    hub_edges=75).collect()}
    assert got == bfs(edges, ["hub"]) and len(got) == 1 + 300 + 300
    # first-seen: one (meta, key) holds a third of the candidates
    rows = [("blog", "hot", i) for i in range(1000)] + [("blog", f"k{i}", i) for i in range(2000)]
    cand = spark.createDataFrame(rows, "meta string, key string, seq int")
    out = {r.key: r.seq for r in V.first_seen(cand).collect()}
    assert out["hot"] == 0 and len(out) == 2001
    # last write per title: one title holds a third of the rows
    from webcorpus.operators import corpus as C
    docs = spark.createDataFrame([("same", i, f"c{i}") for i in range(1000)] + [(f"t{i}", 5000 + i, "x") for i in range(2000)],
                                 "title string, page_id int, content string")
    last = {r.title: (r.page_id, r.content) for r in C.last_by_title(docs).collect()}
    assert last["same"] == (999, "c999") and len(last) == 2001


def test_list_pages_in_bounded_chunks(spark):
    df = spark.createDataFrame([("u", 25_003), ("v", 0), ("w", 1), ("x", None), ("y", 3)], "url string, n long")
    rows = G.list_pages(df, "url", "n", chunk=1000).collect()
    got = {}
    for r in rows:
        got.setdefault(r.url, []).append(r.page_no)
    assert sorted(got["u"]) == list(range(1, 25_004)) and "v" not in got and "x" not in got
    assert sorted(got["y"]) == [1, 2, 3] and got["w"] == [1]
    assert all(r.list_url == f"{r.url}/article/list/{r.page_no}" for r in rows)
    excl = G.list_pages(df, "url", "n", include_last=False, chunk=1000)
    # without the last page, a one-page author yields none
    assert sorted(r.list_url for r in excl.where("n < 100").collect()) == ["y/article/list/1", "y/article/list/2"]
    assert excl.where("url = 'u'").count() == 25_002


def test_documented_error_paths(spark):
    import pytest
    from pyspark.sql import types as T
    from webcorpus.plans.queries import enforce_schema
    from webcorpus.sources import tables as S
    spark.createDataFrame([(1,), (2,)], "x int").createOrReplaceTempView("t_two_rows")
    with pytest.raises(ValueError):
        S.sql_single_row(spark, "SELECT x FROM t_two_rows")          # S8: more than one row
    with pytest.raises(ValueError):
        S.sql_single_row(spark, "SELECT x FROM t_two_rows WHERE x > 5")  # S8: none
    assert S.sql_single_row(spark, "SELECT max(x) AS m FROM t_two_rows").first().m == 2
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    with pytest.raises(ValueError):
        enforce_schema(spark.createDataFrame([("1",)], "a string"), schema)            # R3: missing column
    with pytest.raises(ValueError):
        enforce_schema(spark.createDataFrame([("1", "2", "3")], "a string, b string, c string"), schema)  # unknown
    assert enforce_schema(spark.createDataFrame([("2", "1")], "b string, a string"), schema).columns == ["a", "b"]
    sets = spark.createDataFrame([("blog", "k")], SET)
    base = scratch_path(spark, "t_versions")
    V.snapshot(sets, base, "1")
    with pytest.raises(Exception):
        V.snapshot(sets, base, "1")                                   # K7: a version is never overwritten


def test_session_settings_of_the_caller_win(spark):
    from webcorpus.session import DEFAULT_CONF, apply_runtime_conf, build_session
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    other = spark.newSession()
    other.conf.set(key, "77")
    apply_runtime_conf(other)
    assert other.conf.get(key) == "77" and other.conf.get("spark.sql.session.timeZone") == "UTC"
    bare = spark.newSession()
    bare.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    apply_runtime_conf(bare)   # documented settings reach a session that has none
    assert bare.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == DEFAULT_CONF["spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = spark.conf.get(key)
    spark.conf.set(key, "78")
    try:
        assert build_session().conf.get(key) == "78"
    finally:
        spark.conf.set(key, before)


def test_scratch_is_removed_only_under_the_shared_folder(spark, tmp_path):
    import pytest

    from webcorpus.session import path_exists, remove_scratch
    path = scratch_path(spark, "t_gone")
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    remove_scratch(spark, path)
    assert not path_exists(spark, path)
    with pytest.raises(ValueError):
        remove_scratch(spark, str(tmp_path))
