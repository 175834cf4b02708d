"""URL and number rules against Python models."""

import random
from urllib.parse import urljoin

from pyspark.sql import functions as F

from webcorpus.functions import numbers as N
from webcorpus.functions import urls as U


KEYS = {  # literal expectations: http(s) in any case, and exactly one ".net/"
    "https://blog.x.net/a/b?q=1#f": "a/b?q=1#f", "https://x.org/a": None, "https://a.net/b.net/c": None, "ftp://x.net/a": None,
    "HTTPS://X.net/a": "a", "https://one.x.net/p": "p", "https://two.x.net/p": "p", "https://x.net/p?q=2": "p?q=2",
    "http://x.net/": "", "x.net/a": None, "https:x.net/a": "a", "https://x.net": None, "http://x.NET/a": None,
    "https://x.net/a.net": "a.net", "https://h/x.net/y z": "y z", "mailto:x.net/a": None, "": None,
}


def test_visit_key(spark):
    df = spark.createDataFrame([(u,) for u in [*KEYS, None]], "url string")
    assert [r[0] for r in df.select(U.visit_key("url")).collect()] == [*KEYS.values(), None]


def py_int(s, default=0):
    try:
        v = int(s)
    except Exception:
        return default
    return v if -2**63 <= v < 2**63 else default


def test_lenient_int_against_python(spark):
    vals = ["18万+", " 12 ", "1_000", "１２", "12.0", "", "99999999999999999999", "-7", "+3", "1__0", "_1", "\u3000８\u3000",
            "0x10", "١٢", "12a", "\t5\n", None]
    rnd = random.Random(3)
    vals += ["".join(rnd.choice("0123456789 _+-.a") for _ in range(rnd.randint(0, 6))) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(N.lenient_int("s")).collect()]
    exp = [py_int(v) for v in vals]
    # documented difference: Python also reads other Unicode digits (Arabic-Indic here)
    diffs = [(v, g, e) for v, g, e in zip(vals, got, exp) if g != e and v != "١٢"]
    assert not diffs, diffs[:5]


def test_ceil_div_and_blank_to_zero(spark):
    df = spark.createDataFrame([(0, 20), (20, 20), (21, 20), (5, 0), (None, 3)], "t long, s long")
    assert [r[0] for r in df.select(N.ceil_div("t", "s")).collect()] == [0, 1, 2, None, None]
    df2 = spark.createDataFrame([(" \r\n",), (" 7 ",), ("",)], "c string")
    assert [r[0] for r in df2.select(N.blank_to_zero("c")).collect()] == ["0", "7", "0"]


FOLLOW = {  # literal expectations
    "https://blog.h.net/u": "https://me.h.net/follow/u",
    "https://blog.h.net/a/u": "https://me.h.net/follow/u",
    "http://blog.h.net/a/b/u?x=1": "http://me.h.net/a/follow/u?x=1",
    "https://h.net/u": "https://h.net/follow/u",
    "https://blog.h.net/en/853/": "https://me.h.net/en/follow/",
    "https://h.net/blog/u": "https://h.net/follow/u",
    "HTTP://blog.h.net/a/u": "http://me.h.net/follow/u",
    "https://blog.h.net/a/../b/u": "https://me.h.net/follow/u",
    "https://blog.h.net/a/u#f": "https://me.h.net/follow/u#f",
    "https://blog.h.net//u": "https://me.h.net/follow/u",
    "no slash": None, None: None,
}


def test_follow_url(spark):
    df = spark.createDataFrame([(u,) for u in FOLLOW], "url string")
    got = dict(zip(FOLLOW, [r[0] for r in df.select(U.follow_url("url")).collect()]))
    assert got == FOLLOW
    lit = df.select(U.follow_url(F.lit("https://blog.h.net/blogger"), literal=True)).first()[0]
    assert lit == "https://me.h.net/follow/meger"


def test_resolve_url_against_urljoin(spark):
    bases = ["https://a.net/x/y?q=1#f", "http://b.org/", "https://c.com/dir/page.html", "https://d.net"]
    hrefs = ["/abs", "rel", "../up", "./same", "//other.host/p", "https://e.org/z", "?q=2", "#frag", "",
             "/a/../b", "mailto:x@y", "HTTP://F.org/Q", "a b"]
    rows = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(rows, "base string, href string")
    got = [r[0] for r in df.select(U.resolve_url("base", "href")).collect()]
    exp = [urljoin(b, h) for b, h in rows]
    diffs = [(r, g, e) for r, g, e in zip(rows, got, exp) if g != e]
    assert not diffs, diffs[:5]


def test_nav_target_keeps_section_links(spark):
    df = spark.createDataFrame([("https://x.net/r", "/main"), ("https://x.net/r", "/cloud/x"),
                                ("https://x.net/r", "/java")], "b string, h string")
    got = [r[0] for r in df.select(U.nav_target("b", "h")).collect()]
    assert got == ["/main", "/cloud/x", "https://x.net/java"]  # 'ai' inside 'main' is a plain substring hit


def test_resolve_url_random_against_urljoin(spark):
    rnd = random.Random(9)
    bases = ["https://a.net", "https://a.net/", "http://b.org/x/y", "HTTPS://C.com/d/e.html?q=1#f", "https://u@h:8/p;x/q",
             "https://h/a//b/", "https://h/./a/../b"]
    bases += ["https://h/a/b", "https://h/a/b/", "https://h/a.b/c", "https://h.net/~u/x=1", "https://h/.a/b"]
    parts = ["/", "a", "b", "..", ".x", "y.z/w", "c=1&d", ".", "", "?q", "#f", ";p", "//h2", "http:", "https://z.org", "HTTP://Y", "x y", "%20", "é"]
    rows = [(rnd.choice(bases), "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 4)))) for _ in range(600)]
    df = spark.createDataFrame(rows, "base string, href string")
    got = [r[0] for r in df.select(U.resolve_url("base", "href")).collect()]
    diffs = [(b, h, g, urljoin(b, h)) for (b, h), g in zip(rows, got) if g != urljoin(b, h)]
    assert not diffs, diffs[:5]


def joined(base, href):
    """``urljoin``, null where it raises."""
    try:
        return urljoin(base, href)
    except ValueError:
        return None


def test_resolve_url_20000_pairs_without_python(spark):
    rnd = random.Random(17)
    pieces = ["/", "//", "a", "b.c", "..", ".", "...", ".x", "y;p=1", ";", "?", "?q=1", "#", "#f", "http:", "https://z.org", "HTTP://Y.Org", "ftp://f/x", "file:", "mailto:m@n",
              "x y", "%20", "é", "日", "\t", "\n", " ", "\x01", "[::1]", "[", "]", "[v1.a]", "[1.2.3.4]", "℀", "：", "@", ":80", "+", "C", "//h2/", "\\", "&", "=", "1:2", "svn+ssh://s/t"]
    bases = ["https://a.net", "https://a.net/", "http://b.org/x/y", "HTTPS://C.com/d/e.html?q=1#f", "https://u@h:8/p;x/q;r", "https://h/a//b/", "https://h/./a/../b", "file:///etc/x",
             "", "a/b", "/r/s", "//n/p", "mailto:x@y", "http://[::1]:8/a/b", "http://[zz]/a", "https://h/a.b/c/"]
    rows = []
    for _ in range(20_000):
        href = "".join(rnd.choices(pieces, k=rnd.randint(0, 6)))
        rows.append((rnd.choice(bases) if rnd.random() < 0.7 else "http://h" + "".join(rnd.choices(pieces, k=rnd.randint(0, 5))), href))
    df = spark.createDataFrame(rows, "base string, href string").select(U.resolve_url("base", "href").alias("u"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    diffs = [(b, h, r[0], joined(b, h)) for (b, h), r in zip(rows, df.collect()) if r[0] != joined(b, h)]
    assert not diffs, (len(diffs), diffs[:8])


def test_resolve_url_of_100000_segments(spark):
    n = 100_000
    rows = [("https://a.net/x", "/seg" * n), ("https://a.net/x/y", "seg/" * n), ("https://a.net" + "/seg" * n, "rel"), ("https://a.net" + "/seg" * n, "../up?q#f"),
            ("https://a.net/x", "../" * n + "z"), ("https://a.net" + "/s" * n, "../" * (n // 2) + "z"), ("https://a.net/x", "a/./../" * (n // 3) + "end"),
            ("https://a.net/x", "?" + "q" * n), ("https://" + "h" * n + "/x", "/r"), ("https://a.net/x", "//" + "/" * n), ("https://a.net/" + "long" * n, "r;s")]
    df = spark.createDataFrame(rows, "base string, href string")
    assert [r[0] for r in df.select(U.resolve_url("base", "href")).collect()] == [urljoin(b, h) for b, h in rows]
    urls = ["https://blog.h.net" + "/a" * n, "https://blog.h.net/" + "a" * n + "/u"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(U.follow_url("url")).collect()]
    assert got == ["https://me.h.net" + "/a" * (n - 2) + "/follow/a", "https://me.h.net/follow/u"]
