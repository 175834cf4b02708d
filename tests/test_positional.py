"""Native positional rules against the tree: regular pages, pages with things out of the ordinary, hostile pages."""

import random
import re

import pytest

from test_extract import _pages, article, profile
from webcorpus.operators import extract as X
from webcorpus.plans import render as RD

SF = "/root/testdata/sf0.001"
RULES = {"article": (X.Rule("article", X.ARTICLE_FIELDS, X._article_parse), X._article_native),
         "profile": (X.Rule("profile", X.PROFILE_FIELDS, X._profile_parse), X._profile_native)}
ODD = ["<!-- c -->", "<!-- <div> -->", "&eacute;", "&amp;", "&lt;b&gt;", " & ", "<b>b</b>", "text", "\n", "<br>", "<br/>", "<img src=\"x\">", "<p>", "</p>", "<p>q</p>", "<li>", "</li>",
       "<ul><li>n</li></ul>", "<div>", "</div>", "<div class=\"title\">t</div>", "<DIV>", "<a href='/q'>q</a>", "<a class=\"k\" title=\"x &quot;y&quot;\" href=\"/k\">k</a>", "<a title=\"1\" title=\"2\">d</a>",
       "<script>if (a && b < c) { x('<div>') }</script>", "<script><!-- s --></script>", "<script></script>", "<style>p{}</style>", "<title>a<b></title>", "<textarea><div></textarea>",
       "<!doctype html>", "<span class=\"time\"></span>", "<span class=\"time\">later</span>", "<h1></h1>", "<h1>two</h1>", "<dl><dt>x</dt><dd title=\"9\">y</dd></dl>", "<x/>", "</x>", "\u0001", "<button><p>b</p></button>",
       "<main><div>m</div></main>", "<div id=\"mainBox\"><main></main></div>", "<div class=\"tool-box z\"><ul><li>1</li></ul></div>", "<div id=\"asideProfile\"></div>", "<body>", "<td>", "<svg></svg>"]


def mutated(page, rnd):
    parts = re.findall(r"<[^<>]*>|[^<>]+", page)
    for _ in range(rnd.randint(1, 3)):
        at = rnd.randrange(len(parts) + 1)
        what = rnd.random()
        if what < 0.6:
            parts.insert(at, rnd.choice(ODD))
        elif what < 0.8 and parts:
            del parts[min(at, len(parts) - 1)]
        elif parts:
            at = min(at, len(parts) - 1)
            parts[at] = rnd.choice([parts[at].upper(), parts[at].replace('"', "'"), parts[at].replace(" ", "\n "), parts[at].replace("=", " = ", 1), parts[at] * 2])
    return "".join(parts)


def rows(df):
    return sorted(map(str, df.collect()))


def regular(pages, native):
    return native(pages).where("_rec IS NOT NULL")


@pytest.mark.parametrize("name", sorted(RULES))
def test_equal_to_the_tree_on_odd_pages(spark, name):
    rnd = random.Random(name)
    table, render = ("orders", RD.article_pages) if name == "article" else ("customer", RD.profile_pages)
    rule, native = RULES[name]
    wholes = [r.html for r in X.extract(render(spark.read.parquet(f"{SF}/{table}.parquet")), rule).where("reject_reason IS NULL").select("page_id")
              .join(render(spark.read.parquet(f"{SF}/{table}.parquet")), "page_id").orderBy("page_id").limit(3).collect()]
    whole = wholes[0]
    pages = [whole, "", None, "no tag", "<p>x</p>"] + [whole.replace(">", ">" + o, 1) for o in ODD] + [whole + o for o in ODD] + [article(), profile()]
    pages += [mutated(rnd.choice(wholes), rnd) for _ in range(900)]
    df = _pages(spark, [(f"https://blog.x.net/{i}", h) for i, h in enumerate(pages)]).repartition(4).cache()
    a, b = rows(X.extract_record(df, rule, native)), rows(X.extract(df, rule))
    assert [x for x, y in zip(a, b) if x != y] == [] and len(a) == len(b)
    assert regular(df, native).count() > 100   # many of them without the tree
    df.unpersist()


def test_rendered_pages_are_all_regular(spark):
    orders, customers = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "customer"))
    for name, pages in (("article", RD.article_pages(orders)), ("profile", RD.profile_pages(customers))):
        rule, native = RULES[name]
        assert regular(pages, native).count() == pages.count()
        assert rows(X.extract_record(pages, rule, native)) == rows(X.extract(pages, rule))


def test_hostile_pages_neither_crash_nor_hang(spark):
    n = 30_000
    pages = ["<div>" * n, "<div>" * 900 + "</div>" * 900, "<a" + ' x="y"' * n + ">t</a>", "<!-- c -->" * n, "<script>" + "x" * n + "</script>", "<b>t</b>" * n, "<b>t</b>" * 900,
             "<td>" * n, "&" * n, ">" * n, '<a href="' + "y" * n + '">z</a>', "<" + "b" * n + ">", "<div id=\"mainBox\">" + "x" * n, "<h1>" + "<b/>" * n, "<!-- " * 500, "<p " * 500, "<" * 500]
    df = _pages(spark, [(f"https://blog.x.net/{i}", h) for i, h in enumerate(pages)])
    for name, (rule, native) in RULES.items():
        got = X.extract_record(df, rule, native).collect()
        assert len(got) == len(pages) and all(r.reject_reason for r in got)


def test_no_page_is_parsed_in_python_when_all_are_regular(spark, monkeypatch):
    def parse(html):
        raise AssertionError("parsed")

    pages = RD.article_pages(spark.read.parquet(f"{SF}/orders.parquet"))
    rule, native = RULES["article"]
    broken = X.Rule(rule.name, rule.fields, lambda *_: parse(None))
    got = X.extract_record(pages, broken, native)
    assert got.where("reject_reason like 'error%'").count() == 0 and got.count() == pages.count()
