"""Pages that one pattern explains whole: all rendered pages are, in one
pass, and with anything else in them the rows are those of the tree walk."""

import random

from pyspark.sql import functions as F

from webcorpus.operators import extract as X
from webcorpus.operators import flat as FL
from webcorpus.plans import render as RD

SF = "/root/testdata/sf0.001"
ODD = ["<!-- c -->", "&eacute;", "&amp;", "a&lt;b", "<b>b</b>", "</div>", "<div>", '<div class="tool-box"><ul><li><button><p>9</p></button></li></ul></div>',
       '<div id="mainBox"><main><div></div></main></div>', "<script>'<div>'</script>", "<p>", "</p>", "<br/>", "<li>", "</li>", "</ul>", "\u0001", "\u0002", "\n ",
       '<span class="time">t</span>', '<span class="a" class="time">t</span>', "</article>", "</body>", "<title>t</title>", '<ul class="tool-box"><li>l</li></ul>',
       '<dl title="t"><dt>x</dt></dl>', "<dd>", '<div class="badge-box"><div></div><div><div class="icon-badge" title="z"></div></div></div>',
       '<p id="asideProfile">', '<a title="q" TITLE="r">a</a>', "<h1>h</h1>", '<li class="clearfix">x</li>', "<script>var listTotal = 7;</script>", "<DIV>",
       '<p class="badge&#45;box">', ' id="asideProfile"', ' title="u"', ' CLASS="time"', ' class="tool-box"', "'", '"', "&"]
WHOLE = {"article": (X._article_page(), 8), "profile": (X._profile_page(), 11)}


def _rows(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").limit(40)
    customer = spark.read.parquet(f"{SF}/customer.parquet").limit(14)
    return {"article": (RD.article_pages(orders), X.article_detail, X.Rule("article", X.ARTICLE_FIELDS, X._article_parse), X.finish_article),
            "profile": (RD.profile_pages(customer), X.user_profile, X.Rule("profile", X.PROFILE_FIELDS, X._profile_parse), X.finish_profile),
            "feed": (RD.feed_pages(orders), X.feed_links, X.Rule("feed", X.FEED_FIELDS, X._feed_parse), None),
            "follow": (RD.followee_pages(orders), X.followee_links, X.Rule("follow", X.HREF_FIELDS, X._followee_parse), None),
            "list": (RD.article_list_pages(orders), X.article_list_links, X.Rule("list", X.HREF_FIELDS, X._article_list_parse), None)}


def test_whole_pages_and_tree_agree(spark):
    rnd = random.Random(5)
    for name, (pages, native, rule, finish) in _rows(spark).items():
        whole = [r.html for r in pages.select("html").collect()][:8]
        some = list(whole)
        for page in whole[:3]:
            cuts = [i for i, c in enumerate(page) if c == "<"] + [i + 1 for i, c in enumerate(page) if c == ">"] + [i for i, c in enumerate(page) if c == ">"]
            for o in ODD:
                some += [page[:i] + o + page[i:] for i in rnd.sample(cuts, 8)]
            some += [page[:i] + page[i + rnd.randint(1, 30):] for i in rnd.sample(range(len(page)), 40)]
            some += [page.replace('">', "\">&quot;'&#39;").replace("<p>", '<p class="x">'), page.replace(">", " >"), page + "\n", page.upper()]
        df = spark.createDataFrame([(i, f"https://blog.x.net/{i}", h) for i, h in enumerate(some)], "page_id long, url string, html string").repartition(8)
        if name in WHOLE:  # what no pattern explains whole goes by its parts or the tree, as before
            pattern, n = WHOLE[name]
            df = FL.read_whole(df, "_r", pattern, n).where(F.col("_r").isNotNull() | ~F.col("html").rlike(X.PROFILE_ID + r"(?!\w)") & F.lit(name == "profile")).drop("_r")
            df = spark.createDataFrame(df.collect(), df.schema).repartition(8)
            assert df.count() > 100
        by_tree = X.extract(df, rule, repartition=False)
        by_tree = finish(by_tree) if finish else by_tree
        got, cols = native(df), by_tree.columns
        a, b = (sorted(map(str, x.select(cols).collect())) for x in (got, by_tree))
        assert a == b, (name, [x for x in a if x not in b][:3], [x for x in b if x not in a][:3])


def test_rendered_pages_are_read_whole(spark):
    rows = _rows(spark)
    assert FL.read_whole(rows["article"][0], "_r", X._article_page(), 8).where("_r is null").count() == 0
    left = FL.read_whole(rows["profile"][0], "_r", X._profile_page(), 11).where("_r is null")
    assert left.where(F.col("page_id") % 7 != 0).count() == 0   # the others have no profile box


def test_pages_of_links_are_judged_once(spark):
    """The tree's rows come from the same pass over the pages as the native ones."""
    import contextlib
    import io
    for name in ("feed", "follow", "list"):
        pages, native, _, _ = _rows(spark)[name]
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            native(pages.select("page_id", "url", "html")).explain()
        assert "Union" not in buf.getvalue() and buf.getvalue().count("FileScan") == 1, name
