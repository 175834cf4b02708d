"""Round-trip pages: site-layout HTML rendered from driver tables.

The driver's ``pages`` table does not use the blog site's layout, so the
round-trip queries render that layout from ``customer`` / ``orders`` /
``supplier`` rows with native string functions (values HTML-escaped),
run the real extractor on the result, and the oracle selects the expected
values straight from the source table.  Faults are planted by key, so
rejects are checked as well; no row is filtered out.

List-like pages (feeds, follow lists, article lists, tables) group rows
by ``key div 20``: every page holds at most 20 items whatever the data
size, so ``collect_list`` never gathers an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rendered test site.
SITE = "example.net"
BLOG = "https://blog." + SITE
ME = "https://me." + SITE
ITEMS_PER_PAGE = 20
ORIGINAL = "原创"
REPOST = "转载"
READ_LABEL = "阅读数"


def esc(c) -> Column:
    """HTML-escape a value (``&`` first)."""
    x = c if isinstance(c, Column) else F.col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def s(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("string")


def user_url(custkey) -> Column:
    return F.concat(F.lit(BLOG + "/u"), s(custkey))


def article_url(custkey, orderkey) -> Column:
    return F.concat(user_url(custkey), F.lit("/article/details/"), s(orderkey))


# -- rules that no row of the driver tables reaches, planted by key -----------

DISPLAY_MATH = 'a  <span class="katex--display">x<b>y</b></span><br/>  b\r  c <i>d</i>\r\n'
WATCHERS_ITEM = '<li><a href="/watchers/x">w</a></li>'
CJK = "你好。今天天气很好！是吗？好"


def planted_pages(pages: DataFrame) -> DataFrame:
    """Pages with display math and carriage returns (id % 7 = 0) and a
    ``watchers`` link at the end of the navigation (id % 5 = 0)."""
    k, html = F.col("page_id"), F.col("html")
    html = F.when(k % 5 == 0, F.replace(html, F.lit("</ul></nav>"), F.lit(WATCHERS_ITEM + "</ul></nav>"))).otherwise(html)
    return pages.withColumn("html", F.when(k % 7 == 0, F.concat(F.lit(DISPLAY_MATH), html)).otherwise(html))


def planted_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every document, its whole text kept: some begin with
    sentences of another script (id % 6 = 0) or a tag (% 4 = 0).  Blank
    documents are rows of their own under negative ids: three spaces as
    -(2 id + 1) for id % 9 = 0, one newline as -(2 id + 2) for id % 10 = 0."""
    k, text = F.col("doc_id"), F.col("text")
    whole = F.when(k % 6 == 0, F.concat(F.lit(CJK), text)).when(k % 4 == 0, F.concat(F.lit("<p>tagged</p> "), text)).otherwise(text)

    def row(doc_id: Column, body: Column) -> Column:
        return F.struct(doc_id.alias("doc_id"), body.alias("text"))

    blanks = [F.when(k % 9 == 0, row(-2 * k - 1, F.lit("   "))), F.when(k % 10 == 0, row(-2 * k - 2, F.lit("\n")))]
    return docs.select(F.inline(F.filter(F.array(row(k, whole), *blanks), lambda r: r.isNotNull())))


# -- author profile pages (customer) -----------------------------------------

def profile_pages(customer: DataFrame) -> DataFrame:
    """One profile page per customer.  Faults: key % 7 = 0 has no profile
    box; % 5 = 0 shows credits as ``18万+``; % 11 = 0 has a badge without
    title; % 13 = 0 has page size 0."""
    k = F.col("c_custkey")
    dl = lambda title: F.concat(F.lit('<dl class="text-center" title="'), esc(s(title)), F.lit('"><dt>x</dt></dl>'))
    credits = F.when(k % 5 == 0, F.lit("18万+")).otherwise(s(F.floor(F.col("c_acctbal") * 100).cast("bigint")))
    badge2 = F.when(k % 11 == 0, F.lit('<div class="icon-badge"></div>')) \
        .otherwise(F.concat(F.lit('<div class="icon-badge" title="n'), s("c_nationkey"), F.lit('"></div>')))
    size = F.when(k % 13 == 0, F.lit(0)).otherwise(F.lit(20))
    box_id = F.when(k % 7 == 0, F.lit("asideProfileX")).otherwise(F.lit("asideProfile"))
    html = F.concat(
        F.lit('<html><head><title>profile</title></head><body><aside><div id="'), box_id, F.lit('" class="aside-box">'),
        F.lit('<div class="profile-intro d-flex"><div class="user-info d-flex"><div><span class="name"><a href="#">'),
        esc(F.concat(F.lit("\n\t "), F.col("c_name"), F.lit(" \n"))), F.lit("</a></span></div></div></div>"),
        F.lit('<div class="data-info d-flex item-tiling">'),
        dl(k), dl("c_nationkey"), dl(F.floor("c_acctbal").cast("bigint")), dl("c_mktsegment"),
        dl(F.lit("x")), dl(k * 3), F.lit("</div>"),
        F.lit('<div class="grade-box clearfix"><dl><dt>g</dt><dd><a href="#" title="'), esc("c_mktsegment"),
        F.lit('"></a></dd></dl><dl><dt>v</dt><dd>1</dd></dl><dl><dt>c</dt><dd title="'), credits,
        F.lit('">c</dd></dl><dl title="'), s(k + 1000), F.lit('"><dt>r</dt></dl></div>'),
        F.lit('<div class="badge-box d-flex"><div>b</div><div class="badges"><div class="icon-badge" title="'),
        esc("c_mktsegment"), F.lit('"></div>'), badge2, F.lit("</div></div>"),
        F.lit("</div></aside>"),
        F.lit("<script>var a=1;</script><script>var b=2;</script><script>var c=3;</script>"
              "<script>var d=4;</script><script>var e=5;</script>"),
        F.lit("<script>var listTotal = "), s(k % 97), F.lit(" ;var pageSize = "), s(size), F.lit(" ;</script>"),
        F.lit("</body></html>"))
    return customer.select(k.alias("page_id"), user_url(k).alias("url"), html.alias("html"))


# -- article pages (orders) --------------------------------------------------

def article_pages(orders: DataFrame) -> DataFrame:
    """One article page per order.  Faults: key % 11 = 0 has no ``h1``;
    % 17 = 0 has a read-count span without its label; % 4 = 0 has blank
    comments (stored as ``0``)."""
    k = F.col("o_orderkey")
    nature = F.when(F.col("o_orderstatus") == "O", F.lit(ORIGINAL)).otherwise(F.lit(REPOST))
    h1 = F.when(k % 11 == 0, F.lit("")).otherwise(
        F.concat(F.lit("<h1>"), esc(F.concat(F.lit("Order "), s(k), F.lit(" "), F.col("o_orderpriority"))), F.lit("</h1>")))
    rc_label = F.when(k % 17 == 0, F.lit("阅读 ")).otherwise(F.lit(READ_LABEL + " "))
    comments = F.when(k % 4 == 0, F.lit(" \n ")).otherwise(s(k % 50))
    html = F.concat(
        F.lit('<html><body><div id="mainBox"><main><div class="blog-content-box"><div class="article-header-box">'
              '<div class="article-header"><div class="article-title-box"><span class="article-type type-1">'),
        nature, F.lit("</span>"), h1, F.lit('</div><div class="article-info-box"><div class="article-bar-top">'
                                            '<span class="time">'),
        s(F.col("o_orderdate").cast("date")), F.lit('</span><span class="read-count">'), rc_label, s(k * 37 % 1000),
        F.lit('</span><a class="author" href="#">u'), s("o_custkey"), F.lit("</a></div></div></div></div>"),
        F.lit('<article class="post"><div class="article_content">'), content_markup(), F.lit("</div></article>"),
        F.lit('</div></main></div><div class="tool-box vertical"><ul class="menu-list"><li><button><p>'),
        s(F.col("o_custkey") % 100), F.lit("</p></button></li><li>x</li><li><a href=\"#\"><p>"), comments,
        F.lit("</p></a></li></ul></div></body></html>"))
    return orders.select(k.alias("page_id"), article_url("o_custkey", k).alias("url"), html.alias("html"))


def faulty_article_pages(orders: DataFrame) -> DataFrame:
    """Article pages of which key % 19 = 0 have a URL that is not http(s) and
    key % 23 = 0 hold the marker of a challenge page."""
    k, pages = F.col("page_id"), article_pages(orders)
    url = F.when(k % 19 == 0, F.concat(F.lit("ftp"), F.substring_index("url", "https", -1))).otherwise(F.col("url"))
    html = F.when(k % 23 == 0, F.concat(F.lit("<p>arg1</p>"), F.col("html"))).otherwise(F.col("html"))
    return pages.select("page_id", url.alias("url"), html.alias("html"))


def content_markup() -> Column:
    """The body node of an article page, exactly as rendered."""
    return F.concat(F.lit('<div id="content_views" class="markdown_views"><p>'), esc("o_orderpriority"),
                    F.lit("</p><p>"), s(F.floor(F.col("o_totalprice") * 100).cast("bigint")),
                    F.lit("<br></p></div>"))


# -- list-like pages (orders grouped by key div 20) --------------------------

def _grouped(df: DataFrame, key: str, item: Column, head: str, tail: str) -> DataFrame:
    g = F.floor(F.col(key) / ITEMS_PER_PAGE).cast("bigint")
    items = (df.select(g.alias("page_id"), F.struct(F.col(key).alias("k"), item.alias("v")).alias("it"))
               .groupBy("page_id").agg(F.array_sort(F.collect_list("it")).alias("its")))
    html = F.concat(F.lit(head), F.array_join(F.transform("its", lambda x: x["v"]), ""), F.lit(tail))
    return items.select("page_id", F.concat(F.lit(BLOG + "/list/"), s("page_id")).alias("url"), html.alias("html"))


def feed_pages(orders: DataFrame) -> DataFrame:
    """Feed items (article link + author link); key % 9 = 0 lacks the
    author link."""
    k = F.col("o_orderkey")
    user = F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<dl class="list_userbar"><dd class="name"><a href="'), user_url("o_custkey"), F.lit('">n</a></dd></dl>')))
    item = F.concat(F.lit('<li class="clearfix"><div class="list_con"><div class="title"><h2><a href="'),
                    article_url("o_custkey", k), F.lit('">t</a></h2></div>'), user, F.lit("</div></li>"))
    return _grouped(orders, "o_orderkey", item, '<html><body><ul class="feedlist_mod home">', "</ul></body></html>")


def followee_pages(orders: DataFrame) -> DataFrame:
    """Follow list items; key % 9 = 0 has no link."""
    k = F.col("o_orderkey")
    item = F.when(k % 9 == 0, F.lit("<li><span>gone</span></li>")).otherwise(
        F.concat(F.lit('<li><a href="'), F.lit(ME + "/u"), s("o_custkey"), F.lit('">x</a></li>')))
    return _grouped(orders, "o_orderkey", item, '<html><body><div class="chanel_det_list"><ul>',
                    "</ul></div></body></html>")


def article_list_pages(orders: DataFrame) -> DataFrame:
    """Article list boxes; key % 9 = 0 has no ``h4`` link."""
    k = F.col("o_orderkey")
    link = F.when(k % 9 == 0, F.lit("<h5>no link</h5>")).otherwise(
        F.concat(F.lit('<h4><a href="'), article_url("o_custkey", k), F.lit('">t</a></h4>')))
    item = F.concat(F.lit('<div class="article-item-box tracked">'), link, F.lit("</div>"))
    return _grouped(orders, "o_orderkey", item, '<html><body><div class="article-list">', "</div></body></html>")


def table_pages(supplier: DataFrame) -> DataFrame:
    """HTML tables of suppliers: cells (key, name, nation, balance, x,
    protocol); protocol is ``https`` when key % 3 = 0."""
    k = F.col("s_suppkey")
    proto = F.when(k % 3 == 0, F.lit("https")).otherwise(F.lit("http"))
    cells = [s(k), esc("s_name"), s("s_nationkey"), s(F.floor(F.col("s_acctbal")).cast("bigint")), F.lit("x"), proto]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    head = "<html><body><table><tr><th>k</th><th>ip</th><th>port</th><th>b</th><th>x</th><th>type</th></tr>"
    return _grouped(supplier, "s_suppkey", row, head, "</table></body></html>")


def json_feed_pages(orders: DataFrame) -> DataFrame:
    """JSON feeds ``{"articles": [{"user_url", "url"}, ...]}``, 20 per page."""
    g = F.floor(F.col("o_orderkey") / ITEMS_PER_PAGE).cast("bigint")
    it = F.struct(F.col("o_orderkey").alias("k"), user_url("o_custkey").alias("user_url"),
                  article_url("o_custkey", "o_orderkey").alias("url"))
    return (orders.select(g.alias("page_id"), it.alias("it")).groupBy("page_id")
                  .agg(F.array_sort(F.collect_list("it")).alias("its"))
                  .select("page_id", F.to_json(F.struct(
                      F.transform("its", lambda x: F.struct(x["user_url"].alias("user_url"), x["url"].alias("url")))
                      .alias("articles"))).alias("body")))
