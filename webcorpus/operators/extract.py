"""Page extraction: ``extract(pages, rule)`` -> rows with a reject reason.

A rule turns one parsed page into 0..n records.  The tree walk runs in
Python inside ``mapInPandas`` (Arrow batches, one parse per page, no
shuffle); everything after it -- lenient numbers, first characters, page
counts, joins, URL rewriting -- is done by native expressions in the
``finish_*`` functions, so it stays in whole-stage codegen.

Every output row carries ``reject_reason``: null for a good record, else
why the page (``pos`` null) or one item (``pos`` set) was rejected.
Records never vanish silently.

Put cheap filters (first-seen, challenge pages) *before* ``extract``:
Catalyst cannot push predicates through ``mapInPandas``.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from typing import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import htmltree as H
from ..functions import numbers as N
from ..functions import text as TX
from ..functions import urls as U
from . import flat as FL
from .parallel import partitioned


class Reject(Exception):
    """A required node is missing: the record (or item) is rejected."""


def need(x, what: str):
    if x is None:
        raise Reject(f"missing {what}")
    return x


@dataclass(frozen=True)
class Rule:
    name: str
    fields: T.StructType
    parse: Callable[[str, H.Node, str], Iterable[dict]]
    # An element the rule cannot do without: a page with no such start tag
    # is not parsed at all -- it yields nothing, or the page-level reject
    # ``missing_reason``.  Exact: tag names cannot be entity-encoded.
    required_tag: str | None = None
    missing_reason: str | None = None


def _tag_probe(tag):
    # a start tag as html.parser reads it: '<' + name + a name terminator
    return re.compile(r"<%s[\t\n\r\f />\x00]" % re.escape(tag), re.I).search if tag else None


def output_schema(rule: Rule) -> T.StructType:
    return T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
         T.StructField("pos", T.IntegerType())]
        + list(rule.fields.fields)
        + [T.StructField("reject_reason", T.StringType())])


def _reader(rule: Rule):
    """A function of a page's URL and HTML that gives its rows: position, record, reason of a reject."""
    parse = rule.parse
    probe, missing = _tag_probe(rule.required_tag), rule.missing_reason

    def read(url, html):
        if probe is not None and (html is None or probe(html) is None):
            if missing:
                yield None, None, missing
            return
        try:
            root = H.parse(html)
            for pos, rec in enumerate(parse(url, root, html or "")):
                yield rec.pop("_pos", pos), rec, rec.pop("_reject", None)
        except Reject as e:
            yield None, None, str(e)
        except Exception as e:  # a broken page must not fail the job
            yield None, None, f"error {type(e).__name__}: {e}"
    return read


class TreeRows:
    """A rule by the tree walk: the rows of pages, or those of the pages left to it as a column."""

    def __init__(self, rule: Rule, **kw):
        self.rule, self.kw = rule, kw
        self.kind = T.StructType([*rule.fields.fields, T.StructField("reject_reason", T.StringType())])

    def __call__(self, pages: DataFrame) -> DataFrame:
        return extract(pages, self.rule, repartition=False, **self.kw)

    def rows(self, left: Column, url: Column, html: Column) -> Column:
        """Text of the rows of each page that is ``left``, null for the others."""
        read = _reader(self.rule)

        @F.pandas_udf(T.StringType())
        def tree(left: pd.Series, url: pd.Series, html: pd.Series) -> pd.Series:
            out = [None] * len(left)
            for i in left.to_numpy().nonzero()[0]:
                out[i] = json.dumps([{"pos": pos, "row": {**(rec or {}), "reject_reason": reason}} for pos, rec, reason in read(url[i], html[i])])
            return pd.Series(out, dtype=object)
        return tree(left, url, html)

    def read(self, text) -> Column:
        """The rows that :meth:`rows` wrote."""
        row = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("row", self.kind)])
        return F.from_json(text, T.ArrayType(row), {"maxStringLen": str(2 ** 31 - 1)})


def extract(pages: DataFrame, rule: Rule, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", repartition: bool = True) -> DataFrame:
    """Run ``rule`` over every page; one Arrow batch in, one batch out.
    ``repartition=False`` when the caller has already dealt the rows out
    (see ``parallel.partitioned``)."""
    schema = output_schema(rule)
    names = [f.name for f in rule.fields.fields]
    cols = ["page_id", "url", "pos"] + names + ["reject_reason"]
    read = _reader(rule)

    def run(batches):
        for pdf in batches:
            out = {c: [] for c in cols}

            def emit(pid, url, pos, rec, reason):
                out["page_id"].append(pid)
                out["url"].append(url)
                out["pos"].append(pos)
                for n in names:
                    out[n].append(rec.get(n) if rec else None)
                out["reject_reason"].append(reason)

            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                pid = None if pd.isna(pid) else int(pid)
                for pos, rec, reason in read(url, html):
                    emit(pid, url, pos, rec, reason)
            if not out["page_id"]:
                continue  # a zero-row frame cannot be converted for struct schemas
            frame = pd.DataFrame(out, columns=cols)
            frame["pos"] = frame["pos"].astype("Int32")
            yield frame

    src = pages.select(F.col(id_col).cast("long").alias("page_id"),
                       F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return (partitioned(src, "page_id") if repartition else src).mapInPandas(run, schema)


def extract_record(pages: DataFrame, rule: Rule, native: Callable[[DataFrame], DataFrame], id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", repartition: bool = True) -> DataFrame:
    """Rows of a rule that makes one record of a page: regular pages natively, the others by the tree.

    ``native``: adds ``_rec`` to the pages, the struct of the rule's fields and
    ``reject_reason``, or null where only the tree can tell.  One scan and one
    judgement of each page; a page that the native part answers reaches the tree's
    function as a null."""
    names = [f.name for f in rule.fields.fields]
    full = T.StructType([*rule.fields.fields, T.StructField("reject_reason", T.StringType())])
    parse = rule.parse

    @F.pandas_udf(T.StringType())
    def tree(left: pd.Series, url: pd.Series, html: pd.Series) -> pd.Series:
        out = [None] * len(left)
        for i in left.to_numpy().nonzero()[0]:
            rec, reason = {}, None
            try:
                rec = next(iter(parse(url[i], H.parse(html[i]), html[i] or "")))
            except Reject as e:
                reason = str(e)
            except Exception as e:  # a broken page must not fail the job
                reason = f"error {type(e).__name__}: {e}"
            out[i] = json.dumps({**rec, "reject_reason": reason})
        return pd.Series(out, dtype=object)

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    src = partitioned(src, "page_id") if repartition else src
    src = native(src)
    left = F.col("_rec").isNull()
    src = FL._once(src, "_tree", tree(left, F.when(left, F.col("url")), F.when(left, F.col("html"))))
    rec = F.coalesce(F.col("_rec"), F.from_json("_tree", full))
    return src.select("page_id", "url", rec.alias("r")).select(
        "page_id", "url", F.when(F.col("r.reject_reason").isNull(), F.lit(0)).alias("pos"), *[F.col(f"r.{n}").alias(n) for n in names], "r.reject_reason")


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records without the reason column, reject rows).  Both come
    from the same extraction: persist ``df`` first when writing both, or
    the pages are parsed twice (``plans.crawl`` does)."""
    ok = df.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = df.where(F.col("reject_reason").isNotNull())
    return ok, bad


# ---------------------------------------------------------------------------
# The site layout the selectors name (ids, classes) and the
# page-script patterns, which must equal the original's.  Match kinds:
# "has" = substring of the class attribute (XPath contains), "starts" =
# prefix, "is" = whole attribute equal.
NAV_ID = "nav"                              # //nav[@id='nav']//ul/li
FEED_LIST_CLASS_STARTS = "feedlist_mod"     # //*[starts-with(@class,'feedlist_mod')]/li
FEED_ITEM_CLASS_IS = "clearfix"             #   li[@class='clearfix']
FEED_BODY_CLASS_HAS = "list_con"            #   div[contains(@class,'list_con')]
FEED_TITLE_CLASS_IS = "title"               #   div[@class='title']/h2/a/@href
FEED_USERBAR_CLASS_IS = "list_userbar"      #   dl[@class='list_userbar']/dd[@class='name']/a/@href
FEED_NAME_CLASS_IS = "name"
PROFILE_ID = "asideProfile"                 # //*[@id='asideProfile']
PROFILE_INTRO_CLASS_HAS = "profile-intro"   #   div[contains(@class,'profile-intro')]
PROFILE_USER_CLASS_HAS = "user-info"        #     /div[contains(@class,'user-info')]//span/a/text()
PROFILE_DATA_CLASS_HAS = "data-info"        #   div[contains(@class,'data-info')]/dl[n]/@title
PROFILE_GRADE_CLASS_HAS = "grade-box"       #   div[contains(@class,'grade-box')]
PROFILE_BADGES_CLASS_HAS = "badge-box"      #   .//div[contains(@class,'badge-box')]/div[2]
BADGE_CLASS_IS = "icon-badge"               #     /div[@class='icon-badge']/@title
PAGE_SCRIPT_POSITION = 6                    # /html/body/script[6]/text()
LIST_TOTAL_PATTERN = r"(?<=listTotal).*?(\d+) *;"
PAGE_SIZE_PATTERN = r"(?<=pageSize).*?(\d+) *;"
FOLLOW_LIST_CLASS_HAS = "chanel_det_list"   # //*[contains(@class,'chanel_det_list')]/ul/li/a/@href
ARTICLE_LIST_CLASS_IS = "article-list"      # //*[@class='article-list']
ARTICLE_BOX_CLASS_HAS = "article-item-box"  #   /div[contains(@class,'article-item-box')]/h4/a/@href
MAIN_BOX_ID = "mainBox"                     # //*[@id='mainBox']/main/div[1]
ARTICLE_TYPE_CLASS_HAS = "article-type"     #   .../span[contains(@class,'article-type')]/text()
TIME_CLASS_IS = "time"                      #   .../span[@class='time']/text()
READ_COUNT_CLASS_IS = "read-count"          #   .../span[@class='read-count']/text()
CONTENT_ID = "content_views"                #   article/div[1]/div[@id='content_views']
TOOL_BOX_CLASS_STARTS = "tool-box"          # //*[starts-with(@class,'tool-box')]/ul

_ENDING = r"(?i)<(?:" + "|".join(sorted(H.IMPLIED_END)) + r")\b"


def _cls(n):
    return n.get("class") or ""


# ---------------------------------------------------------------------------
# Rules.  Paths follow the site's selectors: ``contains(@class, x)`` is a
# substring test, ``starts-with`` a prefix test, ``@class='x'`` exact;
# ``text()`` is the first direct text node.

def _item_reject(pos, e):
    return {"_pos": pos, "_reject": str(e)}


def _nav_rule(nav_id):
    def parse(url, root, html):
        navs = H.find_all(root, "nav", (lambda n: n.get("id") == nav_id) if nav_id else None)
        seen, items = set(), []
        for nav in navs:
            for ul in H.find_all(nav, "ul"):
                for li in ul.elements("li"):
                    if id(li) not in seen:
                        seen.add(id(li))
                        items.append(li)
        items.sort(key=lambda n: n.start)
        for i, li in enumerate(items):
            if i == 0:
                continue  # the first entry is not a category
            try:
                a = need(H.child(li, "a"), "a")
                href = need(a.get("href"), "href")
            except Reject as e:
                yield _item_reject(i, e)
                continue
            if U.SKIP_HREF_WORD in href:
                continue
            yield {"_pos": i, "label": a.text, "href": href}
    return parse


NAV_FIELDS = T.StructType([T.StructField("label", T.StringType()), T.StructField("href", T.StringType())])


def nav_links(pages: DataFrame, nav_id: str | None = NAV_ID, **kw) -> DataFrame:
    """Category links of ``//nav[@id=nav_id]//ul/li`` (first skipped,
    ``watchers`` dropped); ``target`` resolved against the page URL unless
    the href names one of the unresolved sections.  ``nav_id=None`` takes
    every ``nav``."""
    rule = Rule("nav", NAV_FIELDS, _nav_rule(nav_id), required_tag="nav")
    own = rf'\s+id="{re.escape(nav_id)}"' if nav_id else FL.ATTRS
    form = FL.Flat(rf'<li{FL.ATTRS}>\s*+<a\s+href="([^"<>]*+)"\s*+>([^<]*+)</a>\s*+</li>\s*+',
                   rf"<nav{own}>\s*+<ul{FL.ATTRS}>\s*+{FL.MARK}*+</ul>\s*+</nav>", "(?i)<nav", groups=2)
    df = FL.extract(pages, form, 2, 1, lambda g: {"label": F.when(g["g2"] != "", FL.unescape(g["g2"])), "href": FL.unescape(g["g1"])},
                    TreeRows(rule, **kw))
    df = df.where(F.col("reject_reason").isNotNull() | ~F.col("href").contains(U.SKIP_HREF_WORD))
    return df.withColumn("target", F.when(F.col("reject_reason").isNull(),
                                          U.nav_target(F.col("url"), F.col("href"))))


def _feed_parse(url, root, html):
    lists = H.find_all(root, None, lambda n: _cls(n).startswith(FEED_LIST_CLASS_STARTS))
    items = [li for ul in lists for li in ul.elements("li") if li.get("class") == FEED_ITEM_CLASS_IS]
    for i, li in enumerate(items):
        try:
            div = need(H.child(li, "div", 1, lambda n: n.has_class(FEED_BODY_CLASS_HAS)), "list_con")
            art = need(H.first_attr(H.select(div, ("div", None, lambda n: n.get("class") == FEED_TITLE_CLASS_IS),
                                             "h2", "a"), "href"), "title link")
            usr = need(H.first_attr(H.select(div, ("dl", None, lambda n: n.get("class") == FEED_USERBAR_CLASS_IS),
                                             ("dd", None, lambda n: n.get("class") == FEED_NAME_CLASS_IS), "a"),
                                    "href"), "user link")
        except Reject as e:
            yield _item_reject(i, e)
            continue
        yield {"_pos": i, "article_href": art, "user_href": usr}


FEED_FIELDS = T.StructType([T.StructField("article_href", T.StringType()),
                            T.StructField("user_href", T.StringType())])


def feed_links(pages: DataFrame, **kw) -> DataFrame:
    """(article, author) link pair of every feed item; a malformed item
    is rejected alone."""
    link = rf'<a\s+href="({FL.VALUE}++)"\s*+>[^<]*+</a>\s*+'
    form = FL.Flat(rf'<li\s+class="{FEED_ITEM_CLASS_IS}"\s*+>\s*+<div\s+class="[^"<>]*{FEED_BODY_CLASS_HAS}[^"<>]*"\s*+>\s*+'
                   rf'<div\s+class="{FEED_TITLE_CLASS_IS}"\s*+>\s*+<h2\s*+>\s*+{link}</h2>\s*+</div>\s*+'
                   rf'(?:<dl\s+class="{FEED_USERBAR_CLASS_IS}"\s*+>\s*+<dd\s+class="{FEED_NAME_CLASS_IS}"\s*+>\s*+{link}</dd>\s*+</dl>\s*+)?'
                   rf'</div>\s*+</li>\s*+',
                   rf'<ul\s+class="{FEED_LIST_CLASS_STARTS}[^"<>]*+"\s*+>\s*+{FL.MARK}*+</ul>', FEED_LIST_CLASS_STARTS, groups=2, alone=True)
    return FL.extract(pages, form, 2, 0, lambda g: {"article_href": FL.unescape(g["g1"]), "user_href": FL.unescape(g["g2"])},
                      TreeRows(Rule("feed", FEED_FIELDS, _feed_parse), **kw),
                      lambda g: F.when(g["g2"] == "", F.lit("missing user link")))


def _profile_parse(url, root, html):
    profile = need(H.find(root, None, lambda n: n.get("id") == PROFILE_ID), "asideProfile")
    infos = H.select(profile, ("div", None, lambda n: n.has_class(PROFILE_INTRO_CLASS_HAS)),
                     ("div", None, lambda n: n.has_class(PROFILE_USER_CLASS_HAS)))
    spans = [sp for info in infos for sp in H.find_all(info, "span")]
    name = need(H.first_text_in([a for sp in spans for a in sp.elements("a")]), "name")
    data = need(H.child(profile, "div", 1, lambda n: n.has_class(PROFILE_DATA_CLASS_HAS)), "data-info")
    dls = data.elements("dl")

    def dl_title(i, what):
        return need(need(H.nth(dls, i), what).attrs.get("title"), what)

    rec = {"name_raw": name, "creates": dl_title(1, "creates"), "fans": dl_title(2, "fans"),
           "praises": dl_title(3, "praises"), "comments": dl_title(4, "comments"),
           "visits": dl_title(-1, "visits")}
    grade = need(H.child(profile, "div", 1, lambda n: n.has_class(PROFILE_GRADE_CLASS_HAS)), "grade-box")
    gdls = grade.elements("dl")
    g = None
    for dd in need(H.nth(gdls, 1), "grade").elements("dd"):
        for a in dd.elements("a"):
            if "title" in a.attrs:
                g = a.attrs["title"]
                break
        if g is not None:
            break
    rec["grade_title"] = need(g, "grade")
    c = None
    for dd in need(H.nth(gdls, 3), "credits").elements("dd"):
        if "title" in dd.attrs:
            c = dd.attrs["title"]
            break
    rec["credits_raw"] = need(c, "credits")
    rec["ranks_raw"] = need(need(H.nth(gdls, -1), "ranks").attrs.get("title"), "ranks")
    titles = []
    for box in H.find_all(profile, "div", lambda n: n.has_class(PROFILE_BADGES_CLASS_HAS)):
        second = H.child(box, "div", 2)
        if second is not None:
            titles += [b.attrs.get("title") for b in second.elements("div") if b.get("class") == BADGE_CLASS_IS]
    rec["badge_titles"] = titles
    body = H.path(root, "html", "body") or H.find(root, "body")
    script = H.child(body, "script", PAGE_SCRIPT_POSITION)
    rec["page_script"] = need(H.first_text(script), "page script")
    yield rec


def _required(values: dict[str, Column]) -> Column:
    """``missing <name>`` of the first value that is null, in the order given; null if none is."""
    return F.coalesce(*[F.when(value.isNull(), F.lit(f"missing {name}")) for name, value in values.items()])


def _whole_profile() -> str:
    """Pattern of the body of a regular profile page: name, counts, grades, badges and the sixth script are groups."""
    leaf = rf"(?:{FL.tag('d[dt]')}[^<]*+(?:{FL.tag('a')}[^<]*+</a\s*+>)?+[^<]*+</d[dt]\s*+>{FL.TEXT})*+"
    dls = rf"((?:{FL.element('dl', leaf)})++)"
    name = rf"{FL.tag('span')}{FL.TEXT}{FL.tag('a')}([^<\x02]++)</a\s*+>{FL.TEXT}</span\s*+>{FL.TEXT}"
    user = FL.element("div", rf"(?:{FL.tag('div')}{FL.TEXT}{name}</div\s*+>{FL.TEXT})", "class", PROFILE_USER_CLASS_HAS, "has")
    badge = rf"((?:{FL.tag('div')}[^<]*+</div\s*+>{FL.TEXT})*+)"
    parts = (FL.element("div", user, "class", PROFILE_INTRO_CLASS_HAS, "has") + FL.element("div", dls, "class", PROFILE_DATA_CLASS_HAS, "has")
             + FL.element("div", dls, "class", PROFILE_GRADE_CLASS_HAS, "has")
             + FL.element("div", FL.element("div", "") + FL.element("div", badge), "class", PROFILE_BADGES_CLASS_HAS, "has"))
    return rf"{FL.tag('body')}{FL.TEXT}{FL.tag('aside')}{FL.TEXT}{FL.element('div', parts, 'id', PROFILE_ID)}</aside\s*+>([^<]*+)</body"


def _profile_page() -> str:
    """Pattern of a whole page that is one profile and its scripts: name, the five counts, grade, credits, ranks, badges and the
    sixth script are groups."""
    no_badges, end, t = PROFILE_BADGES_CLASS_HAS + "|&", rf"</div\s*+>{FL.TEXT}", FL.TEXT
    d = FL.tag("div").replace(r"\b", rf"\b(?![^<>]*(?:{no_badges}))", 1) + t
    held = rf"{t}(?:{FL.tag('a')}{t}</a\s*+>)?+{t}"
    dt, dd = rf"{FL.tag('dt')}{held}</dt\s*+>{t}", rf"{FL.tag('dd')}{held}</dd\s*+>{t}"
    leaf = rf"(?:{dt}|{dd})*+"

    def dl(body, start=FL.tag("dl")):
        return rf"{start}{t}{body}{leaf}</dl\s*+>{t}"

    titled = dl("", FL.holding("dl", "title"))
    last = rf"(?:{dl('')}(?=<dl\b))*+{titled}"
    name = rf"{FL.tag('span')}{t}{FL.tag('a')}([^<\x00-\x02]++)</a\s*+>{t}</span\s*+>{t}"
    intro = (FL.sole("div", "class", PROFILE_INTRO_CLASS_HAS, "has", rf"{PROFILE_DATA_CLASS_HAS}|{PROFILE_GRADE_CLASS_HAS}|{no_badges}") + t
             + FL.sole("div", "class", PROFILE_USER_CLASS_HAS, "has", no_badges) + t + d + name + end * 3)
    data = FL.sole("div", "class", PROFILE_DATA_CLASS_HAS, "has", rf"{PROFILE_GRADE_CLASS_HAS}|{no_badges}") + t + titled * 4 + last + end
    grade = dl(rf"(?:{dt})*+{FL.tag('dd')}{t}{FL.holding('a', 'title')}{t}</a\s*+>{t}</dd\s*+>{t}")
    credits = dl(rf"(?:{dt})*+{FL.holding('dd', 'title')}{held}</dd\s*+>{t}")
    grades = FL.sole("div", "class", PROFILE_GRADE_CLASS_HAS, "has", no_badges) + t + grade + dl("") + credits + last + end
    badges = FL.sole("div", "class", PROFILE_BADGES_CLASS_HAS, "has") + t + d + end + d + rf"((?:{d}{end})*+)" + end * 2
    script = r"<script\s*+>[^<\x00-\x02]*+</script\s*+>\s*+"
    scripts = rf"(?:{script}){{{PAGE_SCRIPT_POSITION - 1}}}<script\s*+>([^<\x00-\x02]*+)</script\s*+>\s*+(?:{script})*+"
    return FL.page_of(rf"<aside\b(?![^<>]*(?i:\sid=)){FL.ATTRS}>{t}" + FL.sole("div", "id", PROFILE_ID) + t + intro + data + grades + badges + end
                      + r"</aside\s*+>\s*+" + scripts)


def _profile_native(pages: DataFrame) -> DataFrame:
    seen, hit, whole = F.col("_seen"), F.col("_hit"), _whole_profile()
    read = F.col("_read")
    pages = FL.read_whole(pages, "_read", _profile_page(), 11)
    # a page without a trace of the id, whatever else is in it
    html = F.col("html")
    bare = ~html.contains("&") & ~html.contains("<!") & ~html.contains("<?") & ~html.rlike(PROFILE_ID + r"(?!\w)")
    pages = FL._once(pages, "_none", F.when(read.isNull(), bare))
    odd = ~F.coalesce(F.col("_none"), read.isNotNull())
    # the scripts of a regular page stand behind the profile, one beside the other
    scripts = r"(?s)</aside\s*+>((?:\s*+<script\s*+>[^<]*+</script\s*+>)*+)\s*+</body"
    pages = FL._once(pages, "_seen", F.when(odd, FL.plain()))
    words = (PROFILE_ID, PROFILE_INTRO_CLASS_HAS, PROFILE_USER_CLASS_HAS, PROFILE_DATA_CLASS_HAS, PROFILE_GRADE_CLASS_HAS, PROFILE_BADGES_CLASS_HAS, "<html", "<body", "</body")
    single = F.lit(True)
    for word in words:
        single = single & FL.once(seen, word)
    regular = single & ~seen.rlike(FL._ENTITY) & seen.startswith("<html") & ~seen.rlike(r"<(?:(?i:base|frameset|p|li|option)\b|[A-Z])") & F.col("html").rlike(scripts)
    pages = FL._once(pages, "_hit", F.when(regular, F.regexp_extract(seen, whole, 0)))
    pages = FL._once(pages, "_cell", F.when(hit != "", FL.groups(hit, whole, 4)))
    cut = {n: F.get("_cell", i) for i, n in enumerate(("name", "data", "grades", "badges"))}
    pages = FL._once(pages, "_part", F.when(F.col("_cell").isNotNull(), F.struct(
        cut["name"].alias("name"), F.regexp_extract_all(cut["data"], F.lit("<dl[^<>]*+>"), F.lit(0)).alias("data"),
        F.regexp_extract_all(cut["grades"], F.lit(r"(?s)<dl[^<>]*+>.*?</dl"), F.lit(0)).alias("grades"),
        F.filter(F.regexp_extract_all(cut["badges"], F.lit("<div[^<>]*+>"), F.lit(0)), lambda t: FL.attr(t, "class").eqNullSafe(BADGE_CLASS_IS)).alias("badges"),
        F.regexp_extract_all(F.regexp_extract("html", scripts, 1), F.lit(r"<script\s*+>([^<]*+)</script"), F.lit(1)).alias("scripts"))))
    data, grades = F.col("_part.data"), F.col("_part.grades")

    def own(dls, i):  # the start tag of the i-th list, the last for -1
        return F.regexp_extract(F.get(dls, i - 1) if i > 0 else F.try_element_at(dls, F.lit(-1)), "^<dl[^<>]*+>", 0)

    def inner(dls, i, pattern):  # the first title among the tags of the i-th list that match
        return F.get(F.filter(F.transform(F.regexp_extract_all(F.get(dls, i - 1), F.lit(pattern), F.lit(1)), lambda t: FL.attr(t, "title")), lambda v: v.isNotNull()), 0)

    script = F.get(F.col("_part.scripts"), PAGE_SCRIPT_POSITION - 1)
    values = {"name_raw": FL.unescape(F.col("_part.name")), **{n: FL.attr(own(data, i), "title") for n, i in (("creates", 1), ("fans", 2), ("praises", 3), ("comments", 4), ("visits", -1))},
              "grade_title": inner(grades, 1, r"<dd\b[^<>]*+>[^<]*+(<a[^<>]*+>)"), "credits_raw": inner(grades, 3, r"(<dd[^<>]*+>)"), "ranks_raw": FL.attr(own(grades, -1), "title"),
              "badge_titles": F.transform(F.col("_part.badges"), lambda t: FL.attr(t, "title")), "page_script": F.when(script != "", script)}
    known = ("name_raw", "creates", "fans", "praises", "comments", "visits", "grade_title", "credits_raw", "ranks_raw")  # the page's first groups
    by_page = {n: FL.unescape(F.get(read, known.index(n) + 1)) for n in known}
    by_page["badge_titles"] = F.transform(F.filter(F.regexp_extract_all(F.get(read, 10), F.lit("<div[^<>]*+>"), F.lit(0)),
                                                   lambda t: FL.attr(t, "class").eqNullSafe(BADGE_CLASS_IS)), lambda t: FL.attr(t, "title"))
    by_page["page_script"] = F.nullif(F.get(read, 11), F.lit(""))
    entity = F.array_join(read, " ")
    pages = FL._once(pages, "_value", F.when(read.isNotNull(), F.when(~(entity.contains("&") & entity.rlike(FL._ENTITY)), F.struct(*[by_page[n].alias(n) for n in values])))
                     .when(F.col("_part").isNotNull(), F.struct(*[v.alias(n) for n, v in values.items()])))
    x = F.col("_value")
    why = _required({**{n: x[n] for n in ("creates", "fans", "praises", "comments", "visits")}, "grade": x["grade_title"], "credits": x["credits_raw"],
                     "ranks": x["ranks_raw"], "page script": x["page_script"]})
    record = F.struct(*[F.when(why.isNull(), x[n]).alias(n) for n in PROFILE_FIELDS.names], why.alias("reject_reason"))
    # nothing in the page can have the profile's id
    none = ~seen.rlike(FL._ENTITY) & ~seen.rlike("[\"'=]" + PROFILE_ID + "[\"'\\s/>]")
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in PROFILE_FIELDS], F.lit(f"missing {PROFILE_ID}").alias("reject_reason"))
    return FL._once(pages, "_rec", F.when(x.isNotNull(), record).when(F.col("_none") | none, nothing)).drop("_read", "_none", "_seen", "_hit", "_cell", "_part", "_value")


PROFILE_FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in (
    "name_raw", "creates", "fans", "praises", "comments", "visits", "grade_title",
    "credits_raw", "ranks_raw")]
    + [T.StructField("badge_titles", T.ArrayType(T.StringType())),
       T.StructField("page_script", T.StringType())])

USER_COLUMNS = ["name", "creates", "fans", "praises", "comments", "visits", "grade",
                "credits", "ranks", "badges", "url"]


def user_profile(pages: DataFrame, **kw) -> DataFrame:
    """X3 + X4: the author record plus its article page count.  A missing
    node, an empty grade, a badge without title or a page size of 0
    rejects the whole record."""
    raw = extract_record(pages, Rule("profile", PROFILE_FIELDS, _profile_parse), _profile_native, **kw)
    return finish_profile(raw)


def finish_profile(raw: DataFrame) -> DataFrame:
    # (?U): \d is Unicode-aware as in Python 3; int() then reads those digits too
    pat_total, pat_size = "(?dU)" + LIST_TOTAL_PATTERN, "(?dU)" + PAGE_SIZE_PATTERN
    total = N.lenient_int(F.regexp_extract("page_script", pat_total, 1), None)
    size = N.lenient_int(F.regexp_extract("page_script", pat_size, 1), None)
    has_total = F.col("page_script").rlike(pat_total)
    has_size = F.col("page_script").rlike(pat_size)
    df = raw.select(
        "page_id", "url", "reject_reason",
        TX.trim_chars("name_raw").alias("name"), "creates", "fans", "praises", "comments",
        "visits", TX.first_char("grade_title").alias("grade"),
        N.lenient_int("credits_raw").alias("credits"), N.lenient_int("ranks_raw").alias("ranks"),
        TX.join_titles("badge_titles").alias("badges"),
        F.when(has_total, total).alias("list_total"),
        F.when(has_size, size).alias("page_size"))
    df = df.withColumn("page_count", N.ceil_div("list_total", "page_size"))
    reason = (F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
              .when(F.col("grade").isNull(), F.lit("empty grade"))
              .when(F.col("badges").isNull(), F.lit("badge without title"))
              .when(F.col("list_total").isNull(), F.lit("missing listTotal"))
              .when(F.col("page_size").isNull(), F.lit("missing pageSize"))
              .when(F.col("page_count").isNull(), F.lit("page size 0")))
    keep = F.col("reason").isNull()
    out = df.withColumn("reason", reason)
    return out.select(
        "page_id", *[F.when(keep, F.col(c)).alias(c) if c != "url" else F.col("url") for c in USER_COLUMNS],
        F.when(keep, F.col("list_total")).alias("list_total"),
        F.when(keep, F.col("page_size")).alias("page_size"),
        F.when(keep, F.col("page_count")).alias("page_count"),
        F.col("reason").alias("reject_reason"))


def _followee_parse(url, root, html):
    boxes = H.find_all(root, None, lambda n: n.has_class(FOLLOW_LIST_CLASS_HAS))
    items = [li for b in boxes for ul in b.elements("ul") for li in ul.elements("li")]
    for i, li in enumerate(items):
        try:
            href = need(H.first_attr(H.select(li, "a"), "href"), "a")
        except Reject as e:
            yield _item_reject(i, e)
            continue
        yield {"_pos": i, "href": href}


HREF_FIELDS = T.StructType([T.StructField("href", T.StringType())])


def followee_links(pages: DataFrame, literal: bool = False, **kw) -> DataFrame:
    """Followed authors; ``user_url`` is the ``blog`` form of the
    ``me`` link (host label only; ``literal=True`` replaces every ``me``)."""
    form = FL.Flat(rf'<li\s*+>\s*+(?:<a\s+href="({FL.VALUE}++)"\s*+>[^<]*+</a>|<span\s*+>[^<]*+</span>)\s*+</li>\s*+',
                   rf'<div\s+class="[^"<>]*{FOLLOW_LIST_CLASS_HAS}[^"<>]*"\s*+>\s*+<ul\s*+>\s*+{FL.MARK}*+</ul>\s*+</div>', FOLLOW_LIST_CLASS_HAS, alone=True)
    df = FL.extract(pages, form, 1, 0, lambda g: {"href": FL.unescape(g["g1"])},
                    TreeRows(Rule("followees", HREF_FIELDS, _followee_parse), **kw),
                    lambda g: F.when(g["g1"] == "", F.lit("missing a")))
    user = (F.replace(F.col("href"), F.lit("me"), F.lit("blog")) if literal
            else F.regexp_replace("href", r"^([A-Za-z][A-Za-z0-9+.\-]*://)me\.", "$1blog."))
    return df.withColumn("user_url", user)


def _article_list_parse(url, root, html):
    boxes = H.find_all(root, None, lambda n: n.get("class") == ARTICLE_LIST_CLASS_IS)
    items = [d for b in boxes for d in b.elements("div") if d.has_class(ARTICLE_BOX_CLASS_HAS)]
    for i, box in enumerate(items):
        try:
            href = need(H.first_attr(H.select(box, "h4", "a"), "href"), "h4/a")
        except Reject as e:
            yield _item_reject(i, e)
            continue
        yield {"_pos": i, "href": href}


def article_list_links(pages: DataFrame, **kw) -> DataFrame:
    """Article links of a list page, in page order."""
    form = FL.Flat(rf'<div\s+class="[^"<>]*{ARTICLE_BOX_CLASS_HAS}[^"<>]*"\s*+>\s*+(?:<h4\s*+>\s*+<a\s+href="({FL.VALUE}++)"\s*+>[^<]*+</a>\s*+</h4>'
                   rf'|<h5\s*+>[^<]*+</h5>)\s*+</div>\s*+',
                   rf'<div\s+class="{ARTICLE_LIST_CLASS_IS}"\s*+>\s*+{FL.MARK}*+</div>', ARTICLE_LIST_CLASS_IS, alone=True)
    return FL.extract(pages, form, 1, 0, lambda g: {"href": FL.unescape(g["g1"])},
                      TreeRows(Rule("article_list", HREF_FIELDS, _article_list_parse), **kw),
                      lambda g: F.when(g["g1"] == "", F.lit("missing h4/a")))


def _article_parse(url, root, html):
    mains = [m for mb in H.find_all(root, None, lambda n: n.get("id") == MAIN_BOX_ID) for m in mb.elements("main")]
    box = need(H.first([d for m in mains for d in H.select(m, ("div", 1))]), "main box")
    header = need(H.first(H.select(box, ("div", 1))), "header")
    title_box = need(H.first(H.select(header, ("div", 1), ("div", 1))), "title box")
    nature = need(H.first_text_in(H.select(title_box, ("span", None, lambda n: n.has_class(ARTICLE_TYPE_CLASS_HAS)))),
                  "article type")
    title = need(H.first_text_in(H.select(title_box, "h1")), "h1")
    info = need(H.first(H.select(header, ("div", 1), ("div", 2))), "info box")
    line = H.select(info, ("div", 1))
    ctime = need(H.first_text_in([sp for ln in line for sp in H.select(ln, ("span", None, lambda n: n.get("class") == TIME_CLASS_IS))]), "time")
    rc = need(H.first_text_in([sp for ln in line
                               for sp in H.select(ln, ("span", None, lambda n: n.get("class") == READ_COUNT_CLASS_IS))]),
              "read count")
    uname = need(H.first_text_in([a for ln in line for a in H.select(ln, "a")]), "user name")
    body = need(H.first(H.select(box, "article", ("div", 1), ("div", None, lambda n: n.get("id") == CONTENT_ID))),
                "content_views")
    menus = [ul for tb in H.find_all(root, None, lambda n: _cls(n).startswith(TOOL_BOX_CLASS_STARTS))
             for ul in tb.elements("ul")]
    menu = need(H.first(menus), "tool-box")
    praises = need(H.first(H.select(menu, ("li", 1), "button", "p")), "praises")
    comments = need(H.first(H.select(menu, ("li", 3), "a", "p")), "comments")
    yield {"title": title, "create_time": ctime, "read_count_text": rc, "nature": nature,
           "content": body.markup(html), "praises": praises.text, "comments_raw": need(comments.text, "comments text"),
           "user_name": uname}


def _whole_article() -> str:
    """Pattern of a regular article from its main box to the end of the body node: type, title, info line and body node are groups."""
    d = FL.tag("div") + FL.TEXT
    line = rf"((?:{FL.tag('span')}[^<\x02]*+</span\s*+>{FL.TEXT}|{FL.tag('a')}[^<\x02]*+</a\s*+>{FL.TEXT})*+)"
    end = rf"</div\s*+>{FL.TEXT}"
    kind = rf"{FL.tag('span', 'class', ARTICLE_TYPE_CLASS_HAS, 'has')}([^<\x02]++)</span\s*+>{FL.TEXT}"
    title = rf"(?:{FL.tag('h1')}([^<\x02]++)</h1\s*+>{FL.TEXT})?+"
    body = rf"({FL.tag('div', 'id', CONTENT_ID)}[^<\x02]*+(?:<(?!/?div\b)[^<\x02]*+)*+</div\s*+>)"
    return (FL.tag("div", "id", MAIN_BOX_ID) + FL.TEXT + FL.tag("main") + FL.TEXT + d * 4 + kind + title + end + d * 2 + line + end * 4
            + FL.tag("article") + FL.TEXT + d + body)


def _menu() -> str:
    """Pattern of a regular tool box up to its third entry: praises and comments are groups."""
    p = rf"{FL.tag('p')}([^<\x02]*+)</p\s*+>{FL.TEXT}"
    return (FL.tag("[a-z]++", "class", TOOL_BOX_CLASS_STARTS, "starts") + FL.TEXT + FL.tag("ul") + FL.TEXT + FL.element("li", FL.element("button", p))
            + FL.element("li", "") + FL.tag("li") + FL.TEXT + FL.tag("a") + FL.TEXT + p)


def _article_page() -> str:
    """Pattern of a whole page that is one article and its tool box: type, title, time, read count, user name, body node, praises
    and comments are groups."""
    d, end = FL.tag("div") + FL.TEXT, rf"</div\s*+>{FL.TEXT}"
    some = r"([^<\x00-\x02]++)"
    kind = rf"{FL.sole('span', 'class', ARTICLE_TYPE_CLASS_HAS, 'has')}{some}</span\s*+>{FL.TEXT}"
    title = rf"(?:{FL.tag('h1')}{some}</h1\s*+>{FL.TEXT})?+"
    line = "".join(rf"{start}{some}</{name}\s*+>{FL.TEXT}" for start, name in (
        (FL.sole("span", "class", TIME_CLASS_IS), "span"), (FL.sole("span", "class", READ_COUNT_CLASS_IS), "span"), (FL.tag("a"), "a")))
    # tags that end nothing outside the body node and are no second tool box
    inner = (rf"<(?:/?+(?:p|a|b|i|u|s|em|strong|span|code|pre|br|hr|img|h[1-6]|blockquote|ul|ol|li)\b)(?![^<>]*(?:{TOOL_BOX_CLASS_STARTS}|&))"
             rf"{FL.ATTRS}/?+>{FL.TEXT}")
    body = rf"({FL.sole('div', 'id', CONTENT_ID, without=TOOL_BOX_CLASS_STARTS + '|&')}{FL.TEXT}(?:{inner})*+</div\s*+>)"
    p = rf"{FL.tag('p')}({FL.TEXT})</p\s*+>{FL.TEXT}"
    menu = (FL.sole("div", "class", TOOL_BOX_CLASS_STARTS, "starts") + FL.TEXT + FL.tag("ul") + FL.TEXT + FL.element("li", FL.element("button", p))
            + FL.element("li", "") + FL.element("li", FL.element("a", p)) + rf"(?:{FL.element('li', '')})*+</ul\s*+>{FL.TEXT}{end}")
    return FL.page_of(FL.sole("div", "id", MAIN_BOX_ID) + FL.TEXT + FL.tag("main") + FL.TEXT + d * 4 + kind + title + end + d * 2 + line + end * 4
                      + FL.tag("article") + FL.TEXT + d + body + FL.TEXT + end + rf"</article\s*+>{FL.TEXT}" + end + rf"</main\s*+>{FL.TEXT}" + end + menu)


def _article_native(pages: DataFrame) -> DataFrame:
    seen, hit, whole, menu = F.col("_seen"), F.col("_hit"), _whole_article(), _menu()
    read = F.col("_read")
    pages = FL.read_whole(pages, "_read", _article_page(), 8)
    pages = FL._once(pages, "_seen", F.when(read.isNull(), FL.plain()))
    regular = FL.once(seen, MAIN_BOX_ID) & FL.once(seen, CONTENT_ID) & FL.once(seen, TOOL_BOX_CLASS_STARTS)
    pages = FL._once(pages, "_hit", F.when(regular, F.struct(F.regexp_extract(seen, whole, 0).alias("main"), F.regexp_extract(seen, menu, 0).alias("menu"))))
    pages = FL._once(pages, "_cell", F.when((hit["main"] != "") & (hit["menu"] != ""), F.struct(
        FL.groups(hit["main"], whole, 4).alias("main"), FL.groups(hit["menu"], menu, 2).alias("menu"))))
    (nature, title, line, content), (praises, comments) = ([F.get(F.col("_cell")[c], i) for i in range(n)] for c, n in (("main", 4), ("menu", 2)))

    def of_line(pattern):  # the first that has a text
        return F.regexp_extract(line, pattern + r"([^<]++)<", 1)

    parts = {"title": title, "create_time": of_line(FL.tag("span", "class", TIME_CLASS_IS)), "read_count_text": of_line(FL.tag("span", "class", READ_COUNT_CLASS_IS)),
             "nature": nature, "content": content, "praises": praises, "comments_raw": comments, "user_name": of_line(FL.tag("a"))}
    order = ("nature", "title", "create_time", "read_count_text", "user_name", "content", "praises", "comments_raw")  # groups of the page
    pages = FL._once(pages, "_text", F.when(read.isNotNull(), F.struct(*[F.get(read, order.index(n) + 1).alias(n) for n in parts]))
                     .when(F.col("_cell").isNotNull(), F.struct(*[v.alias(n) for n, v in parts.items()])))
    pages = FL._once(pages, "_part", F.when(F.col("_text").isNotNull(), F.struct(*[F.nullif(F.col("_text")[n], F.lit("")).alias(n) for n in parts])))
    x = F.col("_part")
    values = {n: x[n] if n == "content" else FL.unescape(x[n]) for n in ARTICLE_FIELDS.names}
    why = _required({"h1": x["title"], "time": x["create_time"], "read count": x["read_count_text"], "user name": x["user_name"], "comments text": x["comments_raw"]})
    texts = F.concat_ws(" ", *[x[n] for n in ARTICLE_FIELDS.names if n != "content"])
    # elements whose start ends an open one of their kind could end one around the box
    apart = read.isNotNull() | ~x["content"].rlike(_ENDING) | ~F.substring_index(seen, MAIN_BOX_ID, 1).rlike(_ENDING)
    record = F.struct(*[F.when(why.isNull(), values[n]).alias(n) for n in ARTICLE_FIELDS.names], why.alias("reject_reason"))
    return FL._once(pages, "_rec", F.when(x.isNotNull() & apart & ~(texts.contains("&") & texts.rlike(FL._ENTITY)), record)).drop("_read", "_seen", "_hit", "_cell", "_text", "_part")


ARTICLE_FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in (
    "title", "create_time", "read_count_text", "nature", "content", "praises", "comments_raw", "user_name")])

ARTICLE_COLUMNS = ["title", "create_time", "read_count", "nature", "content", "praises",
                   "comments", "url", "user_name"]


def article_detail(pages: DataFrame, **kw) -> DataFrame:
    """X7 + X8: the article record; ``content`` is the markup of the body
    node, sliced verbatim from the page.  A missing node or read count
    rejects the whole record."""
    raw = extract_record(pages, Rule("article", ARTICLE_FIELDS, _article_parse), _article_native, **kw)
    return finish_article(raw)


def finish_article(raw: DataFrame) -> DataFrame:
    rc = TX.read_count("read_count_text")
    reason = (F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
              .when(rc.isNull(), F.lit("no read count")))
    df = raw.withColumn("read_count", rc).withColumn("comments", N.blank_to_zero("comments_raw")) \
        .withColumn("reason", reason)
    keep = F.col("reason").isNull()
    return df.select("page_id", *[F.when(keep, F.col(c)).alias(c) if c != "url" else F.col("url")
                                  for c in ARTICLE_COLUMNS],
                     F.col("reason").alias("reject_reason"))


def _title_parse(url, root, html):
    h1 = need(H.find(root, "h1"), "h1")
    yield {"title": need(H.first_text(h1), "h1 text")}


TITLE_FIELDS = T.StructType([T.StructField("title", T.StringType())])


def article_titles(pages: DataFrame, **kw) -> DataFrame:
    """First direct text of the first ``h1`` of every page."""
    rule = Rule("titles", TITLE_FIELDS, _title_parse, "h1", "missing h1")
    # one plain heading and no other
    form = FL.Flat(rf"<h1{FL.ATTRS}>([^<]++)</h1>", FL.MARK, "(?i)<h1", least=1)
    return FL.extract(pages, form, 1, 0, lambda g: {"title": FL.unescape(g["g1"])}, TreeRows(rule, **kw))


def _table_parse(url, root, html):
    rows = H.find_all(root, "tr")
    for i, tr in enumerate(rows):
        if i == 0:
            continue  # header row
        yield {"_pos": i, "cells": [H.all_text(td) for td in H.find_all(tr, "td")]}


TABLE_FIELDS = T.StructType([T.StructField("cells", T.ArrayType(T.StringType()))])


def html_table_rows(pages: DataFrame, **kw) -> DataFrame:
    """Every ``tr`` after the first as an array of its ``td`` texts."""
    form = FL.Flat(r"<tr\s*+>((?:\s*+<t[dh]\s*+>[^<]*+</t[dh]>)*+)\s*+</tr>\s*+", rf"{FL.MARK}++", "(?i)<t[rdh][\\s/>]")
    return FL.extract(pages, form, 1, 1, lambda g: {"cells": F.transform(F.regexp_extract_all(g["g1"], F.lit("<td\\s*+>([^<]*+)</td>"), F.lit(1)), FL.unescape)},
                      TreeRows(Rule("table", TABLE_FIELDS, _table_parse, required_tag="tr"), **kw))
