"""Flat extraction rules as native expressions, for pages of a regular form.

A rule names the markup of one item and of the container around the items.
On a regular page, cutting the items out leaves the bare container and no
other trace of it, so nothing about their structure is left open and the
tree walk would give the same.  Any other page (raw-text elements with
markup inside, other attribute syntax, entities beyond the basic five,
nested or broken lists) is irregular and keeps the tree path.

A page that one anchored pattern explains from its first to its last
character is regular by that alone and read in the same pass, without the
checks on what else could stand in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parallel import partitioned

MARK, GAP = "\u0001", "\u0002"
ATTRS = r'(?:\s+[a-zA-Z][a-zA-Z0-9\-]*="[^"<>]*+")*+\s*+'
_HIDDEN = r"(?is)<(?:!--.*?-->|(script|style|title|textarea)\b[^>]*+>.*?</\1\s*+>)"
# what the cut of hidden parts or the item patterns could misread; every
# pattern over whole pages begins with a single character that few places have
_CONTROL = r"[\x00-\x02]"
_ODD = (r"(?is)<(?=[!?stinxpm])(?:!(?!--|doctype)|\?|!--+>|(?:script|style|title|textarea)\b[^>]*/>|(?:title|textarea)\b[^>]*+>[^<]*+<(?!/(?:title|textarea)\s*+>)"
        r"|(?:iframe|noscript|noframes|noembed|xmp|plaintext|template|svg|math)\b)")
_ENTITY = r"&(?!(?:amp|lt|gt|quot|#39);)"

VALUE = r'[^"<>\x00-\x02]'                      # of an attribute, nothing hidden there
TEXT = r"[^<\x00-\x02]*+"                       # between tags, nothing hidden there
PAGE_START = rf"<html\s*+>\s*+(?:<head\s*+>\s*+(?:<title\s*+>{TEXT}</title\s*+>\s*+)?+</head\s*+>\s*+)?+<body\s*+>\s*+"
PAGE_END = r"</body\s*+>\s*+</html>\z"
_TWICE_NEAR = r'\s(class|id|title)="[^"<>]*"[^<>]*\s\1="'  # in a tag or not: a cheap first look
_TWICE = r"<[^<>]*" + _TWICE_NEAR


def tag(name: str, attr: str | None = None, value: str = "", how: str = "is") -> str:
    """Pattern of a start tag, of those whose attribute ``is``, ``has`` (inside) or ``starts`` with a value if one is given."""
    if attr is None:
        return rf"<{name}\b{ATTRS}>"
    before, behind = {"is": ("", ""), "has": ('[^"<>]*', '[^"<>]*'), "starts": ("", '[^"<>]*')}[how]
    return rf'<{name}\b(?=[^<>]*\s{attr}="{before}{value}{behind}"){ATTRS}>'


def _others(name: str) -> str:
    return rf'(?:\s+(?!(?i:{name})=)[a-zA-Z][a-zA-Z0-9\-]*="[^"<>]*+")*+'


def sole(name: str, attr: str, value: str, how: str = "is", without: str = "") -> str:
    """:func:`tag` with the attribute once, and nowhere in the tag a text of the pattern ``without``."""
    none = rf"(?![^<>]*(?:{without}))" if without else ""
    before, behind = {"is": ("", ""), "has": ('[^"<>]*?', '[^"<>]*+'), "starts": ("", '[^"<>]*+')}[how]
    return rf'<{name}\b{none}{_others(attr)}\s+{attr}="{before}{value}{behind}"{_others(attr)}\s*+>'


def holding(name: str, attr: str) -> str:
    """Pattern of a start tag that has the attribute once; its value is a group."""
    return rf'<{name}\b{_others(attr)}\s+{attr}="({VALUE}*+)"{_others(attr)}\s*+>'


def page_of(body: str) -> str:
    """Pattern of a whole page with this body, no head but a title."""
    return rf"\A{PAGE_START}{body}{PAGE_END}"


def read_whole(pages: DataFrame, name: str, pattern: str, n: int) -> DataFrame:
    """``pages`` with the groups of those that the pattern explains whole (behind an empty first one), null for the others."""
    out = F.regexp_replace("html", pattern, "".join(f"{MARK}${i}" for i in range(1, n + 1)))
    pages = _once(pages, "_out", F.when(F.col("html").startswith("<html"), out))
    return _once(pages, name, F.when(F.col("_out").startswith(MARK), F.split("_out", MARK))).drop("_out")


def element(name: str, body: str, *start) -> str:
    """Pattern of an element with a body, the text behind it included."""
    return rf"{tag(name, *start)}{TEXT}{body}</{name}\s*+>{TEXT}"


def attr(tag_text: Column, name: str) -> Column:
    """An attribute of a start tag, null without it."""
    return unescape(F.get(F.regexp_extract_all(tag_text, F.lit(rf'\s{name}="([^"]*+)"'), F.lit(1)), 0))


def groups(text: Column, pattern: str, n: int) -> Column:
    """The groups of a text that the pattern matches whole, in one pass; absent ones are empty."""
    return F.split(F.regexp_replace(text, pattern, MARK.join(f"${i}" for i in range(1, n + 1))), MARK)


def odd(page: Column) -> Column:
    """Whether a page holds what could be misread."""
    return page.rlike(_CONTROL) | page.contains("--!>") | page.rlike(_ODD)


def plain(html: str = "html") -> Column:
    """The page as :func:`visible` shows it, null if an entity, a repeated attribute or a hidden part could be misread."""
    page = F.col(html)
    return F.when(~odd(page) & ~(page.rlike(_TWICE_NEAR) & page.rlike(_TWICE)), visible(html))


def once(page: Column, word: str) -> Column:
    """Whether a word stands in the page exactly once."""
    return F.regexp_count(page, F.lit(rf"\Q{word}\E")) == 1


@dataclass(frozen=True)
class Flat:
    """``item``: pattern whose groups are the fields.  ``container``: pattern of
    what is left around the items, ``MARK`` standing for each.  ``trace``: text
    of which a regular page has none left but the container's own."""

    item: str
    container: str
    trace: str
    least: int = 0     # containers that a regular page has at the least; at the most it has one
    groups: int = 1    # of the item's pattern
    alone: bool = False  # whether a page whose body is the container and nothing else is read whole


def alone(pages: DataFrame, flat: Flat) -> DataFrame:
    """Pages with ``_alone``: of those whose body is the container and nothing else the groups of
    the items, ``GAP`` between and ``MARK`` behind them; null for other pages.

    One pass: each match begins where the last one ended, the first with the
    page's start, one with its end.  A page is explained if no tag is left."""
    opening, closing = flat.container.split(MARK + "*+")
    page, out = F.col("html"), F.col("_out")
    pattern = rf"\G(?:\A{PAGE_START}{opening})?+{flat.item}(?:{closing}\s*+{PAGE_END})?+"
    cut = F.regexp_replace(page, pattern, GAP.join(f"${i}" for i in range(1, flat.groups + 1)) + MARK)
    pages = _once(pages, "_out", F.when(page.startswith("<html") & page.endswith("</html>"), cut))
    return _once(pages, "_alone", F.when(~out.contains("<") & ~(out.contains("&") & out.rlike(_ENTITY)), out)).drop("_out")


def visible(html: str = "html") -> Column:
    """The page with a ``GAP`` for each comment, script, style, title and text area."""
    return F.regexp_replace(F.col(html), _HIDDEN, GAP)


def unescape(x: Column) -> Column:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a computed column; a generator's output is computed once a row, however often it is looked at."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def judged(pages: DataFrame, flat: Flat) -> DataFrame:
    """Pages with ``_regular``, whether all of the rule's items are of the regular form, and ``_items``, their
    groups with a ``GAP`` between (null for an irregular page)."""
    df = alone(pages, flat) if flat.alone else pages.withColumn("_alone", F.lit(None).cast("string"))
    whole = F.col("_alone")
    df = _once(df, "_seen", F.when(whole.isNull(), F.when(~odd(F.col("html")), visible())))
    df = _once(df, "_found", F.regexp_extract_all("_seen", F.lit(flat.item), F.lit(0)))
    df = _once(df, "_cut", F.regexp_replace("_seen", flat.item, MARK))
    df = _once(df, "_bare", F.regexp_replace("_cut", flat.container, ""))
    found = F.size(F.regexp_extract_all("_cut", F.lit(flat.container), F.lit(0)))
    ok = ~F.col("_bare").contains(MARK) & ~F.col("_bare").rlike(flat.trace) & ~F.col("_bare").rlike(r"(?i)<(?:script|style|title|textarea)\b") \
        & ~F.array_join("_found", "").rlike(_ENTITY + "|" + GAP) & found.between(flat.least, 1)
    df = _once(df, "_regular", whole.isNotNull() | F.coalesce(ok, F.lit(False)))
    each = F.transform("_found", lambda i: F.regexp_replace(i, flat.item, GAP.join(f"${k}" for k in range(1, flat.groups + 1))))
    items = F.when(whole.isNotNull(), F.split(F.substring(whole, F.lit(1), F.length(whole) - 1), MARK)).when(F.col("_regular"), each)
    return _once(df, "_items", items).drop("_alone", "_seen", "_found", "_cut", "_bare")


def extract(pages: DataFrame, flat: Flat, n: int, first: int, record, tree, reason=None) -> DataFrame:
    """Rows of regular pages natively, of the others by ``tree``, in one pass over the pages.

    ``record(g)``: output columns of an item from its groups ``g1``..; an
    absent group is empty.  ``reason(g)``: why an item is rejected, or null.
    ``first``: the position of the first item that counts.  ``tree(pages)``: the
    rows by the tree walk, ``tree.rows(left, url, html)``: those of the pages
    left to it as an array (``tree.kind``).  Streams take the tree path."""
    if pages.isStreaming:
        return tree(pages)
    src = partitioned(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), "page_id")
    src = judged(src, flat)
    left = ~F.col("_regular")
    src = _once(src, "_tree", tree.rows(left, F.when(left, F.col("url")), F.when(left, F.col("html"))))
    # an item's groups, or a row that the tree has made
    found = F.transform("_items", lambda i, pos: F.struct(pos.cast("int").alias("pos"), i.alias("item"), F.lit(None).cast(tree.kind).alias("row")))
    made = F.transform(tree.read("_tree"), lambda r: F.struct(r["pos"].alias("pos"), F.lit(None).cast("string").alias("item"), r["row"].alias("row")))
    rows = src.select("page_id", "url", F.inline(F.when(left, made).otherwise(found)))
    own = F.col("item").isNotNull()
    rows = _once(rows.where(~own | (F.col("pos") >= first)), "_g", F.split("item", GAP))
    rows = rows.withColumn("g", F.when(own, F.struct(*[F.get("_g", i - 1).alias(f"g{i}") for i in range(1, n + 1)])))
    why = reason(F.col("g")) if reason else F.lit(None).cast("string")
    return rows.select("page_id", "url", "pos",
                       *[F.when(~own, F.col("row")[name]).when(why.isNull(), c).alias(name) for name, c in record(F.col("g")).items()],
                       F.when(~own, F.col("row.reject_reason")).otherwise(why).alias("reject_reason"))
