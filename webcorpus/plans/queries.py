"""Registered queries: one per operator key of the blueprint.

Each function takes ``(spark, sf_dir)``, reads the driver tables in full
and returns a DataFrame.  Round-trip (RT) queries render the site layout
from a driver table (``render``), extract it again, and are compared with
SQL that reads the source table directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numbers as N
from ..functions import text as TX
from ..functions import urls as U
from ..operators import corpus as C
from ..operators import extract as X
from ..operators import frontier as G
from ..operators import routing as R
from ..operators import visited as V
from ..operators import visited_filter as VF
from ..operators.parallel import dealt
from ..session import apply_runtime_conf, remove_scratch, scratch_path
from ..sources import tables as S
from ..streaming import retries as RT
from ..streaming import stream as W
from . import corpus_build as CB
from . import crawl as CR
from . import render as RD


def _t(spark, sf_dir, name) -> DataFrame:
    apply_runtime_conf(spark)
    return S.read_table(spark, sf_dir, name)


# -- scans, corpus ------------------------------------------------------------

def page_scan(spark, sf_dir):
    """The page table, one row per page."""
    return S.read_pages(spark, f"{sf_dir}/pages.parquet")


def content_projection(spark, sf_dir):
    """S3/R2: only the body column of the stored articles."""
    return _t(spark, sf_dir, "pages").select(F.col("html").alias("content"))


def strip_markup(spark, sf_dir):
    """T1-T3 on every page (flagship)."""
    return C.strip_markup(RD.planted_pages(_t(spark, sf_dir, "pages")))


def drop_blank(spark, sf_dir):
    """P6 after T1-T3: documents that are not only spaces."""
    docs = C.strip_markup(RD.planted_documents(_t(spark, sf_dir, "documents")), "text", "doc_id")
    return C.drop_blank(docs)


def json_corpus(spark, sf_dir):
    """The cleaned corpus written as JSON Lines, read back."""
    docs = C.drop_blank(C.strip_markup(RD.planted_documents(_t(spark, sf_dir, "documents")), "text", "doc_id"))
    path = scratch_path(spark, "json_corpus")
    C.write_json_corpus(docs, path)
    return C.read_json_corpus(spark, path)


def wholetext_scan(spark, sf_dir):
    """Every document written as a file of its own, read back one row
    per file with its line ends normalised."""
    docs = _t(spark, sf_dir, "documents").select("text")
    path = scratch_path(spark, "text_files")
    C.write_each(docs, path)
    # the writer ends every text with a newline
    return S.read_text_files(spark, path).select(F.regexp_replace("text", r"\n\z", "").alias("text"))


def wholetext_lines(spark, sf_dir):
    """The lines of the files read whole."""
    return wholetext_scan(spark, sf_dir).select(F.explode(F.split("text", "\n")).alias("line"))


def per_file_outputs(spark, sf_dir):
    """K5: one output per document, under its file name, read back by name."""
    docs = _t(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("file_name"), "text")
    path = scratch_path(spark, "per_file")
    C.write_per_file(docs, path)
    back = C.read_per_file(spark, path)
    return back.select("file_name", F.regexp_replace(F.regexp_replace("text", r"\r\n?", "\n"), r"\n\z", "").alias("text"))


def sql_single_row(spark, sf_dir):
    """SQL pass-through that must return exactly one row."""
    _t(spark, sf_dir, "pages").createOrReplaceTempView("webcorpus_pages")
    return S.sql_single_row(spark, "SELECT count(*) AS n_pages, count(DISTINCT url) AS n_urls, "
                                   "sum(length(html)) AS n_chars FROM webcorpus_pages")


def sql_rows(spark, sf_dir):
    """SQL pass-through of all rows, over tables named in the statement."""
    return S.sql_rows(spark, "SELECT d.source, l.quality, count(*) AS n, sum(length(d.text)) AS n_chars FROM {docs} d JOIN {labels} l ON d.doc_id = l.doc_id "
                             "GROUP BY d.source, l.quality", docs=_t(spark, sf_dir, "documents"), labels=_t(spark, sf_dir, "labels"))


# -- URL, number and key-value rules ----------------------------------------

def visit_key(spark, sf_dir):
    """P4 + U1: eligible page URLs and their visit keys."""
    p = _t(spark, sf_dir, "pages")
    return V.keyed(p.select("page_id", "url"), "url")


def follow_url(spark, sf_dir):
    """U4: follow-list URL of every page URL taken as an author URL."""
    p = _t(spark, sf_dir, "pages")
    return p.select("page_id", "url", U.follow_url("url").alias("follow_url"))


def resolve_url(spark, sf_dir):
    """Every link of every page resolved against the page URL, as
    written (root-relative) and as a path-relative variant."""
    p = _t(spark, sf_dir, "pages")
    links = p.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1))
                     .alias("pos", "href"))
    # both forms from one scan of the pages (a union would read the HTML twice)
    forms = F.array(F.struct(F.lit("rooted").alias("form"), F.col("href").alias("href")),
                    F.struct(F.lit("relative").alias("form"), F.regexp_replace("href", "^/", "").alias("href")))
    both = links.select("page_id", "url", "pos", F.explode(forms).alias("f")).select("page_id", "url", "pos", "f.*")
    return both.withColumn("resolved", U.resolve_url("url", "href"))


def lenient_int(spark, sf_dir):
    """M1 over order text columns (some numbers, most not)."""
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    N.lenient_int("o_orderpriority").alias("prio_whole"),
                    N.lenient_int(F.substring_index("o_orderpriority", "-", 1)).alias("prio_lead"),
                    N.lenient_int(F.concat(F.lit(" "), F.floor("o_totalprice").cast("string"), F.lit(" ")))
                    .alias("price_floor"),
                    N.lenient_int(F.col("o_totalprice").cast("string")).alias("price_text"))


def _orders_per_customer(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return c.join(n, c.c_custkey == n.o_custkey, "left").select(
        "c_custkey", "c_nationkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


def list_page_urls(spark, sf_dir):
    """M2 + X10: article list pages of every author (orders per customer,
    ``c_nationkey % 10`` per page, 0 -> no pages), last page included."""
    c = _orders_per_customer(spark, sf_dir)
    authors = c.select("c_custkey", RD.user_url("c_custkey").alias("user_url"),
                       F.coalesce(N.ceil_div("n_orders", F.col("c_nationkey") % 10), F.lit(0)).alias("n_pages"))
    return G.list_pages(authors, "user_url", "n_pages").select(
        "c_custkey", F.col("page_no").cast("int").alias("page_no"), "list_url")


def kv_map(spark, sf_dir):
    """``k=v; k=v`` text rendered from customers, parsed back."""
    c = _t(spark, sf_dir, "customer")
    txt = F.concat(F.lit(" seg=first ; name="), F.col("c_name"), F.lit(";seg="), F.col("c_mktsegment"),
                   F.lit(" ; note=a=b ;bal="), F.floor("c_acctbal").cast("string"), F.lit(";"))
    m = TX.kv_map(txt)
    return c.select("c_custkey", m["name"].alias("name"), m["seg"].alias("seg"), m["note"].alias("note"),
                    m["bal"].alias("bal"), F.size(m).alias("n_keys"))


# -- sentences and tokens -----------------------------------------------------

def sentence_split(spark, sf_dir):
    """T8 on every document."""
    return C.sentence_rows(RD.planted_documents(_t(spark, sf_dir, "documents").select("doc_id", "text")))


def char_tokens(spark, sf_dir):
    """T8 + T9: one line of space-separated characters per sentence."""
    return C.char_tokens(RD.planted_documents(_t(spark, sf_dir, "documents").select("doc_id", "text")))


# -- page extraction ----------------------------------------------------------

def nav_links(spark, sf_dir):
    """X1 on the driver pages (their ``nav`` has no id, so every nav)."""
    return X.nav_links(RD.planted_pages(_t(spark, sf_dir, "pages")), nav_id=None)


def link_edges(spark, sf_dir):
    """Category edges page -> target."""
    return G.nav_edges(X.nav_links(_t(spark, sf_dir, "pages"), nav_id=None))


def site_link_edges(spark, sf_dir):
    """G2 RT: the whole edge table of a crawl -- feed, follow, article-list
    and list-page edges from pages rendered from orders and customers."""
    o = _t(spark, sf_dir, "orders")
    return G.link_edges(
        G.feed_edges(X.feed_links(RD.feed_pages(o))),
        G.followee_edges(X.followee_links(RD.followee_pages(o))),
        G.article_list_edges(X.article_list_links(RD.article_list_pages(o))),
        G.list_page_edges(user_profile(spark, sf_dir)))


def article_titles(spark, sf_dir):
    """X7 title rule on the driver pages."""
    return X.article_titles(_t(spark, sf_dir, "pages"))


def feed_links(spark, sf_dir):
    """X2 RT on feeds rendered from orders."""
    return X.feed_links(RD.feed_pages(_t(spark, sf_dir, "orders")))


def user_profile(spark, sf_dir):
    """X3 + X4 RT on profiles rendered from customers."""
    # one page per row: the narrow rows are dealt out, so pages render in parallel
    return X.user_profile(RD.profile_pages(dealt(_t(spark, sf_dir, "customer"))), repartition=False)


def page_count(spark, sf_dir):
    """X4 + M2 RT: page counts read from the profile page scripts."""
    return user_profile(spark, sf_dir).select("url", "list_total", "page_size", "page_count", "reject_reason")


def badges_join(spark, sf_dir):
    """T7 RT: badge titles joined with ``/``."""
    return user_profile(spark, sf_dir).select("url", "badges", "reject_reason")


def followee_links(spark, sf_dir):
    """X5 RT on follow lists rendered from orders."""
    return X.followee_links(RD.followee_pages(_t(spark, sf_dir, "orders")))


def article_list_links(spark, sf_dir):
    """X6 RT on article lists rendered from orders."""
    return X.article_list_links(RD.article_list_pages(_t(spark, sf_dir, "orders")))


def article_detail(spark, sf_dir):
    """X7 + X8 + T5 + M3 RT on article pages rendered from orders."""
    # one page per row: the narrow rows are dealt out, so pages render in parallel
    return X.article_detail(RD.article_pages(dealt(_t(spark, sf_dir, "orders"))), repartition=False)


def read_count(spark, sf_dir):
    """T5 RT: read counts of the article pages."""
    return article_detail(spark, sf_dir).select("url", "read_count", "reject_reason")


def originals_only(spark, sf_dir):
    """P5 RT: stored articles of the ``original`` kind only."""
    ok, _ = X.split_rejects(article_detail(spark, sf_dir))
    return ok.where(F.col("nature") == RD.ORIGINAL).select("url", "title", "nature")


def html_table_rows(spark, sf_dir):
    """X9 + P8 + T12 RT: table rows whose 6th cell is ``http`` projected to
    ``proto://cell2:cell3``."""
    rows = X.html_table_rows(RD.table_pages(_t(spark, sf_dir, "supplier")))
    ok = rows.where(F.col("reject_reason").isNull())
    return ok.where(F.get("cells", 5) == "http").select(
        "page_id", "pos", F.concat(F.get("cells", 5), F.lit("://"), F.get("cells", 1), F.lit(":"),
                                   F.get("cells", 2)).alias("proxy"))


def json_feed_links(spark, sf_dir):
    """S9/J2 RT: JSON feeds rendered from orders, parsed with ``from_json``."""
    feeds = RD.json_feed_pages(_t(spark, sf_dir, "orders"))
    schema = T.StructType([T.StructField("articles", T.ArrayType(T.StructType([
        T.StructField("user_url", T.StringType()), T.StructField("url", T.StringType())])))])
    parsed = feeds.select("page_id", F.from_json("body", schema).alias("j"))
    return parsed.select("page_id", F.posexplode("j.articles").alias("pos", "a")) \
        .select("page_id", "pos", F.col("a.url").alias("url"), F.col("a.user_url").alias("user_url"))


# -- sinks and routing --------------------------------------------------------

ARTICLE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in X.ARTICLE_COLUMNS])
USER_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c in ("credits", "ranks") else T.StringType()) for c in X.USER_COLUMNS])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in declaration order; an unknown or missing column is
    an error (``DataFrame.to`` alone would fill missing ones with null)."""
    extra = [c for c in df.columns if c not in schema.names]
    missing = [c for c in schema.names if c not in df.columns]
    if extra or missing:
        raise ValueError(f"schema mismatch: extra={extra} missing={missing}")
    return df.to(schema)


def article_info_append(spark, sf_dir):
    """K2 RT: article records appended to ``article_info`` in two batches,
    the second over all pages: a key the history holds is not stored again.
    Every stored row has a surrogate id."""
    pages = RD.article_pages(_t(spark, sf_dir, "orders"))
    base = scratch_path(spark, "article_info")
    paths = CR.CrawlPaths(base + "/article_info", base + "/rejects", base + "/retry")
    new = CR.crawl_articles(pages.where(F.col("page_id") % 3 == 0), None, paths, batch_id="0")
    CR.crawl_articles(pages, new, paths, batch_id="1")
    stored = CR.read_table(spark, paths.articles, CR.ARTICLE_SCHEMA)
    return stored.where(F.col("id") == CR.surrogate_id()).select(*X.ARTICLE_COLUMNS)


def schema_enforce(spark, sf_dir):
    """Article records checked against the fixed schema."""
    ok, _ = X.split_rejects(article_detail(spark, sf_dir))
    return enforce_schema(ok.drop("page_id"), ARTICLE_SCHEMA)


def user_info_append(spark, sf_dir):
    """K1 RT: author records with their surrogate id, appended when first
    seen in set ``user``: a first batch is history, the second holds all."""
    ok, _ = X.split_rejects(user_profile(spark, sf_dir))
    # looked at four times below: the profiles are extracted once
    cand, once = V.keyed(ok.select(*X.USER_COLUMNS, "page_id"), "url", "user"), scratch_path(spark, "authors")
    cand.write.parquet(once)
    cand = spark.read.schema(cand.schema).parquet(once)
    path, schema = scratch_path(spark, "user_info"), T.StructType([T.StructField("id", T.LongType()), *USER_SCHEMA.fields])
    visited = None
    for batch in (cand.where(F.col("page_id") % 2 == 0), cand):
        first = V.with_rows(V.first_seen(batch, visited, order_cols=("page_id",)), batch, ("page_id",))
        enforce_schema(first.select(CR.surrogate_id().alias("id"), *X.USER_COLUMNS), schema).write.mode("append").parquet(path)
        stored = spark.read.schema(schema).parquet(path)
        visited = V.keyed(stored.select("url"), "url", "user").select("meta", "key")
    remove_scratch(spark, once)
    return stored.where(F.col("id") == CR.surrogate_id()).select(*X.USER_COLUMNS)


def article_rejects(spark, sf_dir):
    """K8 RT: the reject table of the article stage."""
    return R.rejects_table(article_detail(spark, sf_dir), "article")


def challenge_split(spark, sf_dir):
    """P1 + W4: pages carrying the marker go back for another attempt.
    The driver pages hold no challenge marker, so the marker here is the
    spam host name, a text some pages do carry."""
    p = _t(spark, sf_dir, "pages").select("page_id", "html")
    out = R.challenge_split(p, marker="spam-farm", max_attempts=3)
    return out.select("page_id", "route", "next_attempt")


def severity_route(spark, sf_dir):
    """K9: events routed to the error sink or the main sink."""
    e = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("level"))
    return R.severity_route(e)


def mark_after_write(spark, sf_dir):
    """K3: keys marked visited only from the rows the sink holds; the second
    run of the same records stores nothing more."""
    recs = _t(spark, sf_dir, "pages").select("page_id", "url")
    path = scratch_path(spark, "marked")
    _, visited = R.write_then_mark(recs, path, None, "blog")
    stored, visited = R.write_then_mark(recs, path, visited, "blog")
    times = V.keyed(stored.select("url"), "url", "blog").groupBy("meta", "key").agg(F.count("*").alias("n_stored"))
    return visited.join(times, ["meta", "key"], "left").select("meta", "key", "n_stored")


def last_by_title(spark, sf_dir):
    """K6: one article per page title; the last written wins."""
    p = _t(spark, sf_dir, "pages")
    rows = p.select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
                    F.col("html").alias("content"))
    return C.last_by_title(rows)


# -- visited sets --------------------------------------------------------------

def _event_keys(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("meta"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"),
                    "ts", "event_id", "value")


def first_seen(spark, sf_dir):
    """First event of every (type, user) pair."""
    return V.first_seen(_event_keys(spark, sf_dir).drop("value"), None, order_cols=("ts", "event_id")) \
        .select("meta", "key", F.col("event_id").alias("first_event_id"))


def set_members(spark, sf_dir):
    """S7 + T11: the distinct members of one named set, stored as bytes."""
    stored = _event_keys(spark, sf_dir).select("meta", F.encode("key", "UTF-8").alias("key"))
    return V.members(stored, "error")


def forget_keys(spark, sf_dir):
    """Pairs with a large error event forgotten from the set."""
    k = _event_keys(spark, sf_dir)
    visited = k.select("meta", "key").distinct()
    forget = k.where((F.col("meta") == "error") & (F.col("value") >= 50)).select("meta", "key")
    return V.forget_keys(visited, forget)


def _doc_keys(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id")
    return d.select("doc_id", F.lit("blog").alias("meta"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"))


def _label_urls(spark, sf_dir):
    l = _t(spark, sf_dir, "labels").select("doc_id")
    return l.select(F.concat(F.lit(RD.BLOG + "/d"), F.col("doc_id").cast("string")).alias("url"))


def is_member(spark, sf_dir):
    """D3: is each document's key in the set built from ``labels``?"""
    visited = V.keyed(_label_urls(spark, sf_dir), "url", "blog")
    return V.is_member(_doc_keys(spark, sf_dir), visited).select("doc_id", "meta", "key", "is_member")


def is_member_filtered(spark, sf_dir):
    """D3 with the set's Bloom filter: keys it does not know take no part in the join."""
    visited = V.keyed(_label_urls(spark, sf_dir), "url", "blog").select("meta", "key")
    blocks = VF.blocks_for(_t(spark, sf_dir, "labels").count())
    found = VF.is_member_filtered(_doc_keys(spark, sf_dir), visited, VF.build(visited, blocks), blocks)
    return found.select("doc_id", "meta", "key", "is_member")


def reconcile_visited(spark, sf_dir):
    """Document keys against the stored (labelled) article URLs."""
    return V.reconcile(_doc_keys(spark, sf_dir).select("meta", "key"), _label_urls(spark, sf_dir), "blog")


def rekey_visited(spark, sf_dir):
    """A set holding full page URLs and bare keys, re-keyed."""
    p = _t(spark, sf_dir, "pages")
    # every page URL as a member, plus its bare key when it has one: one pass
    members = F.filter(F.array(F.col("url"), U.visit_key("url")), lambda k: k.isNotNull())
    visited = p.select(F.lit("blog").alias("meta"), F.explode(members).alias("key"))
    return V.rekey(visited)


def _frontier(spark, sf_dir):
    """Three producers from one scan of the pages: the page itself (set
    ``blog``), its author's follow page (set ``user``) and every link
    target (set ``blog``), each with its page and its place in it."""
    p = _t(spark, sf_dir, "pages").select("page_id", "url", "html")
    base, href = U.follow_parts("url")

    def item(meta, base, href, pos):
        return F.struct(F.lit(meta).alias("meta"), base.alias("base"), href.alias("href"), pos.alias("pos"))
    own = F.array(item("blog", F.lit(None).cast("string"), F.col("url"), F.lit(-2)), item("user", base, href, F.lit(-1)))
    links = F.transform(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1),
                        lambda h, i: item("blog", F.col("url"), h, i))
    items = p.select("page_id", F.explode(F.concat(own, links)).alias("it")).select("page_id", "it.*")
    url = F.when(F.col("base").isNull(), F.when(F.col("meta") == "blog", F.col("href"))).otherwise(U.resolve_url("base", "href"))
    # a generator's output is computed once, however often it is looked at
    items = items.select("meta", "page_id", "pos", F.explode(F.array(url)).alias("url"))
    return V.frontier_union(items)


def frontier_union(spark, sf_dir):
    """D6 + P7 + D1: pages, follow pages and link targets into one frontier,
    first arrival (page, then place in it) per (meta, key)."""
    f = _frontier(spark, sf_dir)
    f = f.select("meta", "page_id", "pos", "url", F.explode(F.array(U.visit_key("url"))).alias("key")).where(F.col("key").isNotNull())
    path = scratch_path(spark, "frontier")
    f.write.parquet(path)
    f = spark.read.schema(f.schema).parquet(path)
    order = ("page_id", "pos")
    return V.with_rows(V.first_seen(f, None, order_cols=order), f, order).select("meta", "key", "url")


def crawl_closure(spark, sf_dir):
    """G1: nodes reachable from the first supplier over all lineitem links
    between suppliers and parts, with their BFS depth."""
    li = _t(spark, sf_dir, "lineitem")
    edges = G.undirected(li.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
                                   F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst")))
    seeds = li.select(F.concat(F.lit("s"), F.min("l_suppkey").cast("string")).alias("node"))
    return G.crawl_closure(spark, edges, seeds, symmetric=True)


def site_closure(spark, sf_dir):
    """G1 on G2 RT: everything reachable from one list page over the links
    extracted from feeds, follow lists, article lists and profiles."""
    edges = site_link_edges(spark, sf_dir).select(F.col("src_url").alias("src"), F.col("dst_url").alias("dst"))
    seed = spark.createDataFrame([(RD.BLOG + "/list/1",)], "node string")
    return G.crawl_closure(spark, edges, seed).withColumnRenamed("node", "url")


# -- the crawl step (E1) ------------------------------------------------------

def _crawl(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    seen = V.keyed(o.where(F.col("o_orderstatus") == "F")
                    .select(RD.article_url("o_custkey", "o_orderkey").alias("url")), "url", "blog")
    base = scratch_path(spark, "crawl")
    paths = CR.CrawlPaths(base + "/article_info", base + "/rejects", base + "/retry")
    seen = seen.select("meta", "key")
    new = CR.crawl_articles(RD.article_pages(o), seen, paths, batch_id="0")
    return paths, V.mark(seen, new)


def append_twice(spark, sf_dir):
    """E1 + K2 + K3 RT: finished orders as history, then all orders, then the
    same batch again under another name; every record is stored once."""
    o = _t(spark, sf_dir, "orders")
    base = scratch_path(spark, "append_twice")
    paths = CR.CrawlPaths(base + "/article_info", base + "/rejects", base + "/retry")
    visited = None
    for batch, pages in enumerate((RD.article_pages(o.where(F.col("o_orderstatus") == "F")), RD.article_pages(o), RD.article_pages(o))):
        new = CR.crawl_articles(pages, visited, paths, batch_id=str(batch))
        visited = new if visited is None else V.mark(visited, new)
        visited.write.parquet(f"{base}/visited{batch}")
        visited = spark.read.schema(visited.schema).parquet(f"{base}/visited{batch}")
    stored = CR.read_table(spark, paths.articles, CR.ARTICLE_SCHEMA)
    return stored.select("batch", "url", "title")


def crawl_rejects(spark, sf_dir):
    """K8 + P1 + P4 RT: the reject log of a batch with ineligible URLs,
    challenge pages and broken articles."""
    base = scratch_path(spark, "crawl_rejects")
    paths = CR.CrawlPaths(base + "/article_info", base + "/rejects", base + "/retry")
    CR.crawl_articles(RD.faulty_article_pages(_t(spark, sf_dir, "orders")), None, paths, batch_id="0", max_attempts=1)
    return CR.read_table(spark, paths.rejects, CR.REJECT_SCHEMA).drop("batch")


def retry_rounds(spark, sf_dir):
    """Three rounds of fetching.  Pages with id % 4 = 0 are challenged
    every time, those with % 4 = 1 once; the retry table carries the attempts."""
    pages = _t(spark, sf_dir, "pages").select("page_id", "url", "html")
    base = scratch_path(spark, "retry_rounds")
    retries, out = spark.createDataFrame([], CR.RETRY_SCHEMA), None
    fetch = pages
    for n in (1, 2, 3):
        again = (F.col("page_id") % 4 == 0) | ((F.col("page_id") % 4 == 1) & F.lit(n == 1))
        got = fetch.withColumn("html", F.when(again, F.lit("<html>arg1</html>")).otherwise(F.replace("html", F.lit("arg1"), F.lit(""))))
        routed = R.challenge_split(R.with_attempts(got, retries)).select(F.lit(n).alias("round"), "page_id", "url", "route", "next_attempt")
        routed.write.parquet(f"{base}/routed{n}")
        routed = spark.read.schema(routed.schema).parquet(f"{base}/routed{n}")
        out = routed if out is None else out.unionByName(routed)
        retries = routed.where(F.col("route") == "retry").select("page_id", "url", F.col("next_attempt").alias("attempt"))
        fetch = pages.join(retries.select("page_id"), "page_id", "left_semi")
    return out.drop("url")


def stream_retry_rounds(spark, sf_dir):
    """W1 + W4: the same three rounds as a stateful stream, started anew for each: the attempts come from its state."""
    pages = _t(spark, sf_dir, "pages").select("page_id", "url", "html")
    src, (out, ck) = scratch_path(spark, "stream_rounds"), W.new_locations(spark, "stream_retry_rounds")
    fetch = pages
    for n in (1, 2, 3):
        again = (F.col("page_id") % 4 == 0) | ((F.col("page_id") % 4 == 1) & F.lit(n == 1))
        fetch.withColumn("html", F.when(again, F.lit("<html>arg1</html>")).otherwise(F.replace("html", F.lit("arg1"), F.lit("")))).write.parquet(f"{src}/part{n}")
        arrived = W.read_stream(spark, f"{src}/*/*.parquet", pages.schema)
        W.run_to_table(RT.requeue(arrived).withColumn("round", F.lit(n)), out, ck)
        routed = spark.read.parquet(out)
        retries = routed.where((F.col("round") == n) & (F.col("route") == "retry")).select("page_id")
        fetch = pages.join(retries, "page_id", "left_semi")
    return spark.read.parquet(out).select("round", "page_id", "route", F.col("attempt").alias("next_attempt"))


def crawl_articles(spark, sf_dir):
    """E1 RT: article pages of orders not yet visited (the finished ones
    are), extracted and stored; returns the stored records."""
    paths, _ = _crawl(spark, sf_dir)
    return CR.read_table(spark, paths.articles, CR.ARTICLE_SCHEMA).drop("batch", "id")


def crawl_visited(spark, sf_dir):
    """E1 + K3 RT: the visited set after the step: old members plus the
    keys of the records written."""
    _, visited = _crawl(spark, sf_dir)
    return visited


# -- corpus build (E2) and visited-set maintenance (E3) ----------------------

def corpus_tokens(spark, sf_dir):
    """Documents cleaned (T1-T3, P6), written as JSON Lines, then
    tokenised to character lines from the written corpus."""
    base = scratch_path(spark, "corpus")
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    _, tokens = CB.build_corpus(docs, CB.CorpusPaths(base + "/json", base + "/tokens"))
    return tokens


def visited_refresh(spark, sf_dir):
    """The document-key set reconciled with the labelled (stored)
    articles; returns the new version of the set as written."""
    path, _ = CB.refresh_visited(_doc_keys(spark, sf_dir).select("meta", "key"), _label_urls(spark, sf_dir),
                                 "blog", scratch_path(spark, "visited_versions"), "1")
    return spark.read.parquet(path).select("meta", "key")


# -- streams --------------------------------------------------------------------

def stream_extract(spark, sf_dir):
    """Titles extracted from a page stream, written per micro-batch."""
    apply_runtime_conf(spark)
    s = W.read_stream(spark, f"{sf_dir}/pages*.parquet", S.PAGE_SCHEMA)
    out, ck = W.new_locations(spark, "stream_extract")
    W.run_to_table(X.article_titles(s), out, ck)
    return spark.read.parquet(out).drop("batch_id")


def stream_first_seen(spark, sf_dir):
    """First-seen (type, user) keys over an event stream."""
    apply_runtime_conf(spark)
    schema = _t(spark, sf_dir, "events").schema
    s = W.read_stream(spark, f"{sf_dir}/events*.parquet", schema)
    keyed = s.select(F.col("event_type").alias("meta"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"))
    out, ck = W.new_locations(spark, "stream_first_seen")
    W.run_to_table(W.stream_first_seen(keyed), out, ck)
    return spark.read.parquet(out).drop("batch_id")


def stream_left_anti(spark, sf_dir):
    """W3 + W5: events of users not yet stored (the stored side: customers
    of one market segment), routed to two sinks in one micro-batch function."""
    apply_runtime_conf(spark)
    schema = _t(spark, sf_dir, "events").schema
    s = W.read_stream(spark, f"{sf_dir}/events*.parquet", schema)
    stored = _t(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING") \
        .select(F.col("c_custkey").alias("user_id"))
    fresh = W.stream_left_anti(s.select("event_id", "user_id", F.col("event_type").alias("level")), stored, ["user_id"])
    out, ck = W.new_locations(spark, "stream_left_anti")
    W.run_to_table(fresh, out, ck, batch_fn=lambda b, _: R.severity_route(b), partition_by=["sink"])
    return spark.read.parquet(out).select("event_id", "user_id", "level", "sink")


QUERIES = {
    "page_scan": page_scan,
    "content_projection": content_projection,
    "strip_markup": strip_markup,
    "drop_blank": drop_blank,
    "json_corpus": json_corpus,
    "wholetext_scan": wholetext_scan,
    "wholetext_lines": wholetext_lines,
    "per_file_outputs": per_file_outputs,
    "sql_single_row": sql_single_row,
    "sql_rows": sql_rows,
    "visit_key": visit_key,
    "follow_url": follow_url,
    "resolve_url": resolve_url,
    "lenient_int": lenient_int,
    "list_page_urls": list_page_urls,
    "kv_map": kv_map,
    "sentence_split": sentence_split,
    "char_tokens": char_tokens,
    "nav_links": nav_links,
    "link_edges": link_edges,
    "site_link_edges": site_link_edges,
    "article_titles": article_titles,
    "feed_links": feed_links,
    "user_profile": user_profile,
    "page_count": page_count,
    "badges_join": badges_join,
    "followee_links": followee_links,
    "article_list_links": article_list_links,
    "article_detail": article_detail,
    "read_count": read_count,
    "originals_only": originals_only,
    "html_table_rows": html_table_rows,
    "json_feed_links": json_feed_links,
    "article_info_append": article_info_append,
    "schema_enforce": schema_enforce,
    "user_info_append": user_info_append,
    "article_rejects": article_rejects,
    "challenge_split": challenge_split,
    "severity_route": severity_route,
    "mark_after_write": mark_after_write,
    "last_by_title": last_by_title,
    "first_seen": first_seen,
    "set_members": set_members,
    "forget_keys": forget_keys,
    "is_member": is_member,
    "is_member_filtered": is_member_filtered,
    "reconcile_visited": reconcile_visited,
    "rekey_visited": rekey_visited,
    "frontier_union": frontier_union,
    "crawl_closure": crawl_closure,
    "site_closure": site_closure,
    "corpus_tokens": corpus_tokens,
    "visited_refresh": visited_refresh,
    "crawl_articles": crawl_articles,
    "append_twice": append_twice,
    "crawl_rejects": crawl_rejects,
    "retry_rounds": retry_rounds,
    "stream_retry_rounds": stream_retry_rounds,
    "crawl_visited": crawl_visited,
    "stream_extract": stream_extract,
    "stream_first_seen": stream_first_seen,
    "stream_left_anti": stream_left_anti,
}
