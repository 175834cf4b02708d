"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement reads the driver tables directly (views ``pages``,
``documents``, ``orders`` ...) and computes the expected result of the
matching Spark query by other means: regexes instead of the HTML tree,
window functions instead of aggregates, the source table instead of the
rendered round-trip pages.  Column names equal the Spark output's.
"""

from __future__ import annotations

# -- shared fragments -----------------------------------------------------------

def UNESC(x: str) -> str:
    # HTML5 decoding: these references are also read without their ';'
    return (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, "
            f"'&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '\"', 'g'), '&#39;?', '''', 'g'), "
            f"'&amp;?', '&', 'g')")


def ORIGIN(u: str) -> str:
    return rf"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)"


def STRIP_MARKUP(x: str) -> str:
    return (r"regexp_replace(regexp_replace(regexp_replace(regexp_replace("
            rf"{x}, '\r\n?', chr(10), 'g'), "
            r"""'<span\s+class="katex--display">.*?</span><br/>', '', 'g'), """
            r"'<.*?>', '', 'g'), "
            r"'(?m)^ +| +\z', '', 'g')")


def ELIGIBLE(u: str) -> str:
    return rf"(regexp_matches({u}, '^(?i)https?:') AND len(string_split({u}, '.net/')) = 2)"


def KEY(u: str) -> str:
    return f"string_split({u}, '.net/')[2]"


def STRIP_KEY(k: str) -> str:
    return f"CASE WHEN len(string_split({k}, '.net/')) = 2 THEN string_split({k}, '.net/')[2] ELSE {k} END"


def FOLLOW(u: str) -> str:
    """By list operations: the host's first label, and the last two path parts."""
    p = f"string_split({u}, '/')"
    host = f"CASE WHEN starts_with({p}[3], 'blog.') THEN 'me.' || substr({p}[3], 6) ELSE {p}[3] END"
    return (f"lower({p}[1]) || '//' || {host} || '/' || array_to_string(list_concat("
            f"CASE WHEN len({p}) > 5 THEN {p}[4:len({p}) - 2] ELSE [] END, ['follow', {p}[len({p})]]), '/')")


def LENIENT(x: str) -> str:
    ws = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
    t = f"translate(trim({x}, {ws}), '０１２３４５６７８９', '0123456789')"
    return (f"coalesce(CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+(_[0-9]+)*') "
            f"THEN TRY_CAST(replace({t}, '_', '') AS BIGINT) END, 0)")


def SENTENCES(x: str) -> str:
    marked = (rf"regexp_replace(regexp_replace({x}, '([。！？])', '\1' || chr(1), 'g'), "
              r"'([.!?])[ \t\r\n]+', '\1' || chr(1), 'g')")
    return (f"list_filter(list_transform(string_split({marked}, chr(1)), "
            r"lambda s: regexp_replace(s, '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g')), lambda s: s <> '')")


# the rows that ``render.planted_pages`` and ``planted_documents`` change or add, by the same keys
PAGES = """(SELECT page_id, url, CASE WHEN page_id % 7 = 0 THEN
  'a  <span class="katex--display">x<b>y</b></span><br/>  b' || chr(13) || '  c <i>d</i>' || chr(13) || chr(10) ELSE '' END ||
  CASE WHEN page_id % 5 = 0 THEN replace(html, '</ul></nav>', '<li><a href="/watchers/x">w</a></li></ul></nav>') ELSE html END AS html FROM pages)"""
DOCS = """(SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN '你好。今天天气很好！是吗？好' || text WHEN doc_id % 4 = 0 THEN '<p>tagged</p> ' || text ELSE text END AS text FROM documents
  UNION ALL SELECT -2 * doc_id - 1, '   ' FROM documents WHERE doc_id % 9 = 0
  UNION ALL SELECT -2 * doc_id - 2, chr(10) FROM documents WHERE doc_id % 10 = 0)"""

BLOG = "https://blog.example.net"
TITLE = UNESC("regexp_extract(html, '<h1[^>]*>([^<]*)', 1)")
ME = "https://me.example.net"

NAV_CTE = rf"""
nav AS (
  SELECT page_id, url, regexp_extract(html, '<nav[^>]*>(.*?)</nav>', 1) AS nav FROM pages),
li AS (
  SELECT page_id, url, lst FROM (
    SELECT page_id, url, regexp_extract_all(nav, '<li[^>]*>(.*?)</li>', 1) AS lst FROM nav)),
items AS (
  SELECT page_id, url, unnest(lst) AS item, generate_subscripts(lst, 1) - 1 AS pos FROM li),
links AS (
  SELECT page_id, url, CAST(pos AS INTEGER) AS pos,
         {UNESC("regexp_extract(item, '<a[^>]*>([^<]*)', 1)")} AS label,
         {UNESC("regexp_extract(item, 'href=\"([^\"]*)\"', 1)")} AS href
  FROM items WHERE pos > 0),
navl AS (
  SELECT page_id, url, pos, label, href,
         CASE WHEN href LIKE '%blockchain%' OR href LIKE '%ai%' OR href LIKE '%cloud%' THEN href
              ELSE {ORIGIN("url")} || href END AS target
  FROM links WHERE href NOT LIKE '%watchers%')
"""

HREFS_CTE = r"""
hl AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS lst FROM pages),
hrefs AS (SELECT page_id, url, unnest(lst) AS href, CAST(generate_subscripts(lst, 1) - 1 AS INTEGER) AS pos FROM hl)
"""

PROFILE = rf"""
WITH c AS (
  SELECT c_custkey AS k, c.*,
    CASE WHEN c_custkey % 7 = 0 THEN 'missing asideProfile'
         WHEN c_custkey % 11 = 0 THEN 'badge without title'
         WHEN c_custkey % 13 = 0 THEN 'page size 0' END AS reason
  FROM customer c)
SELECT k AS page_id,
  CASE WHEN reason IS NULL THEN c_name END AS name,
  CASE WHEN reason IS NULL THEN CAST(k AS VARCHAR) END AS creates,
  CASE WHEN reason IS NULL THEN CAST(c_nationkey AS VARCHAR) END AS fans,
  CASE WHEN reason IS NULL THEN CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS praises,
  CASE WHEN reason IS NULL THEN c_mktsegment END AS comments,
  CASE WHEN reason IS NULL THEN CAST(k * 3 AS VARCHAR) END AS visits,
  CASE WHEN reason IS NULL THEN left(c_mktsegment, 1) END AS grade,
  CASE WHEN reason IS NULL THEN (CASE WHEN k % 5 = 0 THEN 0 ELSE CAST(floor(c_acctbal * 100) AS BIGINT) END) END AS credits,
  CASE WHEN reason IS NULL THEN CAST(k + 1000 AS BIGINT) END AS ranks,
  CASE WHEN reason IS NULL THEN c_mktsegment || '/n' || c_nationkey END AS badges,
  '{BLOG}/u' || k AS url,
  CASE WHEN reason IS NULL THEN CAST(k % 97 AS BIGINT) END AS list_total,
  CASE WHEN reason IS NULL THEN CAST(20 AS BIGINT) END AS page_size,
  CASE WHEN reason IS NULL THEN CAST((k % 97 + 19) // 20 AS BIGINT) END AS page_count,
  reason AS reject_reason
FROM c
"""

ARTICLE = rf"""
WITH o AS (
  SELECT o_orderkey AS k, o.*,
    CASE WHEN o_orderkey % 11 = 0 THEN 'missing h1'
         WHEN o_orderkey % 17 = 0 THEN 'no read count' END AS reason
  FROM orders o)
SELECT k AS page_id,
  CASE WHEN reason IS NULL THEN 'Order ' || k || ' ' || o_orderpriority END AS title,
  CASE WHEN reason IS NULL THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS create_time,
  CASE WHEN reason IS NULL THEN CAST(k * 37 % 1000 AS VARCHAR) END AS read_count,
  CASE WHEN reason IS NULL THEN (CASE WHEN o_orderstatus = 'O' THEN '原创' ELSE '转载' END) END AS nature,
  CASE WHEN reason IS NULL THEN '<div id="content_views" class="markdown_views"><p>' || o_orderpriority
       || '</p><p>' || CAST(floor(o_totalprice * 100) AS BIGINT) || '<br></p></div>' END AS content,
  CASE WHEN reason IS NULL THEN CAST(o_custkey % 100 AS VARCHAR) END AS praises,
  CASE WHEN reason IS NULL THEN (CASE WHEN k % 4 = 0 THEN '0' ELSE CAST(k % 50 AS VARCHAR) END) END AS comments,
  '{BLOG}/u' || o_custkey || '/article/details/' || k AS url,
  CASE WHEN reason IS NULL THEN 'u' || o_custkey END AS user_name,
  reason AS reject_reason
FROM o
"""


def _grouped_orders(select_cols: str) -> str:
    return rf"""
SELECT CAST(o_orderkey // 20 AS BIGINT) AS page_id, '{BLOG}/list/' || (o_orderkey // 20) AS url,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
  {select_cols}
FROM orders"""


ORACLE = {
    "page_scan": "SELECT page_id, url, html FROM pages",
    "content_projection": "SELECT html AS content FROM pages",
    "strip_markup": f"SELECT page_id, {STRIP_MARKUP('html')} AS text FROM {PAGES}",
    "drop_blank": f"SELECT doc_id, text FROM (SELECT doc_id, {STRIP_MARKUP('text')} AS text FROM {DOCS}) "
                  "WHERE text IS NOT NULL AND trim(text) <> ''",
    "json_corpus": f"SELECT doc_id, text FROM (SELECT doc_id, {STRIP_MARKUP('text')} AS text FROM {DOCS}) "
                   "WHERE text IS NOT NULL AND trim(text) <> ''",
    "wholetext_scan": "SELECT regexp_replace(text, '\\r\\n?', chr(10), 'g') AS text FROM documents",
    "wholetext_lines": "SELECT unnest(string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10))) AS line "
                       "FROM documents",
    "per_file_outputs": "SELECT 'd' || doc_id AS file_name, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS text FROM documents",
    "set_members": "SELECT DISTINCT event_type AS meta, 'u' || user_id AS key FROM events WHERE event_type = 'error'",
    "sql_single_row": "SELECT count(*) AS n_pages, count(DISTINCT url) AS n_urls, "
                      "CAST(sum(length(html)) AS BIGINT) AS n_chars FROM pages",
    "visit_key": f"SELECT page_id, url, {KEY('url')} AS key FROM pages WHERE {ELIGIBLE('url')}",
    "follow_url": f"SELECT page_id, url, {FOLLOW('url')} AS follow_url FROM pages",
    "resolve_url": f"""WITH {HREFS_CTE}
SELECT page_id, url, pos, 'rooted' AS form, href, {ORIGIN('url')} || href AS resolved FROM hrefs
UNION ALL
SELECT page_id, url, pos, 'relative' AS form, regexp_replace(href, '^/', '') AS href,
  regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') || regexp_replace(href, '^/', '') AS resolved
FROM hrefs""",
    "lenient_int": f"""SELECT o_orderkey,
  {LENIENT('o_orderpriority')} AS prio_whole,
  {LENIENT("split_part(o_orderpriority, '-', 1)")} AS prio_lead,
  {LENIENT("' ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ' '")} AS price_floor,
  {LENIENT("CAST(o_totalprice AS VARCHAR)")} AS price_text
FROM orders""",
    "list_page_urls": f"""WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
c AS (SELECT c_custkey, c_nationkey, coalesce(n.n, 0) AS n FROM customer LEFT JOIN n ON c_custkey = o_custkey),
p AS (SELECT c_custkey, CASE WHEN c_nationkey % 10 > 0 THEN (n + c_nationkey % 10 - 1) // (c_nationkey % 10) END AS pc FROM c),
e AS (SELECT c_custkey, unnest(range(1, coalesce(pc, 0) + 1)) AS i FROM p)
SELECT c_custkey, CAST(i AS INTEGER) AS page_no, '{BLOG}/u' || c_custkey || '/article/list/' || i AS list_url FROM e""",
    "kv_map": "SELECT c_custkey, c_name AS name, c_mktsegment AS seg, 'a=b' AS note, "
              "CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS bal, CAST(4 AS INTEGER) AS n_keys FROM customer",
    "sentence_split": f"""WITH s AS (SELECT doc_id, {SENTENCES('text')} AS lst FROM {DOCS})
SELECT doc_id, CAST(generate_subscripts(lst, 1) - 1 AS INTEGER) AS sent_no, unnest(lst) AS sentence FROM s""",
    "char_tokens": f"""WITH s AS (SELECT doc_id, {SENTENCES('text')} AS lst FROM {DOCS}),
e AS (SELECT doc_id, CAST(generate_subscripts(lst, 1) - 1 AS INTEGER) AS sent_no, unnest(lst) AS sentence FROM s)
SELECT doc_id, sent_no, regexp_replace(regexp_replace(sentence, '[ \\t\\r\\n]+', '', 'g'), '(?s)(.)', '\\1 ', 'g') AS line FROM e""",
    "nav_links": f"WITH {NAV_CTE.replace('FROM pages', 'FROM ' + PAGES)} SELECT page_id, url, pos, label, href, CAST(NULL AS VARCHAR) AS reject_reason, "
                 "target FROM navl",
    "link_edges": f"WITH {NAV_CTE} SELECT url AS src_url, target AS dst_url, 'category' AS kind FROM navl",
    "site_link_edges": f"""WITH ok AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders WHERE o_orderkey % 9 <> 0),
prof AS (SELECT url, page_count FROM ({PROFILE}) WHERE reject_reason IS NULL),
pl AS (SELECT url, unnest(range(1, page_count + 1)) AS i FROM prof)
SELECT '{BLOG}/list/' || (k // 20) AS src_url, '{BLOG}/u' || c || '/article/details/' || k AS dst_url, 'article' AS kind FROM ok
UNION ALL SELECT '{BLOG}/list/' || (k // 20), '{BLOG}/u' || c, 'author' FROM ok
UNION ALL SELECT '{BLOG}/list/' || (k // 20), '{BLOG}/u' || c, 'follow' FROM ok
UNION ALL SELECT '{BLOG}/list/' || (k // 20), '{BLOG}/u' || c || '/article/details/' || k, 'article' FROM ok
UNION ALL SELECT url, url || '/article/list/' || i, 'list' FROM pl""",
    "article_titles": f"SELECT page_id, url, CAST(0 AS INTEGER) AS pos, "
                      f"{TITLE} AS title, "
                      "CAST(NULL AS VARCHAR) AS reject_reason FROM pages",
    "feed_links": _grouped_orders(
        f"CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE '{BLOG}/u' || o_custkey || '/article/details/' || o_orderkey END AS article_href, "
        f"CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE '{BLOG}/u' || o_custkey END AS user_href, "
        "CASE WHEN o_orderkey % 9 = 0 THEN 'missing user link' END AS reject_reason"),
    "user_profile": PROFILE,
    "page_count": f"SELECT url, list_total, page_size, page_count, reject_reason FROM ({PROFILE})",
    "badges_join": f"SELECT url, badges, reject_reason FROM ({PROFILE})",
    "followee_links": _grouped_orders(
        f"CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE '{ME}/u' || o_custkey END AS href, "
        "CASE WHEN o_orderkey % 9 = 0 THEN 'missing a' END AS reject_reason, "
        f"CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE '{BLOG}/u' || o_custkey END AS user_url"),
    "article_list_links": _grouped_orders(
        f"CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE '{BLOG}/u' || o_custkey || '/article/details/' || o_orderkey END AS href, "
        "CASE WHEN o_orderkey % 9 = 0 THEN 'missing h4/a' END AS reject_reason"),
    "article_detail": ARTICLE,
    "read_count": f"SELECT url, read_count, reject_reason FROM ({ARTICLE})",
    "originals_only": f"SELECT url, title, nature FROM ({ARTICLE}) WHERE reject_reason IS NULL AND nature = '原创'",
    "html_table_rows": """SELECT page_id, pos, proxy FROM (
  SELECT CAST(s_suppkey // 20 AS BIGINT) AS page_id,
    CAST(row_number() OVER (PARTITION BY s_suppkey // 20 ORDER BY s_suppkey) AS INTEGER) AS pos,
    'http://' || s_name || ':' || s_nationkey AS proxy, s_suppkey
  FROM supplier) WHERE s_suppkey % 3 <> 0""",
    "json_feed_links": f"""SELECT CAST(o_orderkey // 20 AS BIGINT) AS page_id,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
  '{BLOG}/u' || o_custkey || '/article/details/' || o_orderkey AS url, '{BLOG}/u' || o_custkey AS user_url
FROM orders""",
    "article_info_append": f"SELECT title, create_time, read_count, nature, content, praises, comments, url, user_name "
                           f"FROM ({ARTICLE}) WHERE reject_reason IS NULL",
    "schema_enforce": f"SELECT title, create_time, read_count, nature, content, praises, comments, url, user_name "
                      f"FROM ({ARTICLE}) WHERE reject_reason IS NULL",
    "user_info_append": f"SELECT name, creates, fans, praises, comments, visits, grade, credits, ranks, badges, url "
                        f"FROM ({PROFILE}) WHERE reject_reason IS NULL",
    "article_rejects": f"SELECT url, 'article' AS stage, reject_reason AS reason, CAST(0 AS INTEGER) AS attempt "
                       f"FROM ({ARTICLE}) WHERE reject_reason IS NOT NULL",
    "challenge_split": "SELECT page_id, CASE WHEN html LIKE '%spam-farm%' THEN 'retry' ELSE 'content' END AS route, "
                       "CAST(CASE WHEN html LIKE '%spam-farm%' THEN 1 ELSE 0 END AS INTEGER) AS next_attempt FROM pages",
    "severity_route": "SELECT event_id, event_type AS level, CASE WHEN lower(event_type) = 'error' THEN 'error' "
                      "ELSE 'main' END AS sink FROM events",
    "mark_after_write": f"SELECT DISTINCT 'blog' AS meta, {KEY('url')} AS key, CAST(1 AS BIGINT) AS n_stored FROM pages WHERE {ELIGIBLE('url')}",
    "last_by_title": """SELECT title, page_id, content FROM (
  SELECT regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, page_id, html AS content,
    row_number() OVER (PARTITION BY regexp_extract(html, '<title>([^<]*)</title>', 1) ORDER BY page_id DESC) AS rn
  FROM pages) WHERE rn = 1""",
    "first_seen": """SELECT meta, key, first_event_id FROM (
  SELECT event_type AS meta, 'u' || user_id AS key, event_id AS first_event_id,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""",
    "forget_keys": """SELECT DISTINCT event_type AS meta, 'u' || user_id AS key FROM events
EXCEPT SELECT event_type, 'u' || user_id FROM events WHERE event_type = 'error' AND value >= 50""",
    "is_member": "SELECT doc_id, 'blog' AS meta, 'd' || doc_id AS key, "
                 "doc_id IN (SELECT doc_id FROM labels) AS is_member FROM documents",
    "reconcile_visited": "SELECT DISTINCT 'blog' AS meta, 'd' || doc_id AS key, CASE WHEN doc_id IN "
                         "(SELECT doc_id FROM labels) THEN 'kept' ELSE 'stale' END AS status FROM documents",
    "rekey_visited": f"SELECT DISTINCT 'blog' AS meta, {STRIP_KEY('url')} AS key FROM pages",
    "frontier_union": f"""WITH {HREFS_CTE},
f AS (
  SELECT 'blog' AS meta, url, page_id, -2 AS pos FROM pages
  UNION ALL SELECT 'user', {FOLLOW('url')}, page_id, -1 FROM pages
  UNION ALL SELECT 'blog', {ORIGIN('url')} || href, page_id, pos FROM hrefs),
k AS (SELECT meta, url, page_id, pos, {KEY('url')} AS key FROM f WHERE url IS NOT NULL AND url <> '' AND {ELIGIBLE('url')})
SELECT meta, key, url FROM (
  SELECT meta, key, url, row_number() OVER (PARTITION BY meta, key ORDER BY page_id, pos) AS rn FROM k) WHERE rn = 1""",
    "crawl_closure": """WITH RECURSIVE
e0 AS (SELECT DISTINCT 's' || l_suppkey AS a, 'p' || l_partkey AS b FROM lineitem),
e AS (SELECT a AS src, b AS dst FROM e0 UNION SELECT b, a FROM e0),
seed AS (SELECT 's' || min(l_suppkey) AS node FROM lineitem),
r(node, depth) USING KEY (node) AS (
  SELECT node, 0 FROM seed
  UNION
  SELECT DISTINCT e.dst, r.depth + 1 FROM r JOIN e ON r.node = e.src
  WHERE NOT EXISTS (SELECT 1 FROM recurring.r AS s WHERE s.node = e.dst))
SELECT node, CAST(depth AS INTEGER) AS depth FROM r""",
    "corpus_tokens": f"""WITH d AS (SELECT doc_id, text FROM (SELECT doc_id, {STRIP_MARKUP('text')} AS text FROM documents)
  WHERE text IS NOT NULL AND trim(text) <> ''),
s AS (SELECT doc_id, {SENTENCES('text')} AS lst FROM d),
e AS (SELECT doc_id, CAST(generate_subscripts(lst, 1) - 1 AS INTEGER) AS sent_no, unnest(lst) AS sentence FROM s)
SELECT doc_id, sent_no, regexp_replace(regexp_replace(sentence, '[ \\t\\r\\n]+', '', 'g'), '(?s)(.)', '\\1 ', 'g') AS line FROM e""",
    "visited_refresh": "SELECT DISTINCT 'blog' AS meta, 'd' || doc_id AS key FROM documents "
                       "WHERE doc_id IN (SELECT doc_id FROM labels)",
    "crawl_articles": f"SELECT title, create_time, read_count, nature, content, praises, comments, url, user_name "
                      f"FROM ({ARTICLE}) WHERE reject_reason IS NULL AND page_id NOT IN "
                      "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    "crawl_visited": f"""SELECT 'blog' AS meta, 'u' || o_custkey || '/article/details/' || o_orderkey AS key
FROM orders WHERE o_orderstatus = 'F'
UNION
SELECT 'blog', string_split(url, '.net/')[2] FROM ({ARTICLE}) WHERE reject_reason IS NULL""",
    "stream_extract": f"SELECT page_id, url, CAST(0 AS INTEGER) AS pos, "
                      f"{TITLE} AS title, "
                      "CAST(NULL AS VARCHAR) AS reject_reason FROM pages",
    "stream_first_seen": "SELECT DISTINCT event_type AS meta, 'u' || user_id AS key FROM events",
    "stream_left_anti": """SELECT event_id, user_id, event_type AS level,
  CASE WHEN lower(event_type) = 'error' THEN 'error' ELSE 'main' END AS sink
FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment = 'BUILDING' AND c.c_custkey = e.user_id)""",
}

ORACLE["site_closure"] = f"""WITH RECURSIVE
e AS (SELECT DISTINCT src_url AS src, dst_url AS dst FROM ({ORACLE['site_link_edges']})),
r(node, depth) USING KEY (node) AS (
  SELECT '{BLOG}/list/1', 0
  UNION
  SELECT DISTINCT e.dst, r.depth + 1 FROM r JOIN e ON r.node = e.src
  WHERE NOT EXISTS (SELECT 1 FROM recurring.r AS s WHERE s.node = e.dst))
SELECT node AS url, CAST(depth AS INTEGER) AS depth FROM r"""

ORACLE["append_twice"] = f"""SELECT CASE WHEN o_orderstatus = 'F' THEN '0' ELSE '1' END AS batch, url, title
FROM ({ARTICLE}) JOIN orders ON page_id = o_orderkey WHERE reject_reason IS NULL"""

ORACLE["crawl_rejects"] = f"""SELECT CASE WHEN page_id % 19 = 0 THEN 'ftp' || substr(url, 6) ELSE url END AS url,
  CASE WHEN page_id % 19 = 0 THEN 'url' WHEN page_id % 23 = 0 THEN 'fetch' ELSE 'article' END AS stage,
  CASE WHEN page_id % 19 = 0 THEN 'ineligible URL' WHEN page_id % 23 = 0 THEN 'challenge page' ELSE reject_reason END AS reason,
  CAST(CASE WHEN page_id % 23 = 0 THEN 1 ELSE 0 END AS INTEGER) AS attempt
FROM ({ARTICLE}) WHERE page_id % 19 = 0 OR page_id % 23 = 0 OR reject_reason IS NOT NULL"""

ORACLE["retry_rounds"] = """SELECT CAST(1 AS INTEGER) AS round, page_id, CASE WHEN page_id % 4 < 2 THEN 'retry' ELSE 'content' END AS route,
  CAST(CASE WHEN page_id % 4 < 2 THEN 1 ELSE 0 END AS INTEGER) AS next_attempt FROM pages
UNION ALL SELECT 2, page_id, CASE WHEN page_id % 4 = 0 THEN 'retry' ELSE 'content' END, CASE WHEN page_id % 4 = 0 THEN 2 ELSE 1 END
FROM pages WHERE page_id % 4 < 2
UNION ALL SELECT 3, page_id, 'reject', 3 FROM pages WHERE page_id % 4 = 0"""
ORACLE["stream_retry_rounds"] = ORACLE["retry_rounds"]
ORACLE["sql_rows"] = """SELECT d.source, l.quality, count(*) AS n, CAST(sum(length(d.text)) AS BIGINT) AS n_chars
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source, l.quality"""
ORACLE["is_member_filtered"] = ORACLE["is_member"]
