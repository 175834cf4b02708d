"""URL rules: visit keys, eligibility, follow-page URLs, resolution.

Everything is a native expression.  Patterns that meet whole URLs repeat
single characters only, never groups, so a hostile URL of any length costs
time in proportion and no stack.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's rules.
KEY_SUFFIX = ".net/"
ALLOWED_SCHEMES = ("http", "https")
NO_RESOLVE_WORDS = ("blockchain", "ai", "cloud")
SKIP_HREF_WORD = "watchers"
# Schemes whose references are resolved, and those whose last path segment may carry parameters.
RELATIVE_SCHEMES = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero",
                    "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")

DOT_BLOCK = 256  # path segments folded at once when dot segments are removed
# characters that a compatibility form turns into a delimiter of URLs: no host may hold them
_DELIMITER_FORMS = "".join(c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)])
                           if set(unicodedata.normalize("NFKC", c)) & set("/?#@:"))
_HEX = "[0-9A-Fa-f]"
_V4 = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
_BRACKETED = (rf"^(?:v{_HEX}+\..+|(?:(?:{_HEX}{{1,4}}:){{7}}{_HEX}{{1,4}}|(?:{_HEX}{{1,4}}:){{6}}{_V4}"
              rf"|(?!.*::.*::)(?!:[^:])(?=.*::)(?:{_HEX}{{0,4}}:){{2,7}}(?:{_HEX}{{0,4}}|{_V4}))(?:%[^%]+)?)$")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_regex(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)


def has_http_scheme(url) -> Column:
    """Scheme is http or https, any case (``urlparse`` lower-cases it)."""
    return _c(url).rlike("^(?i)https?:")


def is_eligible(url, suffix: str = KEY_SUFFIX) -> Column:
    """http(s) scheme and exactly one ``suffix`` in the URL."""
    u = _c(url)
    return (u.isNotNull() & has_http_scheme(u)
            & (F.size(F.split(u, _lit_regex(suffix))) == 2))


def visit_key(url, suffix: str = KEY_SUFFIX) -> Column:
    """The text after ``suffix`` (scheme and host dropped, path, query
    and fragment kept); null for ineligible URLs."""
    u = _c(url)
    return F.when(is_eligible(u, suffix), F.get(F.split(u, _lit_regex(suffix)), 1))


def strip_key_prefix(key, suffix: str = KEY_SUFFIX) -> Column:
    """D5 helper: a stored full URL becomes its key; a value that has no
    ``suffix`` (already a key) is left as it is."""
    k = _c(key)
    parts = F.split(k, _lit_regex(suffix))
    return F.when(F.size(parts) == 2, F.get(parts, 1)).otherwise(k)


def follow_url(url, literal: bool = False) -> Column:
    """U4: author page URL -> follow-list URL.

    ``https://blog.h/a/u`` -> ``https://me.h/follow/u``: the ``blog`` host
    label becomes ``me``, the URL is split at its last ``/`` and
    ``follow/<last>`` is resolved against the part before it (``urljoin``:
    the second-to-last path segment is replaced, the scheme is reported in
    lower case).  ``literal=True`` replaces every ``blog`` in the URL, as a
    plain ``str.replace`` would.

    Null for a text without any ``/``.
    """
    base, href = follow_parts(url, literal)
    return resolve_url(base, href)


def follow_parts(url, literal: bool = False) -> tuple[Column, Column]:
    """U4 as the (base, relative reference) whose resolution is the follow URL."""
    u = _c(url)
    me = (F.replace(u, F.lit("blog"), F.lit("me")) if literal
          else F.regexp_replace(u, r"^([A-Za-z][A-Za-z0-9+.\-]*://)blog\.", "$1me."))
    last = F.substring_index(me, "/", -1)
    base = F.when(me.contains("/"), F.substring(me, F.lit(1), F.length(me) - F.length(last) - 1))
    return base, F.concat(F.lit("follow/"), last)


def origin(url) -> Column:
    """``scheme://host[:port]`` of an absolute URL."""
    return F.regexp_extract(_c(url), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _cut(text: Column, mark: str) -> tuple[Column, Column]:
    """The text before and after the first ``mark`` (all of it and nothing without one)."""
    at = F.instr(text, mark)
    return (F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text),
            F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(F.lit("")))


def _parts(url: Column, scheme: Column) -> Column:
    """scheme (``scheme`` if the URL has none), netloc, path, params, query, fragment of a URL, and whether its host is valid."""
    clean = F.translate(F.regexp_replace(url, r"^[\x00-\x20]++", ""), "\t\r\n", "")

    def split(u: Column) -> Column:
        own = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*+):", 1)
        rest = F.when(own != "", F.substring(u, F.length(own) + 2, F.length(u))).otherwise(u)
        return F.struct(F.when(own != "", F.lower(own)).otherwise(scheme).alias("scheme"), rest.alias("rest"))

    def host(x: Column) -> Column:
        netloc = F.regexp_extract(x["rest"], r"^//([^/?#]*+)", 1)
        rest = F.when(x["rest"].startswith("//"), F.substring(x["rest"], F.length(netloc) + 3, F.length(x["rest"]))).otherwise(x["rest"])
        return F.struct(x["scheme"].alias("scheme"), netloc.alias("netloc"), rest.alias("rest"))

    def tail(x: Column) -> Column:
        rest, fragment = _cut(x["rest"], "#")
        return F.struct(x["scheme"].alias("scheme"), x["netloc"].alias("netloc"), rest.alias("rest"), fragment.alias("fragment"))

    def params(x: Column) -> Column:
        path, query = _cut(x["rest"], "?")
        return F.struct(x["scheme"].alias("scheme"), x["netloc"].alias("netloc"), path.alias("path"), query.alias("query"), x["fragment"].alias("fragment"))

    def whole(x: Column) -> Column:
        path, netloc = x["path"], x["netloc"]
        last = F.substring_index(path, "/", -1)
        at = F.when(x["scheme"].isin(*PARAM_SCHEMES), F.instr(last, ";")).otherwise(0)
        opened, closed = netloc.contains("["), netloc.contains("]")
        inner = F.substring_index(F.substring_index(F.substring(netloc, F.instr(netloc, "[") + 1, F.length(netloc)), "]", 1), "]", 1)
        valid = F.when(opened | closed, opened & closed & inner.rlike(_BRACKETED)).otherwise(True) & ~netloc.rlike("[" + re.escape(_DELIMITER_FORMS) + "]")
        return F.struct(
            x["scheme"].alias("scheme"), netloc.alias("netloc"),
            F.when(at > 0, F.substring(path, F.lit(1), F.length(path) - F.length(last) + at - 1)).otherwise(path).alias("path"),
            F.when(at > 0, F.substring(last, at + 1, F.length(last))).otherwise(F.lit("")).alias("params"),
            x["query"].alias("query"), x["fragment"].alias("fragment"), valid.alias("valid"))

    return _let(_let(_let(_let(_let(clean, split), host), tail), params), whole)


def _without_dots(segments: Column) -> Column:
    """RFC 3986's removal of ``.`` and ``..`` from an array of path segments.

    A fold over blocks of segments, each folded by itself into the number of
    segments it takes from what stands before it and those it leaves; a
    path of n segments costs some n * sqrt(n) steps at worst."""
    def step(acc: Column, seg: Column) -> Column:
        up, kept = acc["up"], acc["kept"]
        held = F.size(kept) > 0
        return (F.when(seg == ".", acc)
                .when((seg == "..") & held, F.struct(up.alias("up"), F.slice(kept, F.lit(1), F.size(kept) - 1).alias("kept")))
                .when(seg == "..", F.struct((up + 1).alias("up"), kept.alias("kept")))
                .otherwise(F.struct(up.alias("up"), F.concat(kept, F.array(seg)).alias("kept"))))

    nothing = F.struct(F.lit(0).alias("up"), F.lit([]).cast("array<string>").alias("kept"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(segments) - 1) / DOT_BLOCK).cast("int")),
                         lambda b: F.aggregate(F.slice(segments, b * DOT_BLOCK + 1, F.lit(DOT_BLOCK)), nothing, step))
    joined = F.aggregate(blocks, F.lit([]).cast("array<string>"), lambda acc, b: F.concat(
        F.slice(acc, F.lit(1), F.greatest(F.size(acc) - b["up"], F.lit(0))), b["kept"]))
    last = F.element_at(segments, -1)
    return F.when(last.isin(".", ".."), F.concat(joined, F.array(F.lit("")))).otherwise(joined)


def _merged(base: Column, ref: Column) -> Column:
    """Path of a reference that has one, resolved against the base's path."""
    own = F.split(ref["path"], "/")
    above = F.split(base["path"], "/")
    above = F.when(F.element_at(above, -1) != "", F.slice(above, F.lit(1), F.size(above) - 1)).otherwise(above)
    both = _let(F.concat(above, own), lambda p: F.filter(p, lambda seg, i: (seg != "") | (i == 0) | (i == F.size(p) - 1)))
    segments = F.when(ref["path"].startswith("/"), own).otherwise(both)
    done = _let(segments, lambda p: F.when(F.arrays_overlap(p, F.array(F.lit("."), F.lit(".."))), _without_dots(p)).otherwise(p))
    return _let(F.array_join(done, "/"), lambda path: F.when(path == "", F.lit("/")).otherwise(path))


def _unsplit(scheme: Column, netloc: Column, path: Column, params: Column, query: Column, fragment: Column) -> Column:
    """The URL of its parts; a scheme is one of :data:`RELATIVE_SCHEMES`."""
    def behind(mark: str, part: Column) -> Column:
        return F.when(part != "", F.concat(F.lit(mark), part)).otherwise(F.lit(""))

    def written(p: Column) -> Column:
        rooted = (F.when(netloc != "", F.concat(F.lit("//"), netloc, F.when((p != "") & ~p.startswith("/"), F.lit("/")).otherwise(F.lit("")), p))
                  .when(p.startswith("//") | ((scheme != "") & ((p == "") | p.startswith("/"))), F.concat(F.lit("//"), p)).otherwise(p))
        return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")), rooted, behind("?", query), behind("#", fragment))

    return _let(F.concat(path, behind(";", params)), written)


def _joined(base: Column, href: Column) -> Column:
    """``href`` resolved against ``base``, both not empty."""
    def resolved(x: Column) -> Column:
        b, r = x["b"], x["r"]
        same = r["path"].eqNullSafe("") & (r["params"] == "")
        path = F.when(r["netloc"] != "", r["path"]).when(same, b["path"]).otherwise(_merged(b, r))
        own_params = F.when((r["netloc"] == "") & same, b["params"]).otherwise(r["params"])
        query = F.when((r["netloc"] == "") & same & (r["query"] == ""), b["query"]).otherwise(r["query"])
        netloc = F.when(r["netloc"] != "", r["netloc"]).otherwise(b["netloc"])
        return (F.when(~b["valid"] | ~r["valid"], F.lit(None).cast("string"))
                .when((r["scheme"] != b["scheme"]) | ~r["scheme"].isin(*RELATIVE_SCHEMES), href)
                .otherwise(_unsplit(r["scheme"], netloc, path, own_params, query, r["fragment"])))

    parsed = _let(_parts(base, F.lit("")), lambda b: F.struct(b.alias("b"), _parts(href, b["scheme"]).alias("r")))
    return _let(parsed, resolved)


def resolve_url(base, href) -> Column:
    """RFC 3986 resolution of ``href`` against ``base``, as ``urljoin`` gives it.

    Null for a null side and where ``urljoin`` raises (a host with an invalid
    address in brackets, or characters whose compatibility form is a
    delimiter).  Three plain forms are answered without parsing: an
    absolute http(s) href, a rooted one and a plain relative path, none of
    them with dot segments, parameters or empty parts.
    """
    b, h = _c(base), _c(href)
    dots = h.rlike(r"(^|/)\.\.?(/|$|\?|#)")
    tail = r"(\?[^#\s]++)?+(#\S++)?+\z"
    host = r"[A-Za-z0-9.\-_~:@!$&'()*+,=%]"
    absolute = (h.rlike(rf"^https?://{host}++(/[^?#;\s]*+)?+" + tail) & ~dots
                & ~b.rlike("[\\[\\]" + re.escape(_DELIMITER_FORMS) + "]"))
    rooted = (h.rlike(r"^(/|/[^/?#;\s][^?#;\s]*+)" + tail) & ~dots
              & b.rlike(rf"^https?://{host}++([/?#]|\z)"))
    chars = r"A-Za-z0-9_~%@!$&'()*+,=\-"
    relative = (h.rlike(rf"^[{chars}][{chars}./]*+" + tail) & ~F.substring_index(F.substring_index(h, "#", 1), "?", 1).contains("//") & ~dots
                & b.rlike(rf"^https?://{host}++(/[{chars}./]*+)?+\z") & ~F.substring(b, 9, 1 << 30).contains("//")
                & ~b.rlike(r"/\.\.?(/|\z)"))
    last = F.substring_index(b, "/", -1)
    parent = F.when(b.rlike(r"^https?://[^/]++\z"), F.concat(b, F.lit("/"))).otherwise(F.substring(b, F.lit(1), F.length(b) - F.length(last)))
    return (F.when(h.isNull() | b.isNull(), F.lit(None).cast("string"))
            .when(b == "", h).when(h == "", b)
            .when(absolute, h)
            .when(rooted, F.concat(origin(b), h))
            .when(relative, F.concat(parent, h))
            .otherwise(_joined(b, h)))


def nav_target(base, href) -> Column:
    """X1 link rule: hrefs containing one of ``NO_RESOLVE_WORDS`` (a plain
    substring test) stay as written; all others are resolved."""
    h = _c(href)
    keep = None
    for w in NO_RESOLVE_WORDS:
        t = h.contains(w)
        keep = t if keep is None else (keep | t)
    return F.when(keep, h).otherwise(resolve_url(base, h))
