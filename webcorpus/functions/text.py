"""Text rules as native Column expressions (whole-stage codegen, no Python).

Every function takes and returns a ``Column``.  Patterns use Java regex
flags: ``(?d)`` (UNIX_LINES) makes ``.``, ``^`` and ``$`` treat only
``\\n`` as a line break, which is how a line-by-line Python loop sees text;
``(?U)`` makes ``\\s`` and ``\\d`` Unicode-aware, as they are in Python 3.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original cleaning and parsing rules.
DISPLAY_MATH = r'<span\s+class="katex--display">.*?</span><br/>'
TAG = r"<.*?>"
READ_COUNT_LABEL = "阅读数"

# Our explicit sentence rule (the original used a trained model).
CJK_STOPS = "。！？"
LATIN_STOPS = ".!?"
_BLANK_CLASS = r" \t\r\n"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_newlines(c) -> Column:
    """``\\r\\n`` and lone ``\\r`` to ``\\n`` (what Python text mode reads)."""
    return F.regexp_replace(_c(c), r"\r\n?", "\n")


def remove_display_math(c) -> Column:
    """Drop ``<span class="katex--display">…</span><br/>`` within a line."""
    return F.regexp_replace(_c(c), "(?dU)" + DISPLAY_MATH, "")


def strip_tags(c) -> Column:
    """Drop every ``<…>`` within a line, shortest match; entities stay."""
    return F.regexp_replace(_c(c), "(?d)" + TAG, "")


def strip_line_spaces(c) -> Column:
    """``line.strip(" ")`` on lines that keep their ``\\n``: leading
    spaces of every line go, trailing spaces only on a last line that
    has no newline."""
    return F.regexp_replace(_c(c), r"(?dm)^ +| +\z", "")


def strip_markup(c, newline_mode: bool = True) -> Column:
    """T1 -> T2 -> T3, in that order, per document."""
    x = normalize_newlines(c) if newline_mode else _c(c)
    return strip_line_spaces(strip_tags(remove_display_math(x)))


def trim_chars(c, chars: str = "\n\t ") -> Column:
    """T4: strip a character set at both ends (``str.strip(chars)``)."""
    return F.btrim(_c(c), F.lit(chars))


def is_not_blank(c) -> Column:
    """A document is blank when only spaces remain after ``strip(" ")``;
    a newline-only text is kept.  Null texts are dropped as well."""
    x = _c(c)
    return x.isNotNull() & (F.trim(x) != "")


def first_char(c) -> Column:
    """First code point; empty string -> null (the record is rejected)."""
    x = _c(c)
    return F.when(F.length(x) > 0, F.substring(x, 1, 1))


def join_titles(arr, sep: str = "/") -> Column:
    """Join with ``sep`` and no trailing separator; any null element
    makes the whole value null (the record is rejected)."""
    a = _c(arr)
    return F.when(F.exists(a, lambda x: x.isNull()), F.lit(None)).otherwise(F.array_join(a, sep))


def read_count(c) -> Column:
    """T5: digits after the read-count label; ``""`` when the label is
    followed by no digits; null when the label is missing (reject)."""
    x = _c(c)
    # (?U): \s and \d are Unicode-aware, as in Python 3 (U+3000, full-width digits)
    pat = "(?U)(?<=" + READ_COUNT_LABEL + r")\s*(\d*)"
    return F.when(x.rlike(pat), F.regexp_extract(x, pat, 1))


def sentences(c) -> Column:
    """Split into sentences.  A sentence ends after one of ``。！？``,
    or after one of ``.!?`` that is followed by blank space.  Pieces are
    trimmed of blank space and empty pieces are dropped, so positions are
    dense.  Returns ``ARRAY<STRING>``."""
    x = _c(c)
    blank = f"[{_BLANK_CLASS}]"
    marked = F.regexp_replace(x, f"([{CJK_STOPS}])", "$1\u0001")
    marked = F.regexp_replace(marked, f"([{re.escape(LATIN_STOPS)}]){blank}+", "$1\u0001")
    parts = F.split(marked, "\u0001")
    trimmed = F.transform(parts, lambda s: F.regexp_replace(s, f"^{blank}+|{blank}+$", ""))
    return F.filter(trimmed, lambda s: s != "")


def char_line(c) -> Column:
    """Every non-blank character of a sentence followed by one space."""
    return F.regexp_replace(F.regexp_replace(_c(c), f"[{_BLANK_CLASS}]+", ""), "(?s)(.)", "$1 ")


def kv_map(c) -> Column:
    """``k=v; k=v`` text to ``MAP<STRING,STRING>``.  Items are split on
    ``;`` with blank space around it removed, each on its first ``=``;
    a repeated key keeps its last value (session policy LAST_WIN)."""
    x = F.btrim(_c(c), F.lit("\n\t ;"))
    return F.str_to_map(F.regexp_replace(x, r"(?U)\s*;\s*", ";"), F.lit(";"), F.lit("="))

