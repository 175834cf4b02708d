"""Lenient number rules as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width digits read as their ASCII counterparts.
FULL_WIDTH_DIGITS = "０１２３４５６７８９"
ASCII_DIGITS = "0123456789"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c, default: int | None = 0) -> Column:
    """M1: ``int(text)`` or ``default`` when the text is not an integer.

    Accepted like Python's ``int``: blank space around, a sign, ASCII or
    full-width digits, single ``_`` between digits.  Not accepted:
    ``12.0``, ``18万+``, empty.  Values outside BIGINT give ``default``.
    """
    trimmed = F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")  # Unicode blank space, as int() strips
    x = F.translate(trimmed, FULL_WIDTH_DIGITS, ASCII_DIGITS)
    ok = x.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$")
    val = F.when(ok, F.replace(x, F.lit("_"), F.lit("")).try_cast("bigint"))
    return val if default is None else F.coalesce(val, F.lit(default).cast("bigint"))


def ceil_div(total, size) -> Column:
    """M2: pages = ceil(total / size); null (reject) when size is 0 or a
    side is null or negative."""
    t, s = _c(total).cast("bigint"), _c(size).cast("bigint")
    q = F.floor((t + s - 1).cast("decimal(38,0)") / s.cast("decimal(38,0)"))  # exact, no double
    return F.when((s > 0) & (t >= 0), q.cast("bigint"))


def blank_to_zero(c) -> Column:
    """M3: ``""`` -> ``"0"`` (after trimming ``\\r\\n\\t`` and space)."""
    x = F.btrim(_c(c), F.lit("\r\n\t "))
    return F.when(x == "", F.lit("0")).otherwise(x)
