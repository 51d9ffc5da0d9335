"""String helpers with JVM ``String`` semantics, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JVM String.trim strips every char <= U+0020; Spark's default trim only
# strips spaces. ``trim(chars FROM s)`` with that char set is a plain scan.
_EDGE_CHARS = "".join(chr(i) for i in range(0x21))


def jtrim(c: Column | str) -> Column:
    """``String.trim`` of the JVM: strip all control chars and spaces at both ends."""
    return F.trim(_col(c), F.lit(_EDGE_CHARS))


def null_to_empty_trim(c: Column | str) -> Column:
    """null -> '' then trim."""
    return jtrim(F.coalesce(_col(c), F.lit("")))


def normalize_platform(c: Column | str) -> Column:
    """trim + lowercase; ``iphone`` becomes ``ios``. null stays null."""
    p = F.lower(jtrim(_col(c)))
    return F.when(p == "iphone", F.lit("ios")).otherwise(p)


def is_blank(c: Column | str) -> Column:
    """null, empty, or only chars <= U+0020."""
    return jtrim(F.coalesce(_col(c), F.lit(""))) == ""


def java_split(c: Column | str, pattern: str) -> Column:
    """``String.split(regex)`` with limit 0: trailing empty strings are dropped.

    Spark's ``split`` keeps them, so the trailing run of separators is removed
    first. ``pattern`` must be a single-char regex (what the jobs use). Like
    the JVM, ``''`` gives ``['']`` and a run of separators gives ``[]``.
    """
    raw = _col(c)
    s = F.regexp_replace(raw, f"(?:{pattern})+\\z", "")
    return (F.when(raw == "", F.array(F.lit("")))
            .when(s == "", F.array().cast("array<string>"))
            .otherwise(F.split(s, pattern, -1)))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
