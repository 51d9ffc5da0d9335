"""Document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_key(uid: Column | str, deviceid: Column | str, eventid: Column | str,
              begintime: Column | str) -> Column:
    """md5 hex of ``uid + deviceid + eventid + begintime`` with no separator.

    Numbers are unboxed (null reads 0); a null device concatenates as the
    text ``null`` (JVM string concatenation), so ``concat`` never sees a null.
    """
    return F.md5(F.concat(
        F.coalesce(_col(uid).cast("long"), F.lit(0)).cast("string"),
        F.coalesce(_col(deviceid), F.lit("null")),
        F.coalesce(_col(eventid).cast("int"), F.lit(0)).cast("string"),
        F.coalesce(_col(begintime).cast("long"), F.lit(0)).cast("string"),
    ))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
