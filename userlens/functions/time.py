"""Time columns. Everything renders in the session time zone (UTC in tests)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output formats of the documents.
DAY_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds to TIMESTAMP; a null reads as 0 (JVM unboxing)."""
    return F.timestamp_millis(F.coalesce(_col(ms), F.lit(0)).cast("long"))


def ts_to_epoch_ms(ts: Column | str) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ to floored epoch milliseconds."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def day_string(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DAY_FORMAT)


def time_string(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TIME_FORMAT)


def epoch_ms_time_string(ms: Column | str) -> Column:
    """Epoch ms to ``yyyy-MM-dd HH:mm:ss``; null ms prints as epoch 0."""
    return time_string(epoch_ms_to_ts(ms))


def event_clock(begintime: Column | str) -> dict[str, Column]:
    """``hour``, ``minute`` and ``eventtime`` of an epoch-ms event time."""
    ts = epoch_ms_to_ts(begintime)
    return {
        "hour": F.hour(ts).cast("int"),
        "minute": F.minute(ts).cast("int"),
        "eventtime": time_string(ts),
    }


def registration_day_time(ts: Column | str) -> dict[str, Column]:
    """``register_day`` and ``register_time`` strings of a timestamp."""
    return {"register_day": day_string(ts), "register_time": time_string(ts)}


# A lenient time: number fields of any length, blanks before them, anything after the seconds.
_LENIENT = r"^\s*([0-9]+)-\s*([0-9]+)-\s*([0-9]+) \s*([0-9]+):\s*([0-9]+):\s*([0-9]+)"


def lenient_timestamp(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as the JVM's lenient calendar reads it: a field
    out of range rolls over into the next larger one, and what follows the
    seconds is ignored. Null where a field is missing or no 32-bit number, or
    the year falls outside 1 to 9999."""
    from .entries import let
    text = _col(text)
    fields = F.array(*[F.regexp_extract(text, _LENIENT, i).try_cast("int").cast("long") for i in range(1, 7)])

    def whole(f: Column) -> Column:
        year = f[0] + F.floor((f[1] - 1) / 12)
        month = F.pmod(f[1] - 1, F.lit(12)) + 1
        rest = (f[2] - 1) * 86400 + f[3] * 3600 + f[4] * 60 + f[5]
        first = F.when(year.between(1, 9999), F.make_date(year.cast("int"), month.cast("int"), F.lit(1)))
        seconds = F.unix_seconds(first.cast("timestamp")) + rest
        return F.when(seconds.between(-62135596800, 253402300799), F.timestamp_seconds(seconds))

    return let(fields, whole)


def days_before(as_of: str, days: int) -> Column:
    """``yyyy-MM-dd`` of ``as_of`` minus ``days`` days, as a literal-folded column."""
    return F.date_format(F.date_sub(F.to_date(F.lit(as_of)), days), DAY_FORMAT)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
