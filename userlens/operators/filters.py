"""Row filters of the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, jtrim, normalize_platform
from ..functions.time import TIME_FORMAT, lenient_timestamp, registration_day_time


def filter_day_range(df: DataFrame, start_day: str, end_day: str, col: str = "p_day") -> DataFrame:
    """Inclusive string range on a day column (a partition filter on ``p_day``)."""
    return df.where(F.col(col).cast("string").between(F.lit(start_day), F.lit(end_day)))


def identified_event(uid: Column | str = "uid", deviceid: Column | str = "deviceid") -> Column:
    """False only when uid is 0 (null reads 0) and the device is null or blank."""
    uid = F.col(uid) if isinstance(uid, str) else uid
    return ~((F.coalesce(uid, F.lit(0)) == 0) & is_blank(deviceid))


def filter_identified_events(df: DataFrame) -> DataFrame:
    return df.where(identified_event())


def filter_above_high_water(df: DataFrame, high_water, cutoff, key: str = "uid",
                            time_col: str = "registerdate") -> DataFrame:
    """``key > high_water`` and ``time_col < cutoff`` (the late-commit guard).

    ``high_water`` may be a number or a scalar-subquery column, ``cutoff`` text or a column.
    """
    hw = high_water if isinstance(high_water, Column) else F.lit(high_water)
    until = cutoff if isinstance(cutoff, Column) else F.to_timestamp(F.lit(cutoff))
    return df.where((F.col(key) > hw) & (F.col(time_col) < until))


def filter_valid_idcards(df: DataFrame, idcard: Column | str = "idcard", birthday: Column | str = "birthday") -> DataFrame:
    """Keep rows whose birthday and idcard are both non-empty.

    Either may be a cheaper expression that is empty or null exactly when the
    field would be, so that the field isn't computed for rows that go.
    """
    some = [F.coalesce((F.col(c) if isinstance(c, str) else c) != "", F.lit(False)) for c in (birthday, idcard)]
    return df.where(some[0] & some[1])


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows for eyeballing (``cli.py show``); jobs never call it."""
    return df.limit(n)


# ---- registration lines ---------------------------------------------------

_LONG_TEXT = r"^[+-]?[0-9]+\z"


def _parsed_registration(fields: DataFrame, strict_dates: bool) -> DataFrame:
    uid_text = jtrim(F.col("uid"))
    uid = F.when(uid_text.rlike(_LONG_TEXT), uid_text.try_cast("long"))
    text = jtrim(F.col("registerdate"))
    ts = F.try_to_timestamp(text, F.lit(TIME_FORMAT)) if strict_dates else lenient_timestamp(text)
    ok = (F.col("n_fields") >= 8) & uid.isNotNull() & ts.isNotNull()
    day_time = registration_day_time(ts)
    return fields.select(
        "value",
        F.when(ok, uid).otherwise(F.lit(0)).alias("uid"),
        jtrim(F.col("username")).alias("username"),
        day_time["register_day"].alias("register_day"),
        day_time["register_time"].alias("register_time"),
        normalize_platform(F.col("platform")).alias("register_plateform"),
        jtrim(F.col("app_version")).alias("register_app_version"),
        jtrim(F.col("channel")).alias("register_channel"),
        jtrim(F.col("phone_os")).alias("register_phone_os"),
        jtrim(F.col("phone_name")).alias("register_phone_name"),
    )


# The fields of a user document.
USER_BASE_COLUMNS = ["uid", "username", "register_day", "register_time", "register_plateform",
                     "register_app_version", "register_channel", "register_phone_os",
                     "register_phone_name"]


def judged_registration_lines(fields: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Every split line parsed, with ``bad``: whether an error or uid 0 drops it. ``value`` is kept for bad lines
    alone.

    Dates are read leniently (month 13, short fields, text after the seconds);
    ``strict_dates`` takes only exact ``yyyy-MM-dd HH:mm:ss`` calendar dates.
    """
    bad = F.col("uid") == 0
    return _parsed_registration(fields, strict_dates).select(*USER_BASE_COLUMNS, F.when(bad, F.col("value")).alias("value"), bad.alias("bad"))


def good_registrations(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col("bad")).select(*USER_BASE_COLUMNS)


def quarantined_lines(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("bad")).select(F.col("value").alias("line"))


def filter_bad_registration_lines(fields: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Parsed users from split lines; any parse error or uid 0 drops the line."""
    return good_registrations(judged_registration_lines(fields, strict_dates))


def quarantine_bad_lines(fields: DataFrame, strict_dates: bool = False) -> DataFrame:
    """The lines ``filter_bad_registration_lines`` drops, as they were read."""
    return quarantined_lines(judged_registration_lines(fields, strict_dates))
