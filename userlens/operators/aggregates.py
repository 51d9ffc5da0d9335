"""Aggregations of the jobs.

All of them aggregate partially on the map side before the shuffle, so a hot
key (one user with a third of all rows) is first reduced inside every task
and only one small partial row per task reaches the final aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.entries import let
from ..functions.time import epoch_ms_time_string

TRACK_KEYS = ["uid", "deviceid", "channel", "version", "plateform"]


def high_water_column(target: DataFrame, key: str = "uid") -> Column:
    """``coalesce(max(key), -1)`` of the target as a scalar-subquery column."""
    return target.agg(F.coalesce(F.max(key), F.lit(-1)).cast("long")).scalar()


def max_key_high_water(target: DataFrame, key: str = "uid") -> DataFrame:
    """One row ``max_uid``: the largest key, or -1 for an empty target."""
    return target.agg(F.coalesce(F.max(key), F.lit(-1)).cast("long").alias("max_uid"))


def first_use(footprint: DataFrame, time_col: str = "begintime") -> DataFrame:
    """Earliest time per (uid, deviceid, channel, version, plateform).

    Same result as ``row_number() = 1`` ordered by time ascending (nulls
    first): a group holding any null time yields null. Written as an
    aggregate so it combines map-side instead of sorting each whole group.
    """
    t = F.col(time_col)
    first = F.when(F.count(F.lit(1)) > F.count(t), F.lit(None)).otherwise(F.min(t))
    return footprint.groupBy(*TRACK_KEYS).agg(first.cast("long").alias(time_col))


def track_struct(time_col: str = "begintime") -> Column:
    return F.struct(
        F.col("deviceid").alias("deviceid"),
        F.col("channel").alias("channel"),
        F.col("version").alias("app_version"),
        F.col("plateform").alias("plateform"),
        epoch_ms_time_string(time_col).alias("firstUseTime"),
    )


def collect_track(first_uses: DataFrame, time_col: str = "begintime") -> DataFrame:
    """One row per uid with its tracks as a sorted array of structs.

    The array is the user's document, so all tracks of a uid meet in one row;
    its input is distinct tracks, not events. A row is limited to 2 GB, some
    ten million tracks of one uid.
    """
    return (first_uses.groupBy("uid")
            .agg(F.array_sort(F.collect_list(track_struct(time_col))).alias("base_track")))


def merge_tracks(old: Column, new: Column) -> Column:
    """One track array of a stored and a new one: the earliest ``firstUseTime`` of each track, in the
    order of ``collect_track``. Either may be null, which is no tracks.

    Times are ``yyyy-MM-dd HH:mm:ss`` text, so the smallest text is the earliest for years 0 to 9999;
    after sorting, a track's first entry is the one to keep.
    """
    fields = ("deviceid", "channel", "app_version", "plateform")

    def first_of_track(tracks: Column) -> Column:
        def differs(t: Column, i: Column) -> Column:
            before = F.get(tracks, i - 1)
            same = F.lit(True)
            for f in fields:
                same = same & t[f].eqNullSafe(before[f])
            return (i == 0) | ~same
        return F.filter(tracks, differs)

    both = F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.concat(old, new))
    return let(F.array_sort(both), first_of_track)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The different values of a key column, one null included."""
    return df.select(key).distinct()
