"""The seven jobs and the mapping builder, each a pure DataFrame -> DataFrame
function plus a ``run_*`` wrapper that reads the sources and writes the keyed
target. Every job is one Catalyst plan: scans with pushed filters, narrow
column expressions, and at most the shuffles named in its docstring.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import idcard as idc
from ..functions.keys import event_key
from ..functions.payload import with_event_payload
from ..functions.text import null_to_empty_trim, normalize_platform
from ..functions.time import epoch_ms_time_string, event_clock, registration_day_time, time_string
from ..operators.aggregates import collect_track, first_use, high_water_column, merge_tracks
from ..operators.filters import (filter_above_high_water, filter_bad_registration_lines, filter_identified_events,
                                 good_registrations, judged_registration_lines, quarantine_bad_lines, quarantined_lines)
from ..operators.joins import DEFAULT_BROADCAST_BYTES, anti_join_new_orders, join_event_mapping
from ..operators.keyed import (as_documents, dedup_by_key, largest_value, read_snapshot, write_keyed,
                               write_replace_by_key, write_upsert_by_key)
from ..operators.mapping import build_event_mapping, compile_mapping
from ..session import drop_table, materialize
from ..sources import scans

# ---- log documents --------------------------------------------------------

# The columns that a log document is made from.
LOG_SOURCE_COLUMNS = ["uid", "deviceid", "plateform", "eventid", "eventcontent", "begintime",
                      "uploadtime", "ip", "version", "pmenu", "menu", "net", "channel", "client",
                      "os", "p_day"]


def project_log_document(df: DataFrame) -> DataFrame:
    """``_id`` plus the 19 document fields (``subplateform`` is not written)."""
    clock = event_clock("begintime")
    return df.select(
        "_id",
        F.coalesce(F.col("uid"), F.lit(0)).cast("long").alias("uid"),
        "deviceid", "plateform",
        F.coalesce(F.col("eventid"), F.lit(0)).cast("int").alias("eventid"),
        "eventcontent",
        F.coalesce(F.col("begintime"), F.lit(0)).cast("long").alias("begintime"),
        F.coalesce(F.col("uploadtime"), F.lit(0)).cast("long").alias("uploadtime"),
        "ip", "version", "pmenu", "menu", "net", "channel", "client", "os", "p_day",
        clock["hour"].alias("hour"), clock["minute"].alias("minute"),
        clock["eventtime"].alias("eventtime"),
    )


def log_documents(logs: DataFrame, mapping: DataFrame,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """identified filter -> key -> dedup -> mapping lookup -> payload -> project.

    The only shuffle is the dedup on the document key, done on the raw log
    columns with a map-side partial ``max`` (latest ``uploadtime``, then
    the whole raw row), so a repeated key never concentrates raw rows in one
    task. The payload is then built once per surviving document, after a
    broadcast (size-checked) lookup of the event's mapping.
    """
    kept = filter_identified_events(logs).withColumn(
        "_id", event_key("uid", "deviceid", "eventid", "begintime"))
    cols = ["_id"] + [c for c in LOG_SOURCE_COLUMNS if c in kept.columns]
    latest = dedup_by_key(kept.select(*cols), "_id", [F.coalesce(F.col("uploadtime"), F.lit(0))])
    joined = join_event_mapping(latest, compile_mapping(mapping), max_broadcast_bytes)
    return project_log_document(with_event_payload(joined, rules="rules").drop("rules"))


def build_log_documents(spark: SparkSession, src, start_day: str, end_day: str,
                        mapping_src: dict) -> DataFrame:
    logs = scans.scan_logs_by_day(spark, src, start_day, end_day)
    mapping = build_event_mapping(*scans.scan_mapping_tables(spark, mapping_src))
    return log_documents(logs, mapping)


def run_build_log_documents(spark: SparkSession, src, start_day: str, end_day: str,
                            mapping_src: dict, target_root: str, version: int | None = None) -> str:
    """Replace-by-key at the cost of the run's own documents: they are
    appended with a run version into the ``p_day``-partitioned snapshot;
    readers use ``read_latest`` and ``compact_snapshot`` folds versions."""
    docs = build_log_documents(spark, src, start_day, end_day, mapping_src)
    return write_keyed(spark, docs, target_root, "_id", mode="append_versioned", partition_by="p_day",
                       version=version)


# ---- orders ---------------------------------------------------------------

ORDER_DOCUMENT_FIELDS = [c for c in scans.ORDER_COLUMNS if c != "uuid"]


def project_order_document(df: DataFrame) -> DataFrame:
    """``_id`` = uuid plus 23 fields, ``datetime`` as text."""
    return as_documents(df, "uuid", {c: time_string("datetime") if c == "datetime" else F.col(c)
                                     for c in ORDER_DOCUMENT_FIELDS})


def new_order_documents(recent: DataFrame, existing_keys: DataFrame, mostly_known: bool = False) -> DataFrame:
    """Orders not yet in the target, one document per uuid.

    The anti join comes first, so known orders are dropped before their
    columns are carried anywhere; the dedup then reuses its partitioning when
    the join was shuffled.
    """
    new = anti_join_new_orders(recent, existing_keys, mostly_known=mostly_known)
    return dedup_by_key(project_order_document(new), "_id")


def sync_new_orders(spark: SparkSession, orders_src, target_src, as_of: str, days: int = 2,
                    mostly_known: bool = False) -> DataFrame:
    recent = scans.scan_recent_orders(spark, orders_src, as_of, days)
    since = (date.fromisoformat(as_of[:10]) - timedelta(days=days)).isoformat()
    existing = scans.scan_existing_keys(spark, target_src, since)
    return new_order_documents(recent, existing, mostly_known)


def run_sync_new_orders(spark: SparkSession, orders_src, target_root: str, as_of: str,
                        days: int = 2, version: int | None = None) -> str:
    """The uuid is the document's key: an order that comes again under a later
    day replaces its old document (newest run wins, ``read_latest``). A sync of an
    existing table finds most orders of its look-back known."""
    old = read_snapshot(spark, target_root)
    mostly_known = old is not None
    if old is None:
        old = spark.createDataFrame([], "_id string, p_day string")
    docs = sync_new_orders(spark, orders_src, old, as_of, days, mostly_known)
    return write_keyed(spark, docs, target_root, "_id", mode="append_versioned", sort_by="p_day", version=version)


# ---- users ----------------------------------------------------------------

def users_bulk(lines: DataFrame, strict_dates: bool = False) -> tuple[DataFrame, DataFrame]:
    """Registration lines -> (user documents, quarantined lines). No shuffle."""
    fields = scans.scan_registration_text(None, lines)
    return filter_bad_registration_lines(fields, strict_dates), quarantine_bad_lines(fields, strict_dates)


def run_load_users_bulk(spark: SparkSession, path: str, target_root: str, quarantine_path: str,
                        strict_dates: bool = False) -> str:
    """Registration text file -> user documents (replace). Bad lines replace what
    ``quarantine_path`` holds (one folder per load), so none vanishes and a
    repeated load doesn't double them.

    The file is read and parsed once, into one table with a folder of good lines
    and one of bad lines; each output then reads its own folder.
    """
    judged = judged_registration_lines(scans.scan_registration_text(spark, path), strict_dates)
    judged, table = materialize(judged, "bad")
    try:
        quarantined_lines(judged).write.mode("overwrite").text(quarantine_path)
        return write_replace_by_key(spark, good_registrations(judged), target_root, "uid")
    finally:
        drop_table(spark, table)


def project_user_base(users: DataFrame) -> DataFrame:
    """The 9 user fields from database rows: null -> '', trimmed, except
    ``app_version`` which is only null-guarded."""
    dt = registration_day_time("registerdate")
    return users.select(
        F.col("uid").cast("long").alias("uid"),
        null_to_empty_trim("username").alias("username"),
        dt["register_day"].alias("register_day"),
        dt["register_time"].alias("register_time"),
        F.coalesce(normalize_platform("registerplateform"), F.lit("")).alias("register_plateform"),
        F.coalesce(F.col("app_version"), F.lit("")).alias("register_app_version"),
        null_to_empty_trim("channel").alias("register_channel"),
        null_to_empty_trim("phone_os").alias("register_phone_os"),
        null_to_empty_trim("phone_name").alias("register_phone_name"),
    )


def users_incremental(users: DataFrame, target: DataFrame, as_of: str, guard_minutes: int = 5) -> DataFrame:
    """Users above the target's high-water uid, older than the arrival guard.

    The high water is a scalar subquery (one tiny aggregate job, no join);
    an empty or non-positive target yields no rows (the bulk job bootstraps).
    """
    hw = high_water_column(target)
    cutoff = F.to_timestamp(F.lit(as_of)) - F.make_interval(mins=F.lit(guard_minutes))
    return project_user_base(filter_above_high_water(users, hw, cutoff).where(hw > 0))


def run_load_users_incremental(spark: SparkSession, jdbc_url: str, table: str, target_root: str,
                               as_of: str, guard_minutes: int = 5, options: dict | None = None,
                               columns: dict[str, str] | None = None, num_partitions: int = scans.JDBC_PARTITIONS) -> str | None:
    """High water from the target's file footers, then a JDBC read with the bound pushed in."""
    max_uid = largest_value(spark, target_root, "uid")
    if max_uid is None or max_uid <= 0:
        return None
    cutoff = spark.range(1).select(time_string(
        F.to_timestamp(F.lit(as_of)) - F.make_interval(mins=F.lit(guard_minutes)))).first()[0]
    rows = scans.scan_users_incremental(spark, jdbc_url, table, max_uid, cutoff, options, columns, num_partitions)
    return write_upsert_by_key(spark, project_user_base(rows), target_root, "uid")


def idcard_documents(rows: DataFrame, as_of: str, strict_dates: bool = False) -> DataFrame:
    """``(uid, idcard)`` -> enriched, valid rows only. Column expressions only.

    ``strict_dates`` also drops numbers whose month or day is out of range,
    which otherwise roll over as the JVM's lenient calendar does.
    """
    rows = rows.select(F.col("uid").cast("long").alias("uid"), "idcard")
    if strict_dates:
        rows = rows.where(idc.calendar_date_ok("idcard", as_of))
    # ``valid_only`` is ``filter_valid_idcards``, decided before the fields are computed.
    return idc.with_enriched_idcard(rows, as_of, valid_only=True)


def run_enrich_user_idcards(spark: SparkSession, jdbc_url: str, table: str, target_root: str,
                            as_of: str, min_uid: int, bounds: tuple[int, int] | None = None,
                            num_partitions: int = scans.JDBC_PARTITIONS, options: dict | None = None,
                            columns: dict[str, str] | None = None, strict_dates: bool = False) -> str:
    lo, hi = bounds if bounds else (None, None)
    rows = scans.scan_idcards_jdbc(spark, jdbc_url, table, min_uid, lo, hi, num_partitions, options, columns)
    return write_upsert_by_key(spark, idcard_documents(rows, as_of, strict_dates), target_root, "uid")


# ---- tracks ---------------------------------------------------------------

def user_tracks(footprint: DataFrame) -> DataFrame:
    """``(uid, base_track)``: first use per track key, nested per user.

    Two aggregates with map-side combine: (uid, device, channel, version,
    platform) then uid. A hot user is reduced to its distinct tracks before
    the second shuffle.
    """
    return collect_track(first_use(footprint))


def build_user_tracks(spark: SparkSession, src, start_day: str, end_day: str) -> DataFrame:
    return user_tracks(scans.scan_footprint_logs(spark, src, start_day, end_day))


def run_build_user_tracks(spark: SparkSession, src, start_day: str, end_day: str,
                          target_root: str) -> str:
    """Upsert (D9): the tracks must not wipe the user's registration fields. Stored tracks are merged
    with the run's, so runs over several day ranges add up to one run over all of them."""
    return write_upsert_by_key(spark, build_user_tracks(spark, src, start_day, end_day), target_root, "uid",
                               merge={"base_track": merge_tracks})


# ---- devices --------------------------------------------------------------

def project_device_base(devices: DataFrame) -> DataFrame:
    return as_documents(devices, "deviceid", {
        "uid": F.col("uid"), "deviceid": F.col("deviceid"),
        "register_day": F.col("registerday"),
        "register_time": epoch_ms_time_string("registertime"),
        "register_plateform": F.col("registerplateform"),
        "register_app_version": F.col("version"),
        "register_channel": F.col("channel"),
    })


def device_documents(recent: DataFrame) -> DataFrame:
    return dedup_by_key(project_device_base(recent), "_id")


def sync_recent_devices(spark: SparkSession, src, as_of: str, days: int = 7) -> DataFrame:
    return device_documents(scans.scan_recent_devices(spark, src, as_of, days))


def run_sync_recent_devices(spark: SparkSession, src, target_root: str, as_of: str, days: int = 7) -> str:
    return write_upsert_by_key(spark, sync_recent_devices(spark, src, as_of, days), target_root, "_id")
