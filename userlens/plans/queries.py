"""Registered queries: one per operator group of the blueprint, each taking
``(spark, sf_dir)`` and returning a DataFrame over the whole driver tables.

Nested results (maps, arrays) are returned as JSON text with sorted keys or
elements so they compare equal across engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import idcard as idc
from ..functions.keys import event_key
from ..functions.entries import entries_json
from ..functions.payload import (attribute_value, ios_pairs, mapped_fields, merge_payload,
                                 normalized_keys, parse_payload, payload_json, payload_map,
                                 with_source_text, wrap_source)
from ..functions.text import jtrim
from ..functions.time import epoch_ms_time_string, event_clock
from ..functions.url import raw_query_pairs, renamed_query_params, url_domain_path, url_fields_map
from ..operators.aggregates import first_use, max_key_high_water
from ..operators.filters import filter_identified_events
from ..operators.joins import except_keys, join_event_mapping, semi_join_new_orders
from ..operators.keyed import read_latest, read_snapshot, write_replace_by_key, write_upsert_by_key
from ..operators.mapping import build_event_mapping, compile_mapping, flatten_mapping
from ..operators.windows import row_number_first
from ..session import ensure_checkpoint_dir
from ..sources import derived, scans
from . import jobs

# Fixed parameters of the registered queries.
DAY_RANGE = ("2024-01-05", "2024-01-20")       # the day-range feature itself
ALL_DAYS = ("2000-01-01", "2099-12-31")        # whole table
TRACK_SPLIT = ("2024-01-15", "2024-01-16")     # last day of the first run, first of the second
ORDERS_AS_OF, ORDERS_DAYS = "2001-08-01", 730
DEVICES_AS_OF, DEVICES_DAYS = "2024-01-31", 7
USERS_LOADED_BEFORE = "2017-06-01 00:00:00"    # users already in the target
USERS_AS_OF = "2017-09-01 00:00:00"
IDCARD_AS_OF = "2024-06-30"
RESYNC_DAY, RESYNC_LOOK_BACK = "2030-01-01", 20_000   # whole table, then the re-dated orders
URL_PS, URL_ES_PS = "page,ref,utm_source", "page_no,ref_code"


def _logs(spark, sf):
    return derived.behaviour_logs(spark, sf)


def logs_day_range(spark: SparkSession, sf: str) -> DataFrame:
    return scans.scan_logs_by_day(spark, _logs(spark, sf), *DAY_RANGE)


def logs_identified(spark, sf):
    return filter_identified_events(_logs(spark, sf)).select("uid", "deviceid", "eventid", "begintime", "p_day")


def log_event_key(spark, sf):
    return _logs(spark, sf).select(
        event_key("uid", "deviceid", "eventid", "begintime").alias("_id"),
        "uid", "deviceid", "eventid", "begintime")


def log_event_clock(spark, sf):
    c = event_clock("begintime")
    return _logs(spark, sf).select("uid", "eventid", "begintime", c["hour"].alias("hour"),
                                   c["minute"].alias("minute"), c["eventtime"].alias("eventtime"))


def payload_ios_pairs(spark, sf):
    d = _logs(spark, sf).select("begintime", "plateform", "eventcontent")
    d = with_source_text(d.withColumn("__kv", ios_pairs("eventcontent")),
                         "plateform", "eventcontent", "source", pairs="__kv")
    return d.select(
        "begintime", "plateform", "eventcontent",
        F.size("__kv").alias("n_pairs"),
        entries_json(F.col("__kv")).alias("pairs"),
        "source",
        wrap_source("source").alias("wrapped"))


def payload_json_values(spark, sf):
    logs = with_source_text(_logs(spark, sf), "plateform", "eventcontent", "source")
    logs = logs.select("begintime", "source", payload_map("source").alias("__ents"),
                       parse_payload("source").isNotNull().alias("is_object"))
    ents, is_obj = F.col("__ents"), F.col("is_object")
    return logs.select(
        "begintime", "source", "is_object",
        F.when(is_obj, F.array_join(F.array_sort(normalized_keys(ents)), ",")).alias("keys"),
        *[F.when(is_obj, attribute_value(ents, F.lit(a))).alias(f"{a}_value") for a in ("k", "url", "uid")])


def _mapping(spark, sf):
    return build_event_mapping(*derived.mapping_tables(_logs(spark, sf)))


def event_mapping(spark, sf):
    return flatten_mapping(_mapping(spark, sf))


def log_mapped_attributes(spark, sf):
    logs = _logs(spark, sf)
    j = join_event_mapping(logs, compile_mapping(_mapping(spark, sf)))
    j = with_source_text(j, "plateform", "eventcontent", "__src")
    j = j.withColumn("__ents", payload_map("__src"))
    j = j.withColumn("__keys", normalized_keys(F.col("__ents")))
    j = j.withColumn("__d", mapped_fields(F.col("__ents"), "rules", "plateform", "__keys"))
    return j.select("begintime", "uid", "eventid", "plateform", F.size("__d").alias("n_fields"),
                    payload_json(merge_payload("__src", F.col("__d"))).alias("eventcontent"))


def url_domain_path_q(spark, sf):
    pages = derived.read(spark, sf, "pages")
    dp = url_domain_path("url")
    return pages.select("page_id", "url", dp["domain"].alias("domain"), dp["path"].alias("path"))


def url_query_params(spark, sf):
    pages = derived.read(spark, sf, "pages")
    raw = raw_query_pairs("url")
    renamed = renamed_query_params("url", F.lit(URL_PS), F.lit(URL_ES_PS))
    as_text = lambda arr, k, v: F.array_join(F.transform(arr, lambda p: F.concat(p[k], F.lit("="), p[v])), "&")
    return pages.select(
        "page_id", F.size(raw).alias("n_params"),
        as_text(raw, "key", "value").alias("raw_params"),
        as_text(renamed, "key", "value").alias("renamed"),
        url_fields_map("url", F.lit(URL_PS), F.lit(URL_ES_PS)).alias("fields"))


def log_documents(spark, sf):
    logs = scans.scan_logs_by_day(spark, _logs(spark, sf), *ALL_DAYS)
    docs = jobs.log_documents(logs, _mapping(spark, sf))
    return docs.withColumn("eventcontent", payload_json("eventcontent"))


def _orders(spark, sf):
    return derived.trade_orders(spark, sf)


def orders_except_keys(spark, sf):
    existing = derived.existing_orders(spark, sf).select(F.col("_id").alias("uuid"))
    return except_keys(_orders(spark, sf).select("uuid"), existing)


def orders_semi_join(spark, sf):
    orders = _orders(spark, sf)
    new_keys = orders_except_keys(spark, sf)
    return semi_join_new_orders(orders, new_keys).select("uuid", "uid", "schemeid", "p_day")


def orders_sync_new(spark, sf):
    return jobs.sync_new_orders(spark, _orders(spark, sf), derived.existing_orders(spark, sf),
                                ORDERS_AS_OF, ORDERS_DAYS)


def users_text_parse(spark, sf):
    users, _ = jobs.users_bulk(derived.registration_lines(spark, sf))
    return users


def users_text_quarantine(spark, sf):
    _, bad = jobs.users_bulk(derived.registration_lines(spark, sf))
    return bad


def users_high_water(spark, sf):
    return max_key_high_water(derived.users(spark, sf))


def _loaded_users(spark, sf):
    u = derived.users(spark, sf)
    return u.where(F.col("registerdate") < F.to_timestamp(F.lit(USERS_LOADED_BEFORE)))


def users_incremental(spark, sf):
    target = jobs.project_user_base(_loaded_users(spark, sf))
    return jobs.users_incremental(derived.users(spark, sf), target, USERS_AS_OF)


def devices_recent(spark, sf):
    return jobs.sync_recent_devices(spark, derived.devices(spark, sf), DEVICES_AS_OF, DEVICES_DAYS)


def _footprint(spark, sf):
    return scans.scan_footprint_logs(spark, _logs(spark, sf), *ALL_DAYS)


def tracks_first_use(spark, sf):
    fu = first_use(_footprint(spark, sf))
    return fu.withColumn("firstUseTime", epoch_ms_time_string("begintime"))


def tracks_by_user(spark, sf):
    t = jobs.user_tracks(_footprint(spark, sf))
    return t.select("uid", F.to_json("base_track").alias("base_track"))


def _idcards(spark, sf):
    return derived.idcard_numbers(spark, sf)


def idcard_checksum(spark, sf):
    head = F.substring("idcard", 1, 17)
    digits17 = idc.is_digits(head) & (F.length(head) == 17)
    psum = F.when(digits17, idc.power_sum(head))
    return _idcards(spark, sf).select(
        "uid", "idcard", idc.is_digits("idcard").alias("is_digits"),
        psum.alias("power_sum"), idc.check_code(psum).alias("check_code"),
        idc.valid_18("idcard").alias("valid_18"))


def idcard_convert15(spark, sf):
    d = _idcards(spark, sf).withColumn("__t", jtrim(F.col("idcard")))
    d = idc.with_converted_15(d, "__t", "converted", IDCARD_AS_OF)
    return d.select("uid", "idcard", "converted",
                    idc.valid_any("__t", IDCARD_AS_OF).alias("valid_any"))


def idcard_formats(spark, sf):
    d = idc.with_valid_15_strict(_idcards(spark, sf), "idcard", "valid_15_strict", IDCARD_AS_OF)
    return d.select(
        "uid", "idcard", idc.format_any("idcard").alias("format_any"),
        idc.format_15("idcard").alias("format_15"), idc.format_18("idcard").alias("format_18"),
        "valid_15_strict")


def idcard_enrich(spark, sf):
    return jobs.idcard_documents(_idcards(spark, sf), IDCARD_AS_OF)


def _user_target_and_cards(spark, sf):
    target = jobs.project_user_base(_loaded_users(spark, sf))
    cards = jobs.idcard_documents(_idcards(spark, sf), IDCARD_AS_OF)
    return target, cards


def _fresh_root(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written(spark, sf, write):
    """Write the target, then the cards onto it, and read the table back."""
    target, cards = _user_target_and_cards(spark, sf)
    root = _fresh_root(spark, "users")
    write_replace_by_key(spark, target, root, "uid")
    write(spark, cards, root, "uid")
    return read_snapshot(spark, root)


def upsert_users(spark, sf):
    return _written(spark, sf, write_upsert_by_key)


def replace_users(spark, sf):
    return _written(spark, sf, write_replace_by_key)


def orders_resync(spark, sf):
    """Two syncs into one table: all orders, then the open ones again, re-dated. The look-back of
    the second doesn't reach the first's days, so it replaces them by key."""
    orders = _orders(spark, sf)
    again = (orders.where(F.col("matchresult") == "O").withColumn("betnumber", F.lit("again"))
             .withColumn("p_day", F.lit(RESYNC_DAY)))
    root = _fresh_root(spark, "orders")
    jobs.run_sync_new_orders(spark, orders, root, ORDERS_AS_OF, RESYNC_LOOK_BACK, version=1)
    jobs.run_sync_new_orders(spark, again, root, RESYNC_DAY, 1, version=2)
    return read_latest(spark, root, "_id").select("_id", "uid", "schemeid", "betnumber", "p_day")


def tracks_two_runs(spark, sf):
    """The track job run over two day ranges, one after the other, into one table: stored and new tracks merge."""
    root = _fresh_root(spark, "tracks")
    for first, last in ((ALL_DAYS[0], TRACK_SPLIT[0]), (TRACK_SPLIT[1], ALL_DAYS[1])):
        jobs.run_build_user_tracks(spark, _logs(spark, sf), first, last, root)
    return read_snapshot(spark, root).select("uid", F.to_json("base_track").alias("base_track"))


def tracks_row_number(spark, sf):
    """First use by the ranking window, beside the aggregate of ``tracks_first_use``."""
    return row_number_first(_footprint(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "logs_day_range": logs_day_range,
    "logs_identified": logs_identified,
    "log_event_key": log_event_key,
    "log_event_clock": log_event_clock,
    "payload_ios_pairs": payload_ios_pairs,
    "payload_json": payload_json_values,
    "event_mapping": event_mapping,
    "log_mapped_attributes": log_mapped_attributes,
    "url_domain_path": url_domain_path_q,
    "url_query_params": url_query_params,
    "log_documents": log_documents,
    "orders_except_keys": orders_except_keys,
    "orders_semi_join": orders_semi_join,
    "orders_sync_new": orders_sync_new,
    "users_text_parse": users_text_parse,
    "users_text_quarantine": users_text_quarantine,
    "users_high_water": users_high_water,
    "users_incremental": users_incremental,
    "devices_recent": devices_recent,
    "tracks_first_use": tracks_first_use,
    "tracks_by_user": tracks_by_user,
    "idcard_checksum": idcard_checksum,
    "idcard_convert15": idcard_convert15,
    "idcard_formats": idcard_formats,
    "idcard_enrich": idcard_enrich,
    "orders_resync": orders_resync,
    "tracks_row_number": tracks_row_number,
    "tracks_two_runs": tracks_two_runs,
    "upsert_users": upsert_users,
    "replace_users": replace_users,
}
