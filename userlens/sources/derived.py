"""The reference's source tables, derived from the driver's tables.

The driver ships TPC-H-like tables plus an ``events`` stream, not the
warehouse tables the jobs read. These functions re-shape them, row for row,
into the jobs' input schemas (see FIXTURES.md) so every job runs over the
whole given data and its work grows with it. Each derivation is a narrow
projection (no shuffle) except ``devices`` (one partial aggregate).

The same derivations are written in SQL in ``oracle_queries.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.idcard import check_code, power_sum
from ..functions.time import day_string, ts_to_epoch_ms
from ..operators.partitioning import ensure_parallelism
from ..session import folder_bytes, table_path

EVENT_IDS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


# Tables whose rows feed CPU-heavy column work (the event payload). Only these
# are spread when they arrive as a handful of splits; for the small dimension
# tables the extra exchange costs more than the single task it replaces.
SPREAD_TABLES = {"events"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; ``events`` is spread over the cluster's cores when it
    is only a handful of splits (a no-op for a large, many-file table)."""
    path = table_path(sf_dir, name)
    df = spark.read.parquet(path)
    return ensure_parallelism(df, input_bytes=folder_bytes(spark, path)) if name in SPREAD_TABLES else df


def _event_url(e):
    """A URL per event covering query, fragment, bad scheme and no-'=' forms."""
    k = e % 4
    return (F.when(k == 0, F.concat(F.lit("http://h"), (e % 17).cast("string"),
                                    F.lit(".example.com/a//b///c?page="), (e % 5).cast("string"),
                                    F.lit("&ref=r"), (e % 3).cast("string"), F.lit("&x=1=2&q=#top")))
            .when(k == 1, F.concat(F.lit("https://www.site"), (e % 9).cast("string"),
                                   F.lit(".example.org//p"), (e % 7).cast("string"),
                                   F.lit("?utm_source=feed&page="), (e % 4).cast("string")))
            .when(e % 44 == 2, F.lit("http://h.com:abc/p?page=1"))
            .when(e % 44 == 6, F.lit("file:///var//log/a?page=2"))
            .when(e % 44 == 10, F.lit("http://u@[::1]:80/p?ref=z"))
            .when(k == 2, F.concat(F.lit("ftp://files.example.net/pub//f"), (e % 10).cast("string")))
            .otherwise(F.concat(F.lit("foo://bad/"), e.cast("string"))))


def behaviour_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the 17-column behaviour log, partition column ``p_day``."""
    ev = read(spark, sf_dir, "events")
    e = F.col("event_id")
    uid = F.when(F.col("user_id") % 10 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("long")
    deviceid = (F.when(e % 11 == 0, F.lit(None).cast("string"))
                .when(e % 7 == 0, F.lit(""))
                .when(e % 13 == 0, F.lit("\t"))
                .otherwise(F.concat(F.lit("d"), (e % 500).cast("string"))))
    plateform = (F.when(e % 3 == 0, F.when(e % 19 == 0, F.lit("iOS")).otherwise(F.lit("ios")))
                 .when(e % 3 == 1, F.lit("android"))
                 .otherwise(F.when(e % 2 == 0, F.lit("H5")).otherwise(F.lit("h5"))))
    eventid = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_IDS.items()],
                         F.lit(0)).cast("int")
    begintime = ts_to_epoch_ms("ts")
    k = F.regexp_extract("props", "([0-9]+)", 1)
    url = _event_url(e)
    ios_text = F.when(e % 4 == 0, F.lit("{hello}")).otherwise(F.concat(
        F.lit("{k="), k, F.lit("; uid="), F.col("user_id").cast("string"),
        F.lit(";\tbad=;a=b=c;url="), url, F.lit("}")))
    json_text = (F.when(e % 17 == 0, F.concat(F.lit("not json {"), k))
                 .when(e % 23 == 0, F.concat(F.lit('{"k": '), k, F.lit("} tail")))
                 .when(e % 29 == 0, F.concat(F.lit('{"k": '), k, F.lit('}{"k": 1}')))
                 .when(e % 5 == 0, F.concat(F.lit('{"k": '), k, F.lit(', "Url": "'), url, F.lit('"}')))
                 .otherwise(F.concat(F.lit('{"k": '), k, F.lit(', "url": "'), url,
                                     F.lit('", "tags": {"a": 1}, " UID ": "'),
                                     F.col("user_id").cast("string"), F.lit('"}'))))
    content = F.when(e % 3 == 0, ios_text).otherwise(json_text)
    return ev.select(
        uid.alias("uid"),
        deviceid.alias("deviceid"),
        plateform.alias("plateform"),
        eventid.alias("eventid"),
        content.alias("eventcontent"),
        begintime.alias("begintime"),
        (begintime + e % 5000).alias("uploadtime"),
        F.concat(F.lit("10.0."), (e % 256).cast("string"), F.lit("."),
                 (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.concat(F.lit("v"), (e % 3).cast("string")).alias("version"),
        F.col("event_type").alias("pmenu"),
        F.concat(F.lit("m"), (e % 6).cast("string")).alias("menu"),
        F.when(e % 2 == 0, F.lit("wifi")).otherwise(F.lit("4g")).alias("net"),
        F.concat(F.lit("c"), (e % 4).cast("string")).alias("channel"),
        F.lit("app").alias("client"),
        F.concat(F.lit("os"), (e % 5).cast("string")).alias("os"),
        F.concat(F.lit("sp"), (e % 2).cast("string")).alias("subplateform"),
        day_string(F.col("ts")).alias("p_day"),
    )


def trade_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as the 24-column trade-order table, partition column ``p_day``.

    Keys include nulls (every 101st) and duplicates (every 53rd repeats the
    previous key) to exercise the set semantics of the order sync.
    """
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    uuid = (F.when(k % 101 == 0, F.lit(None).cast("string"))
            .when(k % 53 == 0, F.concat(F.lit("o"), (k - 1).cast("string")))
            .otherwise(F.concat(F.lit("o"), k.cast("string"))))
    return o.select(
        uuid.alias("uuid"),
        c.alias("uid"),
        (k * 10).alias("schemeid"),
        F.concat(F.lit("i"), (k % 1000).cast("string")).alias("issueno"),
        (k % 7).cast("int").alias("lotteryid"),
        (k % 5).cast("int").alias("playtypeid"),
        (k % 3).cast("int").alias("superplaytypeid"),
        F.col("o_orderpriority").alias("betnumber"),
        (c % 20).cast("int").alias("hteamid"),
        F.concat(F.lit("t"), (c % 20).cast("string")).alias("hteam"),
        ((c + 7) % 20).cast("int").alias("vteamid"),
        F.concat(F.lit("t"), ((c + 7) % 20).cast("string")).alias("vteam"),
        (c % 9).alias("tournamentid"),
        F.concat(F.lit("cup"), (c % 9).cast("string")).alias("tournamentname"),
        F.col("o_orderstatus").alias("matchresult"),
        (F.col("o_orderstatus") == "F").cast("int").alias("iswin"),
        F.col("o_orderdate").cast("timestamp").alias("datetime"),
        F.concat(F.lit("pc"), (k % 4).cast("string")).alias("platformcode"),
        (k % 4 + 1).cast("int").alias("multiple"),
        F.lit("1x1").alias("bunch"),
        F.lit("1.5").alias("betsp"),
        F.lit("2.0").alias("winsp"),
        F.col("o_totalprice").alias("money"),
        day_string(F.col("o_orderdate")).alias("p_day"),
    )


def existing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target snapshot of already-synced orders: the finished ones."""
    t = trade_orders(spark, sf_dir)
    keep = (F.col("matchresult") == "F") & F.col("uuid").isNotNull()
    return t.where(keep).select(F.col("uuid").alias("_id"), "p_day")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as the user database relation (untrimmed, some nulls).

    Registrations run through 2017 in key order at any table size, so a date
    cuts the table at the same share of its rows.
    """
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    last = c.agg(F.max("c_custkey")).scalar()
    minutes = F.expr("c_custkey * 525600").cast("long")
    return c.select(
        k.alias("uid"),
        F.when(k % 5 == 0, F.concat(F.lit(" "), F.col("c_name"), F.lit("\t")))
         .otherwise(F.col("c_name")).alias("username"),
        F.timestamp_seconds(F.unix_seconds(F.lit("2017-01-01 00:00:00").cast("timestamp"))
                            + F.floor(minutes / last) * 60).alias("registerdate"),
        F.when(k % 4 == 0, F.lit("iPhone")).when(k % 4 == 1, F.lit(" Android "))
         .when(k % 4 == 2, F.lit(None).cast("string")).otherwise(F.lit("H5")).alias("registerplateform"),
        F.concat(F.lit(" v"), (k % 3).cast("string"), F.lit(" ")).alias("app_version"),
        F.col("c_mktsegment").alias("channel"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("os"), (k % 5).cast("string"))).alias("phone_os"),
        F.concat(F.lit("phone-"), F.col("c_nationkey").cast("string")).alias("phone_name"),
    )


def registration_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``#``-separated registration lines (``value``) from ``customer``.

    Some are broken on purpose: a non-numeric uid, uid 0, too few fields, a
    date without time. Dates of lenient forms (month 13, short fields, a
    fraction) and a uid of more than 19 digits are good; quote characters must
    stay literal.
    """
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    uid = (F.when(k % 17 == 0, F.lit("x"))
           .when(k % 19 == 0, F.lit("0"))
           .when(k % 13 == 0, F.lpad(k.cast("string"), 24, "0"))
           .otherwise(F.concat(F.lit(" "), k.cast("string"))))
    date = (F.when(k % 29 == 0, F.lit("2017-13-01 10:00:00"))
            .when(k % 31 == 0, F.lit("2017-1-2 3:4:5"))
            .when(k % 37 == 0, F.lit("2017-01-02 03:04:05.0"))
            .when(k % 43 == 0, F.lit("2017-01-02"))
            .otherwise(F.date_format(F.lit("2017-01-01 00:00:00").cast("timestamp")
                                     + F.make_interval(hours=(k * 5).cast("int")),
                                     "yyyy-MM-dd HH:mm:ss")))
    platform = (F.when(k % 3 == 0, F.lit(" iPhone")).when(k % 3 == 1, F.lit("Android"))
                .otherwise(F.lit("H5 ")))
    phone = F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit('"p'), (k % 11).cast("string"), F.lit('"')))
    value = F.concat_ws("#", uid, F.regexp_replace("c_name", "#", ""), date, F.col("c_mktsegment"),
                        F.concat(F.lit("os"), (k % 5).cast("string")), platform,
                        F.concat(F.lit(" v"), (k % 4).cast("string")), phone)
    return c.select(value.alias("value"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device registrations: every 4 consecutive events form one device.

    The first event of a device is its registration. One partial aggregate.
    """
    ev = read(spark, sf_dir, "events").select(
        (F.col("event_id") / 4).cast("long").alias("dev"), "event_id", "user_id",
        ts_to_epoch_ms("ts").alias("ms"))
    first = ev.groupBy("dev").agg(F.min(F.struct("ms", "event_id", "user_id")).alias("f"))
    e = F.col("f.event_id")
    return first.select(
        F.col("f.user_id").alias("uid"),
        day_string(F.timestamp_millis(F.col("f.ms"))).alias("registerday"),
        F.concat(F.lit("dev"), F.col("dev").cast("string")).alias("deviceid"),
        F.col("f.ms").alias("registertime"),
        F.when(e % 3 == 0, F.lit("ios")).when(e % 3 == 1, F.lit("android"))
         .otherwise(F.lit("h5")).alias("registerplateform"),
        F.concat(F.lit("c"), (e % 4).cast("string")).alias("channel"),
        F.concat(F.lit("v"), (e % 3).cast("string")).alias("version"),
    )


def idcard_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid, idcard)`` rows from ``customer`` covering every id-card case.

    Valid 18-digit numbers, wrong check digits, 15-digit numbers, lower-case
    ``x``, padded, letters, unknown province, empty and null values.
    """
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    province = F.when(k % 41 == 0, F.lit("99")).otherwise(
        F.element_at(F.array(*[F.lit(p) for p in ["11", "32", "44", "51", "65", "81"]]),
                     (k % 6 + 1).cast("int")))
    birth = F.date_add(F.lit("1950-01-01").cast("date"), (k * 37 % 25000).cast("int"))
    head17 = F.concat(province, F.lpad((k % 10000).cast("string"), 4, "0"),
                      F.date_format(birth, "yyyyMMdd"), F.lpad((k % 1000).cast("string"), 3, "0"))
    staged = c.select(k.alias("c_custkey"), head17.alias("h"))
    staged = staged.withColumn("code", check_code(power_sum("h")))
    h, code = F.col("h"), F.col("code")
    good = F.concat(h, F.upper(code))
    wrong = F.concat(h, F.when(code == "1", F.lit("2")).otherwise(F.lit("1")))
    fifteen = F.concat(F.substring(h, 1, 6), F.substring(h, 9, 9))
    idcard = (F.when(k % 97 == 0, F.lit(None).cast("string"))
              .when(k % 89 == 0, F.lit(""))
              .when(k % 83 == 0, F.concat(F.substring(h, 1, 10), F.lit("AB12C")))
              .when(k % 7 == 0, fifteen)
              .when(k % 11 == 0, F.concat(F.lit(" "), good, F.lit(" ")))
              .when(k % 13 == 0, F.lower(good))
              .when(k % 3 == 0, wrong)
              .otherwise(good))
    return staged.select(k.alias("uid"), idcard.alias("idcard"))


def mapping_tables(logs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mapping metadata (mapper, template, detail) for the event ids in ``logs``.

    Action ``a`` uses template ``10a``; actions 1 and 2 also have a later
    template ``10a + 5``. Template 30 is missing from the template table.
    Details cover string/url/unknown datatypes, platform gates in mixed case,
    an inactive row, a duplicate attribute and a capitalised attribute.
    """
    spark = logs.sparkSession
    # A handful of actions, asked for once instead of by each of the three tables.
    found = [r[0] for r in logs.select(F.col("eventid").cast("long")).distinct().collect()]
    actions = spark.createDataFrame([(x,) for x in sorted(found)], "a long")
    a = F.col("a")
    mapper = actions.select(
        a.alias("action_id"),
        F.explode(F.when(a <= 2, F.array(a * 10, a * 10 + 5)).otherwise(F.array(a * 10)))
         .alias("template_id"))
    template = mapper.select(F.col("template_id").alias("id")).where(F.col("id") != 30).distinct()
    t = F.col("template_id")
    none = F.lit(None).cast("string")

    def row(attribute, target, datatype, ps, es_ps, plateform, status):
        return F.struct(F.lit(attribute).alias("attribute"), F.lit(target).alias("target_attribute"),
                        F.lit(datatype).alias("datatype"),
                        (F.lit(ps) if ps is not None else none).alias("ps"),
                        (F.lit(es_ps) if es_ps is not None else none).alias("es_ps"),
                        (plateform if not isinstance(plateform, str) else F.lit(plateform)).alias("plateform"),
                        F.lit(status).alias("status"))

    url_platform = (F.when(t % 4 == 0, F.lit("all")).when(t % 4 == 1, F.lit("IOS"))
                    .when(t % 4 == 2, F.lit("android")).otherwise(F.lit("H5")))
    uid_platform = F.when(t % 20 == 0, F.lit("all")).otherwise(F.lit("ios"))
    common = [
        row("k", "k_val", "string", None, None, "all", 1),
        row("url", "link", "url", "page,ref,utm_source,x,q", "page_no,ref_code,src,,", url_platform, 1),
        row("uid", "user_ref", "string", None, None, uid_platform, 1),
        row("K", "never", "string", None, None, "all", 1),
        row("k", "k_old", "string", None, None, "all", 0),
    ]
    late = [row("k", "k_dup", "string", None, None, "all", 1),
            row("tags", "tags_copy", "string", None, None, "all", 1)]
    early = [row("tags", "tags_n", "number", None, None, "all", 1)]
    templates = mapper.select("template_id").distinct()
    detail = templates.select(
        t, F.explode(F.when(t % 10 == 5, F.array(*common, *late)).otherwise(F.array(*common, *early)))
        .alias("d")).select("template_id", "d.*")
    return mapper, template, detail
