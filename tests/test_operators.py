"""Set, aggregate, window, filter and keyed-write semantics."""

from pyspark.sql import functions as F

from userlens.operators import aggregates as A
from userlens.operators import filters as FL
from userlens.operators import joins as J
from userlens.operators import keyed as K
from userlens.operators.mapping import build_event_mapping, flatten_mapping
from userlens.operators.windows import row_number_first
from userlens.plans import jobs


def test_order_diff_semantics(spark):
    src = spark.createDataFrame([("1", 10), ("1", 11), (None, 12), ("2", 13)], "uuid string, v int")
    existing = spark.createDataFrame([("2",)], "uuid string")
    exc = sorted(J.except_keys(src.select("uuid"), existing).collect(), key=lambda r: str(r[0]))
    assert [r[0] for r in exc] == ["1", None]
    semi = J.semi_join_new_orders(src, J.except_keys(src.select("uuid"), existing))
    assert sorted(r["v"] for r in semi.collect()) == [10, 11]
    anti = J.anti_join_new_orders(src, existing)
    assert sorted(r["v"] for r in anti.collect()) == [10, 11]


def test_first_use_null_sorts_first(spark):
    fp = spark.createDataFrame([(1, "d", "c", "v", "ios", t) for t in (5, None, 3)] +
                               [(1, "e", "c", "v", "ios", 9), (1, "e", "c", "v", "ios", 4)],
                               "uid long, deviceid string, channel string, version string, plateform string, begintime long")
    agg = {r["deviceid"]: r["begintime"] for r in A.first_use(fp).collect()}
    win = {r["deviceid"]: r["begintime"] for r in row_number_first(fp).collect()}
    assert agg == win == {"d": None, "e": 4}
    tracks = jobs.user_tracks(fp).first()["base_track"]
    assert [(t["deviceid"], t["firstUseTime"]) for t in tracks] == [("d", "1970-01-01 00:00:00"),
                                                                    ("e", "1970-01-01 00:00:00")]


def test_identified_filter(spark):
    df = spark.createDataFrame([(0, None), (None, " \t"), (0, "d1"), (7, None), (0, "")], "uid long, deviceid string")
    assert [tuple(r) for r in FL.filter_identified_events(df).collect()] == [(0, "d1"), (7, None)]


def test_registration_lines(spark):
    lines = ["1#a#2017-01-02 03:04:05#ch#os#iPhone# v1 #\"p\"", "x#a#2017-01-02 03:04:05#ch#os#ios#v#p",
             "0#a#2017-01-02 03:04:05#ch#os#ios#v#p", "2#a#2017-01-02 03:04:05#ch#os#ios#v",
             "3#a#2017-13-02 03:04:05#ch#os#ios#v#p", "4#b#2017-01-02 03:04:05#ch#os#H5#v#p#extra",
             "00000000000000000000005#a#2017-1-2 3:4:5#ch#os#ios#v#p", "6#a#2017-01-02 03:04:05.0#ch#os#ios#v#p",
             "7#a#2017-01-02#ch#os#ios#v#p", "99999999999999999999#a#2017-01-02 03:04:05#ch#os#ios#v#p"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, bad = jobs.users_bulk(df)
    g = {r["uid"]: r for r in good.collect()}
    assert sorted(g) == [1, 3, 4, 5, 6]
    assert g[3]["register_time"] == "2018-01-02 03:04:05"
    assert g[5]["register_time"] == g[6]["register_time"] == "2017-01-02 03:04:05"
    assert g[1]["register_plateform"] == "ios" and g[1]["register_phone_name"] == '"p"'
    assert g[1]["register_app_version"] == "v1" and g[1]["register_day"] == "2017-01-02"
    assert len(bad.collect()) == 5
    strict, _ = jobs.users_bulk(df, strict_dates=True)
    assert sorted(r["uid"] for r in strict.collect()) == [1, 4]


def test_upsert_and_replace(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "uid long, name string, tag string")
    new = spark.createDataFrame([(2, None), (3, "c")], "uid long, name string")
    up = {r["uid"]: (r["name"], r["tag"]) for r in K.merge_upsert(old, new, "uid").collect()}
    assert up == {1: ("a", "x"), 2: (None, "y"), 3: ("c", None)}
    twice = {r["uid"]: (r["name"], r["tag"])
             for r in K.merge_upsert(K.merge_upsert(old, new, "uid"), new, "uid").collect()}
    assert twice == up
    rep = {r["uid"]: (r["name"], r["tag"]) for r in K.merge_replace(old, new, "uid").collect()}
    assert rep == {1: ("a", "x"), 2: (None, None), 3: ("c", None)}


def test_dedup_is_order_independent(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("j", 0, "z")], "id string, t int, v string")
    a = sorted(tuple(r) for r in K.dedup_by_key(df, "id", [F.col("t")]).collect())
    b = sorted(tuple(r) for r in K.dedup_by_key(df.orderBy(F.desc("v")).repartition(3), "id", [F.col("t")]).collect())
    assert a == b == [("j", 0, "z"), ("k", 2, "c")]


def test_high_water(spark):
    assert A.max_key_high_water(spark.createDataFrame([], "uid long")).first()[0] == -1
    users = spark.createDataFrame([(5, "2017-01-01 00:00:00"), (9, "2017-01-01 00:04:00")], "uid long, registerdate string") \
        .withColumn("registerdate", F.to_timestamp("registerdate"))
    users = (users.withColumn("username", F.lit(" u ")).withColumn("registerplateform", F.lit("iPhone"))
             .withColumn("app_version", F.lit(" 1 ")).withColumn("channel", F.lit(None).cast("string"))
             .withColumn("phone_os", F.lit("o")).withColumn("phone_name", F.lit("n")))
    target = spark.createDataFrame([(4,)], "uid long")
    got = jobs.users_incremental(users, target, "2017-01-01 00:08:00").collect()
    assert [(r["uid"], r["username"], r["register_plateform"], r["register_app_version"], r["register_channel"])
            for r in got] == [(5, "u", "ios", " 1 ", "")]
    empty_target = spark.createDataFrame([], "uid long")
    assert jobs.users_incremental(users, empty_target, "2017-02-01").count() == 0


def test_mapping_one_template_per_action(spark):
    mapper = spark.createDataFrame([(1, 10), (1, 15), (2, 20)], "action_id long, template_id long")
    template = spark.createDataFrame([(10,), (15,)], "id long")
    detail = spark.createDataFrame([
        (10, "a", "x", "string", None, None, "all", 1), (15, "b", "y", "string", None, None, "all", 1),
        (15, "b", "z", "string", None, None, "all", 1), (15, "c", "w", "string", None, None, "all", 0),
        (20, "d", "v", "url", "p", "q", "ios", 1)],
        "template_id long, attribute string, target_attribute string, datatype string, ps string, es_ps string, "
        "plateform string, status int")
    flat = sorted(tuple(r)[:3] for r in flatten_mapping(build_event_mapping(mapper, template, detail)).collect())
    assert flat == [(1, "b", "z"), (2, "d", "v")]


def test_bounded_broadcast(spark):
    small = spark.range(5)
    assert J.bounded_broadcast(small, 1000)[1]
    assert not J.bounded_broadcast(small, 10)[1]
    assert not J.bounded_broadcast(spark.createDataFrame([("x" * 500,)], "s string"), 500)[1]


def test_snapshot_roundtrip(spark, tmp_path):
    root = str(tmp_path / "users")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "uid long, name string")
    K.write_keyed(spark, a, root, "uid", mode="replace")
    b = spark.createDataFrame([(2, "B"), (3, "c")], "uid long, name string")
    K.write_keyed(spark, b, root, "uid", mode="upsert")
    cur = {r["uid"]: r["name"] for r in K.read_snapshot(spark, root).collect()}
    assert cur == {1: "a", 2: "B", 3: "c"}


def test_order_sync_replaces_a_redated_order(spark, tmp_path):
    root = str(tmp_path / "orders")
    cols = ", ".join(f"{c} string" for c in ["uuid", "issueno", "betnumber", "hteam", "vteam", "tournamentname",
                                             "matchresult", "platformcode", "bunch", "betsp", "winsp", "p_day"])
    schema = (f"{cols}, uid long, schemeid long, lotteryid int, playtypeid int, superplaytypeid int, hteamid int, "
              "vteamid int, tournamentid long, iswin int, datetime timestamp, multiple int, money double")

    def orders(ids, day):
        import datetime as dt
        return spark.createDataFrame(
            [dict(uuid=i, issueno="x", betnumber="b", hteam="h", vteam="v", tournamentname="t", matchresult="m",
                  platformcode="p", bunch="1", betsp="1", winsp="1", p_day=day, uid=1, schemeid=1, lotteryid=1,
                  playtypeid=1, superplaytypeid=1, hteamid=1, vteamid=1, tournamentid=1, iswin=0,
                  datetime=dt.datetime(2024, 1, 1), multiple=1, money=1.0) for i in ids], schema)
    def latest():
        return sorted((r["_id"], r["p_day"]) for r in K.read_latest(spark, root, "_id").collect())
    jobs.run_sync_new_orders(spark, orders(["a", "b"], "2024-01-30"), root, "2024-01-31", version=1)
    jobs.run_sync_new_orders(spark, orders(["a", "b", "c"], "2024-01-30"), root, "2024-01-31", version=2)
    assert latest() == [("a", "2024-01-30"), ("b", "2024-01-30"), ("c", "2024-01-30")]
    for version in (3, 4):  # re-dated beyond the look-back, and the run repeated
        jobs.run_sync_new_orders(spark, orders(["a"], "2024-02-10"), root, "2024-02-10", version=version)
        assert latest() == [("a", "2024-02-10"), ("b", "2024-01-30"), ("c", "2024-01-30")]


def test_cli_runs_bulk_and_tracks(spark, tmp_path):
    from userlens import cli
    lines = tmp_path / "users.txt"
    lines.write_text("1#a#2017-01-02 03:04:05#ch#os#iPhone#v1#p\nx#b#2017-01-02 03:04:05#ch#os#ios#v#p\n")
    root = str(tmp_path / "user_base")
    cli.main(["users-bulk", "--path", str(lines), "--target", root, "--quarantine", str(tmp_path / "bad")])
    logs = spark.createDataFrame([(1, "d1", "c", "v", "ios", 5, "2024-01-01")],
                                 "uid long, deviceid string, channel string, version string, plateform string, "
                                 "begintime long, p_day string")
    src = str(tmp_path / "logs")
    logs.write.partitionBy("p_day").parquet(src)
    cli.main(["tracks", "--src", src, "--start", "2024-01-01", "--end", "2024-01-31", "--target", root])
    got = K.read_snapshot(spark, root).collect()
    assert len(got) == 1 and got[0]["username"] == "a" and len(got[0]["base_track"]) == 1
    assert [r[0] for r in spark.read.text(str(tmp_path / "bad")).collect()] == ["x#b#2017-01-02 03:04:05#ch#os#ios#v#p"]


def test_cli_devices_and_compact(spark, tmp_path):
    from userlens import cli
    dev = spark.createDataFrame(
        [(1, "2024-01-30", "dv1", 1706572800000, "ios", "c1", "v1"),
         (2, "2024-01-01", "dv2", 1704067200000, "h5", "c2", "v2")],
        "uid long, registerday string, deviceid string, registertime long, registerplateform string, "
        "channel string, version string")
    src = str(tmp_path / "devices")
    dev.write.parquet(src)
    root = str(tmp_path / "device_docs")
    cli.main(["devices", "--src", src, "--target", root, "--as-of", "2024-01-31 00:00:00"])
    got = K.read_snapshot(spark, root).collect()
    assert [(r["_id"], r["register_time"]) for r in got] == [("dv1", "2024-01-30 00:00:00")]
    # an append-versioned table compacts to one row per key
    vroot = str(tmp_path / "versioned")
    docs = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    K.write_keyed(spark, docs, vroot, "_id", mode="append_versioned", version=1)
    K.write_keyed(spark, docs.where("_id = 'a'").withColumn("v", F.lit(9)), vroot, "_id",
                  mode="append_versioned", version=2)
    cli.main(["compact", "--target", vroot])
    cli.main(["show", "--target", vroot, "--rows", "1"])
    rows = {r["_id"]: r["v"] for r in K.read_latest(spark, vroot, "_id").collect()}
    assert rows == {"a": 9, "b": 2} and K.read_snapshot(spark, vroot).count() == 2


def test_ensure_parallelism_only_spreads_few_splits(spark):
    from userlens.operators.partitioning import ensure_parallelism
    many = spark.range(0, 1000, numPartitions=16)
    assert ensure_parallelism(many, 8) is many
    few = spark.range(0, 1000, numPartitions=1)
    spread = ensure_parallelism(few, 8)
    assert spread.rdd.getNumPartitions() == 8 and spread.count() == 1000
