"""JDBC scans against an embedded in-memory Derby database.

Derby's embedded driver ships with Spark; the database lives inside this
test's JVM only (no server, no port).
"""

import pytest
from pyspark.sql import functions as F

from userlens.sources import scans

URL = "jdbc:derby:memory:userlens_test;create=true"
DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


@pytest.fixture(scope="module")
def derby(spark):
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(DRIVER)
    except Exception:
        pytest.skip("embedded Derby driver not on the classpath")
    rows = [(10, "alice", "2017-01-01 10:00:00", "iPhone", "1.0", "c1", "os1", "p1", "110105194912310021"),
            (20, "bob", "2017-01-02 10:00:00", "android", "1.1", "c2", "os2", "p2", None),
            (30, "carol", "2017-03-01 10:00:00", "h5", "1.2", "c3", "os3", "p3", "321023199309173032")]
    df = spark.createDataFrame(rows, "n_user_id long, s_login_name string, t string, s_platform_code string, "
                                     "s_app_version string, s_entrance_code string, s_platform_version string, "
                                     "s_phone_name string, s_idcard_number string")
    df = df.selectExpr("*", "to_timestamp(t) as d_register_time").drop("t")
    # upper-case names: Spark quotes identifiers on CREATE, the job's SQL does not
    df = df.toDF(*[c.upper() for c in df.columns])
    df.write.format("jdbc").option("url", URL).option("dbtable", "USERS_T").option("driver", DRIVER) \
        .mode("overwrite").save()
    return {"driver": DRIVER}


def test_scan_users_incremental_pushes_bounds(spark, derby):
    df = scans.scan_users_incremental(spark, URL, "USERS_T", 10, "2017-02-01 00:00:00", derby)
    assert [r[0] for r in df.collect()] == [20]
    wide = scans.scan_users_incremental(spark, URL, "USERS_T", 0, "2018-01-01 00:00:00", derby)
    assert wide.rdd.getNumPartitions() == scans.JDBC_PARTITIONS
    assert sorted(r[0] for r in wide.collect()) == [10, 20, 30]
    assert scans.scan_users_incremental(spark, URL, "USERS_T", 99, "2018-01-01 00:00:00", derby).count() == 0


def test_scans_take_other_column_names(spark, derby):
    names = {"phone_name": "s_login_name"}
    df = scans.scan_users_incremental(spark, URL, "USERS_T", 10, "2017-02-01 00:00:00", derby, columns=names)
    assert [r[0] for r in df.select("phone_name").collect()] == ["bob"]


def test_scan_idcards_partitioned(spark, derby):
    df = scans.scan_idcards_jdbc(spark, URL, "USERS_T", 0, lower_bound=0, upper_bound=40, num_partitions=2,
                                 options=derby)
    assert df.rdd.getNumPartitions() == 2
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(10, "110105194912310021"), (30, "321023199309173032")]
    split = scans.scan_idcards_jdbc(spark, URL, "USERS_T", 0, options=derby)
    assert split.rdd.getNumPartitions() == scans.JDBC_PARTITIONS
    assert sorted(tuple(r) for r in split.collect()) == got


def test_log_job_with_mapping_from_jdbc(spark, derby, tmp_path):
    from userlens.operators.keyed import compact_snapshot, read_latest, read_snapshot
    from userlens.plans import jobs

    def put(df, table):
        df = df.toDF(*[c.upper() for c in df.columns])
        df.write.format("jdbc").option("url", URL).option("dbtable", table).option("driver", DRIVER) \
            .mode("overwrite").save()

    put(spark.createDataFrame([(3, 30), (3, 31)], "action_id long, template_id long"), "MAPPER")
    put(spark.createDataFrame([(30,), (31,)], "id long"), "TEMPLATE")
    put(spark.createDataFrame(
        [(31, "name", "who", "string", None, None, "all", 1),
         (31, "url", "link", "url", "x", "fx", "ALL", 1),
         (30, "name", "old", "string", None, None, "all", 1)],
        "template_id long, attribute string, target_attribute string, datatype string, ps string, "
        "es_ps string, plateform string, status int"), "DETAIL")
    logs = spark.createDataFrame(
        [(7, None, "h5", 3, '{"name": "a", "url": "http://h/p?x=1"}', 1000, 1001, "2024-01-02"),
         (0, "", "h5", 3, '{"name": "b"}', 2000, 2001, "2024-01-02"),
         (8, "d", "ios", 9, "{k=v}", 3000, 3001, "2024-01-03")],
        "uid long, deviceid string, plateform string, eventid int, eventcontent string, begintime long, "
        "uploadtime long, p_day string")
    for c in ["ip", "version", "pmenu", "menu", "net", "channel", "client", "os", "subplateform"]:
        logs = logs.withColumn(c, F.lit(c))
    src = str(tmp_path / "logs")
    logs.write.partitionBy("p_day").parquet(src)
    mapping_src = {"url": URL, "driver": DRIVER,
                   "tables": {"mapper": "MAPPER", "template": "TEMPLATE", "detail": "DETAIL"}}
    root = str(tmp_path / "log_docs")
    jobs.run_build_log_documents(spark, src, "2024-01-01", "2024-01-31", mapping_src, root, version=1)
    docs = {r["uid"]: r for r in read_latest(spark, root, "_id").collect()}
    assert sorted(docs) == [7, 8]
    assert dict(docs[7]["eventcontent"]) == {"source": '{"name": "a", "url": "http://h/p?x=1"}', "who": "a",
                                            "domain": "h", "path": "/p", "fx": "1"}
    assert dict(docs[8]["eventcontent"]) == {"source": '{"k":"v"}'}
    assert docs[7]["eventtime"] == "1970-01-01 00:00:01" and docs[7]["p_day"] == "2024-01-02"

    # re-import with changed content under the same key: the newer document
    # replaces the old one, and only the run's own rows were written
    again = logs.where("uid = 7").withColumn("eventcontent", F.lit('{"name": "z"}'))
    src2 = str(tmp_path / "logs2")
    again.write.partitionBy("p_day").parquet(src2)
    jobs.run_build_log_documents(spark, src2, "2024-01-01", "2024-01-31", mapping_src, root, version=2)
    assert read_snapshot(spark, root).count() == 3
    latest = {r["uid"]: r for r in read_latest(spark, root, "_id").collect()}
    assert sorted(latest) == [7, 8] and latest[7]["eventcontent"]["who"] == "z"
    compact_snapshot(spark, root, "_id", partition_by="p_day")
    assert read_snapshot(spark, root).count() == 2
    assert read_latest(spark, root, "_id").where("uid = 7").first()["eventcontent"]["who"] == "z"


def test_user_document_workflow(spark, derby, tmp_path):
    """Bulk bootstrap -> incremental JDBC load above the high water -> id-card
    enrichment -> tracks; all four write the same keyed user snapshot."""
    from userlens.operators.keyed import read_snapshot
    from userlens.plans import jobs

    root = str(tmp_path / "users")
    lines = tmp_path / "users.txt"
    lines.write_text("10#alice#2017-01-01 10:00:00#c1#os1#iPhone#1.0#p1\n")
    jobs.run_load_users_bulk(spark, str(lines), root, str(tmp_path / "bad"))
    assert jobs.run_load_users_incremental(spark, URL, "USERS_T", root, "2017-02-01 00:00:00",
                                           options=derby) is not None
    jobs.run_enrich_user_idcards(spark, URL, "USERS_T", root, "2024-06-30", min_uid=0,
                                 bounds=(0, 40), options=derby)
    fp = spark.createDataFrame([(20, "d9", "c", "v", "h5", 5, "2024-01-01")],
                               "uid long, deviceid string, channel string, version string, plateform string, "
                               "begintime long, p_day string")
    jobs.run_build_user_tracks(spark, fp, "2024-01-01", "2024-01-31", root)
    got = {r["uid"]: r for r in read_snapshot(spark, root).collect()}
    assert sorted(got) == [10, 20, 30]
    # uid 10's card has a wrong check digit (should end in X): not enriched
    assert got[10]["username"] == "alice" and got[10]["birth_province"] is None
    assert got[20]["username"] == "bob" and got[20]["register_plateform"] == "android"
    assert got[20]["idcard"] is None and len(got[20]["base_track"]) == 1
    assert got[30]["username"] is None and got[30]["birth_province"] == "江苏"


def test_ranges_of_clustered_uids_hold_equal_shares(spark, derby):
    """Most uids in two narrow clusters far apart, one uid repeated, some spread over the whole range."""
    n = 4000
    uid = (F.when(F.col("id") < 1800, F.col("id") + 5).when(F.col("id") < 3600, F.col("id") + 9_000_000_000_000)
           .otherwise((F.col("id") - 3600) * 22_500_000_000 + 7))
    df = spark.range(n).select(uid.alias("N_USER_ID"), F.lit("110105194912310021").alias("S_IDCARD_NUMBER"))
    df.write.format("jdbc").option("url", URL).option("dbtable", "CLUSTERED_T").option("driver", DRIVER).mode("overwrite").save()
    got = scans.scan_idcards_jdbc(spark, URL, "CLUSTERED_T", 0, num_partitions=8, options=derby)
    sizes = sorted(r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
    assert got.select("uid").distinct().count() == n - 1 and sum(sizes) == n
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4] and sizes[0] * 2 >= sizes[4]


def test_ranges_of_one_repeated_uid(spark, derby):
    df = spark.range(50).select(F.lit(7).cast("long").alias("N_USER_ID"), F.lit("x").alias("S_IDCARD_NUMBER"))
    df.write.format("jdbc").option("url", URL).option("dbtable", "SAME_T").option("driver", DRIVER).mode("overwrite").save()
    assert scans.scan_idcards_jdbc(spark, URL, "SAME_T", 0, num_partitions=4, options=derby).count() == 50
