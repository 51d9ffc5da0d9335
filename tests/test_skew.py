"""Whole results under skew and on the no-broadcast path."""

from pyspark.sql import functions as F

from userlens.operators import keyed as K
from userlens.plans import jobs, queries as Q

SF = "/root/testdata/sf0.001"


def test_hot_key_keeps_every_track(spark):
    # uid 1 holds a third of all rows, spread over 50 devices
    rows = [(1, f"d{i % 50}", "c", "v", "ios", i) for i in range(3000)]
    rows += [(2 + i % 100, f"e{i}", "c", "v", "h5", i) for i in range(6000)]
    fp = spark.createDataFrame(rows, "uid long, deviceid string, channel string, version string, "
                                     "plateform string, begintime long").repartition(8)
    tracks = {r["uid"]: r["base_track"] for r in jobs.user_tracks(fp).collect()}
    assert len(tracks[1]) == 50
    assert sum(len(t) for u, t in tracks.items() if u != 1) == 6000
    first = {t["deviceid"]: t["firstUseTime"] for t in tracks[1]}
    assert first["d0"] == "1970-01-01 00:00:00" and first["d49"] == "1970-01-01 00:00:00"


def test_hot_key_dedup(spark):
    rows = [("hot", i, f"v{i}") for i in range(3000)] + [(f"k{i}", i, "x") for i in range(6000)]
    df = spark.createDataFrame(rows, "id string, t int, v string").repartition(8)
    out = {r["id"]: (r["t"], r["v"]) for r in K.dedup_by_key(df, "id", [F.col("t")]).collect()}
    assert len(out) == 6001 and out["hot"] == (2999, "v2999")


def test_mapping_join_without_broadcast_is_identical(spark):
    logs = Q._logs(spark, SF)
    mapping = Q._mapping(spark, SF)
    a = jobs.log_documents(logs, mapping)
    b = jobs.log_documents(logs, mapping, max_broadcast_bytes=-1)
    def norm(df):
        return sorted((r["_id"], str(sorted(r["eventcontent"].items()))) for r in df.collect())
    assert norm(a) == norm(b)
