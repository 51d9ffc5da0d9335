"""Mergeable tracks: runs over several day ranges add up to one."""

import random

from pyspark.sql import functions as F

from userlens.operators.aggregates import merge_tracks
from userlens.operators.keyed import read_snapshot, write_keyed
from userlens.plans import jobs

FOOTPRINT = "uid long, deviceid string, channel string, version string, plateform string, begintime long, p_day string"


def footprint(seed, n=600):
    r = random.Random(seed)
    return [(r.randrange(1, 20), f"d{r.randrange(4)}", r.choice(["c", None]), r.choice(["v1", "v2"]), r.choice(["ios", "h5"]),
             r.choice([None] + [r.randrange(10**12)] * 9), f"2024-01-{r.randrange(1, 31):02d}") for _ in range(n)]


def tracks(spark, root):
    return {r["uid"]: [tuple(t) for t in r["base_track"]] for r in read_snapshot(spark, root).collect() if r["base_track"] is not None}


def test_ranges_add_up_to_one_run_in_any_order_and_repeated(spark, tmp_path):
    fp = spark.createDataFrame(footprint(1), FOOTPRINT)
    ranges = [("2024-01-01", "2024-01-09"), ("2024-01-10", "2024-01-20"), ("2024-01-21", "2024-01-31")]
    jobs.run_build_user_tracks(spark, fp, "2024-01-01", "2024-01-31", str(tmp_path / "one"))
    want = tracks(spark, str(tmp_path / "one"))
    assert len(want) == 19
    for name, order in (("forth", ranges), ("back", ranges[::-1]), ("again", [*ranges, ranges[1], ranges[0]])):
        for a, b in order:
            jobs.run_build_user_tracks(spark, fp, a, b, str(tmp_path / name))
        assert tracks(spark, str(tmp_path / name)) == want


def test_other_fields_and_users_without_tracks_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    write_keyed(spark, spark.createDataFrame([(1, "a"), (99, "b")], "uid long, username string"), root, "uid")
    jobs.run_build_user_tracks(spark, spark.createDataFrame([(1, "d", "c", "v", "h5", 5, "2024-01-01")], FOOTPRINT), "2024-01-01", "2024-01-31", root)
    got = {r["uid"]: r for r in read_snapshot(spark, root).collect()}
    assert got[1]["username"] == "a" and len(got[1]["base_track"]) == 1
    assert got[99]["username"] == "b" and got[99]["base_track"] is None


def test_merge_of_null_and_equal_tracks(spark):
    t = "array<struct<deviceid:string,channel:string,app_version:string,plateform:string,firstUseTime:string>>"
    a, b = [("d", "c", None, "p", "2024-01-02 00:00:00")], [("d", "c", None, "p", "2024-01-01 00:00:00"), ("e", "c", "v", "p", "2024-01-03 00:00:00")]
    df = spark.createDataFrame([(1, a, b), (2, None, b), (3, a, None), (4, None, None), (5, [], a)], f"id int, o {t}, n {t}")
    got = {r["id"]: r["m"] if r["m"] is None else [tuple(x) for x in r["m"]] for r in df.select("id", merge_tracks(F.col("o"), F.col("n")).alias("m")).collect()}
    assert got == {1: b, 2: b, 3: a, 4: None, 5: a}


def test_bulk_load_reads_its_file_once(spark, tmp_path, monkeypatch):
    from test_plans import plan_of

    src = tmp_path / "users.txt"
    src.write_text("1#a#2017-01-01 10:00:00#c#o#iPhone#1#p\nbroken\n2#b#2017-01-02 10:00:00#c#o#h5#1#p\n0#z#2017-01-02 10:00:00#c#o#h5#1#p\n")
    plans = []
    real = jobs.materialize

    def noted(df, *split):
        out, path = real(df, *split)
        plans.append((plan_of(df), plan_of(jobs.good_registrations(out)), plan_of(jobs.quarantined_lines(out))))
        return out, path

    monkeypatch.setattr(jobs, "materialize", noted)
    jobs.run_load_users_bulk(spark, str(src), str(tmp_path / "t"), str(tmp_path / "bad"))
    (parsed, good, bad), = plans
    assert "users.txt" in parsed and "users.txt" not in good + bad
    for p in (good, bad):
        assert "PartitionFilters: [isnotnull(bad" in p
    assert sorted(r["uid"] for r in read_snapshot(spark, str(tmp_path / "t")).collect()) == [1, 2]
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "bad")).collect()) == ["0#z#2017-01-02 10:00:00#c#o#h5#1#p", "broken"]
