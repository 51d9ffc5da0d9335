"""Snapshot tables: what a failed, empty or repeated write leaves behind, and what a write touches."""

import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from userlens import session
from userlens.operators import keyed as K


def table(spark, n, name="a"):
    return spark.range(n).select(F.col("id").alias("uid"), F.concat(F.lit(name), F.col("id").cast("string")).alias("name"))


def content(spark, root):
    return {r["uid"]: r["name"] for r in K.read_snapshot(spark, root).collect()}


def test_missing_table_is_none_and_anything_else_raises(spark, tmp_path):
    root = str(tmp_path / "t")
    assert K.read_snapshot(spark, root) is None
    K.write_keyed(spark, table(spark, 100), root, "uid")
    files = glob.glob(f"{root}/_manifest/part-*")
    good = open(files[0]).read()
    for broken in ("", "{not json\n"):
        for f in glob.glob(f"{root}/_manifest/.*.crc"):
            os.remove(f)
        open(files[0], "w").write(broken)
        with pytest.raises(Exception):
            K.read_snapshot(spark, root)
        with pytest.raises(Exception):
            K.write_keyed(spark, table(spark, 1, "b"), root, "uid", mode="upsert")
    open(files[0], "w").write(good)
    K.write_keyed(spark, table(spark, 1, "b"), root, "uid", mode="upsert")
    got = content(spark, root)
    assert len(got) == 100 and got[0] == "b0" and got[1] == "a1"


def test_two_writers_of_one_version_are_noticed(spark, tmp_path):
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 3), root, "uid")
    rows = [json.loads(x) for f in glob.glob(f"{root}/_manifest/part-*") for x in open(f)]
    spark.createDataFrame([(r["version"], "other", r["buckets"], r["bucket"], r["path"], r["columns"]) for r in rows], K._MANIFEST).write.mode("append").json(f"{root}/_manifest")
    with pytest.raises(ValueError, match="two writers"):
        K.read_snapshot(spark, root)


def test_crash_between_data_and_publish_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 50), root, "uid")
    before = content(spark, root)
    real = K._commit
    monkeypatch.setattr(K, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        K.write_keyed(spark, table(spark, 60, "b"), root, "uid", mode="upsert")
    assert content(spark, root) == before
    monkeypatch.setattr(K, "_commit", real)
    K.write_keyed(spark, table(spark, 60, "b"), root, "uid", mode="upsert")
    assert content(spark, root) == {i: f"b{i}" for i in range(60)}


def test_a_write_reads_and_rewrites_only_touched_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 500), root, "uid", buckets=8)
    first = {r["bucket"]: r["path"] for r in K.manifest(spark, root)}
    assert len(first) == 8
    touched = K.with_bucket(table(spark, 1), "uid", 8).first()["_bucket"]
    for b, path in first.items():  # were another bucket read, the write would fail
        if b != touched:
            shutil.move(path, path + "-away")
    K.write_keyed(spark, table(spark, 1, "b").withColumn("extra", F.lit(1)), root, "uid", mode="upsert")
    for b, path in first.items():
        if b != touched:
            shutil.move(path + "-away", path)
    second = {r["bucket"]: r["path"] for r in K.manifest(spark, root)}
    assert {b for b in first if first[b] != second[b]} == {touched}
    rows = {r["uid"]: (r["name"], r["extra"]) for r in K.read_snapshot(spark, root).collect()}
    assert len(rows) == 500 and rows[0] == ("b0", 1) and rows[1] == ("a1", None)


def test_files_of_a_run_are_at_most_days_times_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    docs = spark.range(2000).select(F.col("id").cast("string").alias("_id"), F.concat(F.lit("2024-01-0"), (F.col("id") % 5 + 1).cast("string")).alias("p_day"))
    for version in (1, 2):
        path = K.write_keyed(spark, docs.repartition(16), root, "_id", mode="append_versioned", partition_by="p_day", version=version, buckets=4)
        assert len(glob.glob(f"{path}/**/part-*", recursive=True)) <= 5 * 4
    latest = K.read_latest(spark, root, "_id")
    assert latest.count() == 2000 and latest.where("p_day = '2024-01-01'").count() == 400
    K.compact_snapshot(spark, root, "_id", partition_by="p_day")
    assert K.read_snapshot(spark, root).count() == 2000


def test_a_bucket_with_one_run_is_read_without_a_shuffle(spark, tmp_path):
    from test_plans import plan_of
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 100), root, "uid", mode="append_versioned", version=1)
    assert "Exchange" not in plan_of(K.read_latest(spark, root, "uid"))
    K.write_keyed(spark, table(spark, 1, "b"), root, "uid", mode="append_versioned", version=2)
    latest = K.read_latest(spark, root, "uid")
    assert "Exchange" in plan_of(latest)
    assert {r["uid"]: r["name"] for r in latest.collect()} == {i: "b0" if i == 0 else f"a{i}" for i in range(100)}


def test_empty_writes(spark, tmp_path):
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 0), root, "uid")
    assert K.read_snapshot(spark, root).columns == ["uid", "name"] and content(spark, root) == {}
    K.write_keyed(spark, table(spark, 2), root, "uid", mode="upsert")
    K.write_keyed(spark, table(spark, 0), root, "uid", mode="upsert")
    assert content(spark, root) == {0: "a0", 1: "a1"}


def test_increment_tables_are_deleted(spark, tmp_path):
    root = str(tmp_path / "t")
    at = session.ensure_checkpoint_dir(spark).removeprefix("file://")
    K.write_keyed(spark, table(spark, 5), root, "uid")
    before = set(glob.glob(f"{at}/userlens-table-*"))
    K.write_keyed(spark, table(spark, 5, "b"), root, "uid", mode="replace")
    assert set(glob.glob(f"{at}/userlens-table-*")) == before


def test_a_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


@pytest.fixture
def sized(spark):
    """Adaptive execution that joins partitions up to a few KB, so that small tables show how writes are sized."""
    with session.settings(spark, spark__sql__shuffle__partitions="64", spark__sql__files__maxPartitionBytes="64k", spark__sql__files__openCostInBytes="4k", spark__sql__adaptive__advisoryPartitionSizeInBytes="32k",
                          spark__sql__adaptive__coalescePartitions__parallelismFirst="false", spark__sql__adaptive__coalescePartitions__minPartitionSize="16k"):
        yield


def parts(path):
    return glob.glob(f"{path}/**/part-*", recursive=True)


def tasks(path):
    return len({os.path.basename(f).split("-")[1] for f in parts(path)})


def test_tasks_and_files_of_a_write_grow_with_its_rows(spark, tmp_path, sized):
    wide = lambda n: spark.range(n).select(F.col("id").alias("uid"), F.sha2(F.col("id").cast("string"), 512).alias("name"))
    small = K.write_keyed(spark, wide(200), str(tmp_path / "small"), "uid", bucket_bytes=16 << 10)
    large = K.write_keyed(spark, wide(20_000), str(tmp_path / "large"), "uid", bucket_bytes=16 << 10)
    assert tasks(small) <= 2 and tasks(large) >= 40 * tasks(small)
    size = [os.path.getsize(f) for f in parts(large)]
    assert 64 <= len(size) <= 3 * 256 and max(size) <= 3 * sorted(size)[len(size) // 2]
    assert len(content(spark, str(tmp_path / "large"))) == 20_000


def test_a_fixed_number_of_buckets_is_still_split_by_size(spark, tmp_path, sized):
    wide = spark.range(20_000).select(F.col("id").alias("uid"), F.sha2(F.col("id").cast("string"), 512).alias("name"))
    path = K.write_keyed(spark, wide.repartition(16), str(tmp_path / "t"), "uid", buckets=1, file_rows=1000)
    assert tasks(path) > 8
    assert max(spark.read.parquet(f).count() for f in parts(path)[:5]) <= 1000
    assert content(spark, str(tmp_path / "t")).keys() == set(range(20_000))


def test_an_increment_rewrites_only_files_with_its_keys(spark, tmp_path):
    root, n = str(tmp_path / "t"), 8000
    first = K.write_keyed(spark, table(spark, n), root, "uid", buckets=4, file_rows=8)
    files = set(parts(first))
    assert len(files) >= n // 8
    few = spark.range(0, n, 100).select(F.col("id").alias("uid"), F.lit("new").alias("name"))  # 1 % of the keys, spread
    K.write_keyed(spark, few, root, "uid", mode="upsert", file_rows=8)
    live = {f for r in K.manifest(spark, root) for f in ([r["path"]] if r["path"].endswith(".parquet") else parts(r["path"]))}
    assert len(files - live) <= 0.1 * len(files)
    got = content(spark, root)
    assert len(got) == n and all(got[i] == ("new" if i % 100 == 0 else f"a{i}") for i in range(n))


def test_new_keys_rewrite_nothing_and_replace_equals_a_plain_merge(spark, tmp_path):
    root = str(tmp_path / "t")
    first = K.write_keyed(spark, table(spark, 1000), root, "uid", file_rows=50)
    new = spark.range(5000, 5100).select(F.col("id").alias("uid"), F.lit("n").alias("name"))
    K.write_keyed(spark, new, root, "uid", mode="upsert")
    live = [r["path"] for r in K.manifest(spark, root)]
    assert any(p.startswith(first) and not p.endswith(".parquet") for p in live) and len(content(spark, root)) == 1100
    before = K.read_snapshot(spark, root)
    mixed = spark.range(900, 5050, 25).select(F.col("id").alias("uid"), F.lit(1).alias("other"))
    for mode, plain in (("replace", K.merge_replace), ("upsert", K.merge_upsert)):
        want = sorted(map(tuple, plain(before, mixed, "uid").collect()))
        K.write_keyed(spark, mixed, root, "uid", mode=mode)
        assert sorted(map(tuple, K.read_snapshot(spark, root).select("uid", "name", "other").collect())) == want
        before = K.read_snapshot(spark, root)


def test_a_table_gets_more_buckets_as_its_writes_grow(spark, tmp_path):
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 100), root, "uid", bucket_bytes=4000)
    K.write_keyed(spark, table(spark, 20_000, "b"), root, "uid", mode="upsert", bucket_bytes=4000)
    assert max(r["buckets"] for r in K.manifest(spark, root)) >= 16
    K.write_keyed(spark, table(spark, 10, "c"), root, "uid", mode="upsert", bucket_bytes=4000)
    got = content(spark, root)
    assert len(got) == 20_000 and got[9] == "c9" and got[10] == "b10"
    assert [r["name"] for r in K.lookup(spark, root, "uid", [9, 10, 777_777]).orderBy("uid").collect()] == ["c9", "b10"]
    assert K.lookup(spark, str(tmp_path / "none"), "uid", [1]) is None


def test_versioned_runs_of_different_buckets_resolve_to_the_latest(spark, tmp_path):
    root = str(tmp_path / "t")
    for v, n in ((1, 300), (2, 8000), (3, 50)):
        K.write_keyed(spark, table(spark, n, f"v{v}-"), root, "uid", mode="append_versioned", version=v, bucket_bytes=4000)
    assert len({r["buckets"] for r in K.manifest(spark, root)}) > 1
    for _ in range(2):
        got = {r["uid"]: r["name"] for r in K.read_latest(spark, root, "uid").collect()}
        assert len(got) == 8000 and got[0] == "v3-0" and got[100] == "v2-100"
        K.compact_snapshot(spark, root, "uid")


def test_files_carry_bloom_filters_of_the_key(spark, tmp_path):
    docs = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("_id"), F.lit(1).alias("v"))
    with_key = K.write_keyed(spark, docs, str(tmp_path / "t"), "_id")
    docs.coalesce(1).sortWithinPartitions("_id").write.parquet(str(tmp_path / "plain"))
    bare = sum(os.path.getsize(f) for f in parts(str(tmp_path / "plain")))
    assert sum(os.path.getsize(f) for f in parts(with_key)) > bare + 500  # the filter's bytes


def test_the_second_of_two_writers_fails_alone(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 10), root, "uid")
    stale = K.manifest(spark, root)
    K.write_keyed(spark, table(spark, 5, "b"), root, "uid", mode="upsert")
    with monkeypatch.context() as m:
        m.setattr(K, "manifest", lambda *_: stale)
        with pytest.raises(RuntimeError, match="another writer"):
            K.write_keyed(spark, table(spark, 5, "c"), root, "uid", mode="upsert")
    assert content(spark, root)[0] == "b0"
    K.write_keyed(spark, table(spark, 5, "d"), root, "uid", mode="upsert")
    assert content(spark, root) == {i: f"d{i}" if i < 5 else f"a{i}" for i in range(10)}


def test_a_claim_without_manifest_is_void_after_a_while(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    K.write_keyed(spark, table(spark, 10), root, "uid")
    assert K._claimed(spark, f"{root}/_claims/{2:020d}")  # its writer dies now
    with pytest.raises(RuntimeError, match="another writer"):
        K.write_keyed(spark, table(spark, 5, "b"), root, "uid", mode="upsert")
    monkeypatch.setattr(K, "CLAIM_SECONDS", -1)
    K.write_keyed(spark, table(spark, 5, "b"), root, "uid", mode="upsert")
    assert content(spark, root)[0] == "b0"
    K.write_keyed(spark, table(spark, 5, "c"), root, "uid", mode="upsert")
    assert content(spark, root)[0] == "c0"


def test_rows_without_a_key_are_documents_each(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = [(1, "a"), (1, "b"), (None, "x"), (None, "x"), (None, "y")]
    docs = spark.createDataFrame(rows, "uid long, name string")
    assert K.dedup_by_key(docs, "uid").count() == 4
    K.write_keyed(spark, docs, root, "uid")
    K.write_keyed(spark, docs, root, "uid", mode="upsert")
    assert sorted(str(r["name"]) for r in K.read_snapshot(spark, root).where("uid is null").collect()) == list("xxxxyy")
    assert K.read_snapshot(spark, root).where("uid = 1").count() == 1
    many = spark.range(4000).select(F.lit(None).cast("long").alias("uid"), F.lit("same").alias("name"))
    K.write_keyed(spark, many, str(tmp_path / "many"), "uid", buckets=8)
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/many/data").groupBy("_bucket").count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 4000 and max(sizes) < 1000


def test_largest_value_comes_from_the_footers(spark, tmp_path):
    from test_plans import plan_of
    root = str(tmp_path / "t")
    assert K.largest_value(spark, root, "uid") is None
    K.write_keyed(spark, table(spark, 0), root, "uid")
    assert K.largest_value(spark, root, "uid") is None
    K.write_keyed(spark, table(spark, 500), root, "uid", mode="upsert", buckets=4)
    assert K.largest_value(spark, root, "uid") == 499
    with session.settings(spark, **K.FOOTERS):
        rows = K.manifest(spark, root)
        plan = plan_of(K.largest(spark, [r["path"] for r in rows if r["bucket"] >= 0], K._schema(rows), "uid"))
    assert "PushedAggregation: [MAX(uid)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
