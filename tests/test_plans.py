"""Plan shape checks through the public explain() output."""

import contextlib
import io

import pytest

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def Q():
    import __spark_entry__ as E
    return E.QUERIES


def test_tracks_prune_columns_and_combine_before_shuffle(spark, Q):
    p = plan_of(Q["tracks_by_user"](spark, SF))
    read = [l for l in p.splitlines() if l.startswith("ReadSchema")]
    assert read and all("props" not in l and "value" not in l for l in read)
    assert "partial_min" in p and "partial_collect_list" in p


def test_log_documents_broadcasts_mapping_and_dedups_partially(spark, Q):
    p = plan_of(Q["log_documents"](spark, SF))
    assert "BroadcastHashJoin" in p
    assert "partial_max(struct" in p and "max_by" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_no_python_udf_anywhere(spark, Q):
    for name, fn in Q.items():
        p = plan_of(fn(spark, SF))
        assert "EvalPython" not in p, name


def test_order_sync_reads_only_needed_columns(spark, Q):
    p = plan_of(Q["orders_except_keys"](spark, SF))
    assert "o_totalprice" not in p


def test_day_bound_prunes_folders_and_filters_are_pushed(spark, tmp_path):
    from userlens.sources import scans
    from userlens.sources.derived import behaviour_logs
    src = str(tmp_path / "logs")
    behaviour_logs(spark, SF).repartition("p_day").write.partitionBy("p_day").parquet(src)
    p = plan_of(scans.scan_footprint_logs(spark, src, "2024-01-05", "2024-01-06"))
    found = [l for l in p.splitlines() if l.startswith("PartitionFilters")]
    assert found and "2024-01-05" in found[0] and "2024-01-06" in found[0]
    pushed = [l for l in p.splitlines() if l.startswith("PushedFilters")]
    assert pushed and "GreaterThan(uid,0)" in pushed[0] and "IsNotNull(deviceid)" in pushed[0]
    assert "eventcontent" not in next(l for l in p.splitlines() if l.startswith("ReadSchema"))
    days = {r[0] for r in scans.scan_logs_by_day(spark, src, "2024-01-05", "2024-01-06").select("p_day").distinct().collect()}
    assert days == {"2024-01-05", "2024-01-06"}


def test_order_sync_drops_known_orders_before_the_dedup(spark, Q):
    p = plan_of(Q["orders_sync_new"](spark, SF))
    tree = p.split("(1) ", 1)[0]
    join = min(tree.index(j) for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if j in tree)
    assert "LeftAnti" in p and tree.index("Aggregate") < join  # the tree is printed from the result down


def test_known_orders_are_kept_out_of_the_shuffle_by_a_bloom_filter(spark, tmp_path):
    from pyspark.sql import functions as F

    from userlens.operators.joins import anti_join_new_orders, may_contain

    n = 20_000  # 99 % known
    orders = spark.range(n).select(F.when(F.col("id") % 500 != 7, F.concat(F.lit("o"), (F.col("id") - F.col("id") % 3).cast("string"))).alias("uuid"),
                                   F.sha2(F.col("id").cast("string"), 512).alias("wide"))
    orders.write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    known = spark.range(n).where("id < 19800").select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("uuid"))
    plain = anti_join_new_orders(orders, known)
    fast = anti_join_new_orders(orders, known, mostly_known=True)
    assert fast.columns == plain.columns
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, plain.collect())) and fast.count() > 150
    assert anti_join_new_orders(orders, known.limit(0), mostly_known=True).count() == orders.where("uuid is not null").count()
    assert anti_join_new_orders(orders.limit(0), known, mostly_known=True).count() == 0
    assert "getbit" in plan_of(fast) and "getbit" not in plan_of(plain)
    new = known.select(F.concat(F.lit("x"), F.col("uuid")).alias("uuid")).limit(1000)
    passed = orders.where("uuid is not null").where(may_contain(new, "uuid", F.col("uuid"))).count()
    assert passed < n // 50  # what reaches the shuffle of a plain semi join: none of these keys is in orders
    assert new.where(may_contain(new, "uuid", F.col("uuid"))).count() == 1000
    assert orders.where(may_contain(new, "uuid", F.col("uuid"), bits=64)).count() >= passed  # full: more rows pass, none is lost
