"""Property checks, each over one frame of generated cases."""

import random

from pyspark.sql import functions as F

from userlens.functions import idcard as idc
from userlens.operators import joins as J
from userlens.plans import jobs


def test_fifteen_to_eighteen_always_valid(spark):
    rnd = random.Random(7)
    ids = ["".join(rnd.choice("0123456789") for _ in range(15)) for _ in range(2000)]
    df = idc.with_converted_15(spark.createDataFrame([(i,) for i in ids], "s string"), "s", "c", "2024-06-30")
    bad = df.where(~idc.valid_18("c") | (F.length("c") != 18)).count()
    assert bad == 0


def test_except_semi_equals_anti_not_null(spark):
    rnd = random.Random(11)
    keys = [rnd.choice([None] + [str(k) for k in range(40)]) for _ in range(500)]
    src = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "uuid string, v int")
    existing = spark.createDataFrame([(str(k),) for k in range(0, 40, 3)], "uuid string")
    semi = J.semi_join_new_orders(src, J.except_keys(src.select("uuid"), existing))
    anti = J.anti_join_new_orders(src, existing)
    assert sorted(r["v"] for r in semi.collect()) == sorted(r["v"] for r in anti.collect())


def test_input_order_does_not_change_outputs(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 20), f"d{rnd.randint(1, 5)}", "c", "v", rnd.choice(["ios", "h5"]),
             rnd.choice([None, rnd.randint(0, 10 ** 6)])) for _ in range(3000)]
    schema = "uid long, deviceid string, channel string, version string, plateform string, begintime long"
    a = spark.createDataFrame(rows, schema)
    b = spark.createDataFrame(list(reversed(rows)), schema).repartition(7)
    ta = sorted((r["uid"], str(r["base_track"])) for r in jobs.user_tracks(a).collect())
    tb = sorted((r["uid"], str(r["base_track"])) for r in jobs.user_tracks(b).collect())
    assert ta == tb
