
from userlens.functions.keys import event_key
from userlens.functions.text import java_split, jtrim, normalize_platform, null_to_empty_trim
from userlens.functions.time import epoch_ms_time_string, event_clock


def one(spark, expr, schema="s string", value=None):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).first()[0]


def test_jtrim_strips_control_chars(spark):
    assert one(spark, jtrim("s"), value="\t a \n\x00") == "a"
    assert one(spark, jtrim("s"), value="a b") == "a b"
    assert one(spark, null_to_empty_trim("s"), value=None) == ""


def test_java_split_drops_trailing_empties(spark):
    assert one(spark, java_split("s", "="), value="a=b==") == ["a", "b"]
    assert one(spark, java_split("s", "="), value="=v") == ["", "v"]
    assert one(spark, java_split("s", "="), value="k=") == ["k"]
    assert one(spark, java_split("s", "="), value="==") == []
    assert one(spark, java_split("s", "="), value="") == [""]


def test_normalize_platform(spark):
    assert one(spark, normalize_platform("s"), value=" iPhone ") == "ios"
    assert one(spark, normalize_platform("s"), value="Android") == "android"


def test_event_key_null_device_concatenates_as_text(spark):
    df = spark.createDataFrame([(7, None, 3, 1000)], "uid long, dev string, e int, t long")
    got = df.select(event_key("uid", "dev", "e", "t")).first()[0]
    import hashlib
    assert got == hashlib.md5(b"7null31000").hexdigest()


def test_event_clock_and_null_time(spark):
    df = spark.createDataFrame([(1704067207179,), (None,)], "t long")
    c = event_clock("t")
    got = df.select(c["hour"], c["minute"], c["eventtime"], epoch_ms_time_string("t")).collect()
    assert tuple(got[0]) == (0, 0, "2024-01-01 00:00:07", "2024-01-01 00:00:07")
    assert tuple(got[1])[2:] == ("1970-01-01 00:00:00", "1970-01-01 00:00:00")
