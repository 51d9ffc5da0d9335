"""Golden vectors for the id-card columns (FIXTURES.md §2)."""

from pyspark.sql import functions as F

from userlens.functions import idcard as idc
from userlens.plans.jobs import idcard_documents

AS_OF = "2026-12-03"


def enrich_all(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "uid long, idcard string")
    out = idc.with_enriched_idcard(df, AS_OF)
    return {r["uid"]: (r["idcard"], r["gender"], r["birth_province"], r["birthday"])
            for r in out.collect()}


def test_valid_18_and_fields(spark):
    got = enrich_all(spark, ["321023199309173032", "11010519491231002X", "11010519491231002x",
                             "121212121212121212"])
    assert got[0] == ("321023199309173032", 1, "江苏", "1993-09-17 00:00:00")
    assert got[1][1:3] == (2, "北京") and got[2][1:3] == (2, "北京")
    assert got[3] == ("", -1, "", "")


def test_fifteen_digit_conversion_is_lenient(spark):
    df = spark.createDataFrame([("142431199001145",), ("130503670401001",)], "s string")
    df = idc.with_converted_15(df, "s", "c", AS_OF)
    df = idc.with_valid_15_strict(df, "s", "strict", AS_OF)
    got = [(r["c"], r["strict"]) for r in df.collect()]
    assert got[0] == ("142431202690011457", False)
    assert got[1] == ("130503196704010016", True)
    e = enrich_all(spark, ["142431199001145"])[0]
    assert e == ("142431199001145", 2 if int("142431202690011457"[16]) % 2 == 0 else 1, "山西",
                 "2033-06-01 00:00:00")


def test_invalid_inputs_and_padding(spark):
    got = enrich_all(spark, ["14243119900114A", None, "", "32102319930917303",
                             " 321023199309173032 "])
    for i in range(4):
        assert got[i] == ("", -1, "", "")
    assert got[4] == (" 321023199309173032 ", 1, "江苏", "1993-09-17 00:00:00")


def test_unknown_province_kept(spark):
    # valid checksum for a 99 prefix: build it with the library itself
    df = spark.createDataFrame([("99102319930917303",)], "h string")
    code = df.select(idc.check_code(idc.power_sum("h"))).first()[0]
    got = enrich_all(spark, ["99102319930917303" + code.upper()])[0]
    assert got[1] in (1, 2) and got[2] == ""


def test_documents_keep_only_valid(spark):
    df = spark.createDataFrame([(1, "321023199309173032"), (2, "121212121212121212"), (3, None)],
                               "uid long, idcard string")
    assert [r["uid"] for r in idcard_documents(df, AS_OF).collect()] == [1]


def test_formats(spark):
    df = spark.createDataFrame([("321023199309173032",), ("130503670401001",), ("1305036704010|1",),
                                ("123\n",), (None,)], "s string")
    got = df.select(idc.format_any("s"), idc.format_15("s"), idc.format_18("s")).collect()
    assert tuple(got[0]) == (True, False, True)
    assert tuple(got[1]) == (True, True, False)
    assert tuple(got[3]) == (False, False, False)
    assert tuple(got[4]) == (False, False, None)


def test_two_digit_year_boundary(spark):
    # window starts 1946-12-03 for AS_OF: '46' resolves by the full date
    df = spark.createDataFrame([(46, 12, 2), (46, 12, 4), (45, 1, 1), (47, 1, 1)], "y int, m int, d int")
    got = df.select(F.year(idc.two_digit_year_date(F.col("y"), F.col("m"), F.col("d"), AS_OF))).collect()
    assert [r[0] for r in got] == [2046, 1946, 2045, 1947]
