"""iOS pairs, payload key quirks and URL attributes (FIXTURES.md §2)."""

import json

from pyspark.sql import functions as F

from userlens.functions import payload as P
from userlens.functions.entries import entries_json
from userlens.functions.url import raw_query_pairs, renamed_query_params, url_domain_path, url_fields_map


def pairs_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    return [json.loads(r[0]) if r[0] is not None else None
            for r in df.select(entries_json(P.ios_pairs("c"))).collect()]


def test_ios_pairs(spark):
    got = pairs_of(spark, ["{a=1; b=2;\tc=}", "{a=b=c;d=e=}", "{=v}", "{a=1;a=2}", "{hello}"])
    assert got == [{"a": "1", "b": "2"}, {"d": "e"}, {"": "v"}, {"a": "2"}, {}]


def test_source_text_keeps_raw_when_no_pair_or_not_ios(spark):
    rows = [("ios", "{hello}"), ("ios", "  "), ("ios", None), ("iOS", "{a=1}"), ("ios", "{a=1}")]
    df = spark.createDataFrame(rows, "p string, c string")
    got = [r[0] for r in df.select(P.source_text("p", "c")).collect()]
    assert got == ["{hello}", "  ", None, "{a=1}", '{"a":"1"}']


MAPPING = [("name", "who", "string", None, None, "all"), ("Name", "never", "string", None, None, "all"),
           ("url", "link", "url", "x,z,q", "fx,fz", "ALL")]


def payload_of(spark, plat, content, mapping=MAPPING):
    schema = ("p string, c string, attrs array<struct<attribute:string,target_attribute:string,"
              "datatype:string,ps:string,es_ps:string,plateform:string>>")
    df = spark.createDataFrame([(plat, content, sorted(mapping))], schema)
    out = P.with_event_payload(df, "p", "c", "attrs", "m")
    return json.loads(out.select(P.payload_json("m")).first()[0])


def test_key_case_quirk(spark):
    src = '{"Name":"a"}'
    assert payload_of(spark, "h5", src) == {"source": src, "who": ""}
    src = '{"name":"a"}'
    assert payload_of(spark, "h5", src) == {"source": src, "who": "a"}


def test_url_attribute(spark):
    src = '{"url":"http://h.com:8080/a//b///c?x=1&y=2=3&z=#f"}'
    got = payload_of(spark, "android", src)
    # y=2=3 has three parts (dropped); the fragment stays in z's value
    assert got == {"source": src, "domain": "h.com", "path": "/a/b//c", "fx": "1", "fz": "#f"}
    src = '{"url":"foo://h/a"}'
    assert payload_of(spark, "android", src) == {"source": src}


def test_platform_gate_and_malformed(spark):
    m = [("name", "who", "string", None, None, "ios")]
    assert payload_of(spark, "IOS", '{"name":"a"}', m)["who"] == "a"
    assert "who" not in payload_of(spark, "h5", '{"name":"a"}', m)
    assert payload_of(spark, None, '{"name":"a"}', m) == {"source": '{"name":"a"}'}
    assert payload_of(spark, "h5", "not json") == {"source": "not json"}


def test_url_vectors(spark):
    urls = ["http://h.com:8080/a//b///c?x=1&y=2=3&z=#f", "http://h/a b?x=1", "http://h/p?a=1?b=2",
            "HTTPS://Ab.com", "foo://h/a", "/a/b", ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    dp = url_domain_path("u")
    raw = raw_query_pairs("u")
    got = df.select(dp["domain"], dp["path"],
                    F.transform(raw, lambda p: F.concat(p["key"], F.lit("="), p["value"]))).collect()
    assert tuple(got[0]) == ("h.com", "/a/b//c", ["x=1", "z=#f"])
    assert tuple(got[1]) == ("h", "/a b", ["x=1"])
    assert tuple(got[2]) == ("h", "/p", ["a=1"])
    assert tuple(got[3]) == ("Ab.com", "", [])
    assert [tuple(r)[:2] for r in got[4:]] == [(None, None)] * 3


def test_rename_truncates_and_last_wins(spark):
    df = spark.createDataFrame([("http://h/?x=1&z=2&q=3",)], "u string")
    ren = renamed_query_params("u", F.lit("x,z,q"), F.lit("fx,fz"))
    assert [tuple(r) for r in df.select(F.explode(ren)).select("col.*").collect()] == [("fx", "1"), ("fz", "2")]
    ren = renamed_query_params("u", F.lit("x,x"), F.lit("a,b"))
    assert [tuple(r) for r in df.select(F.explode(ren)).select("col.*").collect()] == [("b", "1")]
    assert json.loads(df.select(url_fields_map("u", F.lit("x"), F.lit("fx"))).first()[0]) == \
        {"domain": "h", "path": "/", "fx": "1"}


def test_let_binds_a_value(spark):
    from userlens.functions.entries import let
    df = spark.createDataFrame([([1, 2, 3],)], "a array<int>")
    got = df.select(let(F.reverse("a"), lambda r: F.transform("a", lambda x: x + F.element_at(r, 1)))).first()[0]
    assert got == [4, 5, 6]


def test_whole_text_must_be_one_json_object(spark):
    texts = ['{"a":1}', ' {"a":1} ', '{"a":1} xyz', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '[{"a":1}]', "[]", "1", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(P.parse_payload("s").isNotNull().alias("ok"))
    assert [r[0] for r in df.collect()] == [True, True] + [False] * 8


def test_url_acceptance(spark):
    cases = {"file:///var//log/a?x=1": ("", "/var/log/a"), "http://h.com:abc/p": (None, None), "http://[::1]:80/p": ("[::1]", "/p"),
             "http://u:p@h.com:8080/p": ("h.com", "/p"), "http://h.com:/p": ("h.com", "/p"), "http://[::1/p": (None, None),
             "http://h:99999999999/p": (None, None), "http:/p": ("", "/p"), "mail:x": (None, None)}
    d = url_domain_path("u")
    df = spark.createDataFrame([(u,) for u in cases], "u string").select("u", d["domain"], d["path"])
    assert {r[0]: (r[1], r[2]) for r in df.collect()} == cases


def test_cost_of_many_pairs_is_about_linear(spark):
    import time

    from pyspark.sql import functions as F

    def seconds(pairs):
        text = "{" + ";".join(f"key{i}=value{i}" for i in range(pairs)) + "}"
        df = spark.range(400).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("c")).select(F.size(P.ios_pairs("c")).alias("n"))
        best = 1e9
        for _ in range(4):
            t = time.perf_counter()
            assert df.agg(F.min("n")).first()[0] in (pairs, pairs + 1)
            best = min(best, time.perf_counter() - t)
        return best

    assert seconds(160) < 6 * seconds(40) + 0.3
