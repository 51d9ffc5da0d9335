"""The stages one after the other against plain versions of their decisions, and the oracles."""

import os

import pytest

from brute import contamination, jaccard_components, secrets as plain_secrets
from userlens.llm.shared import components, written

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "labels"]


def test_stages(spark, real):
    import corpus_pipeline as cp

    docs, _ = real
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {}
    for name, stage in cp.STAGES[:-1]:
        before = docs.select("doc_id", "text").collect()
        docs = written(stage(spark, docs, SF), "test-" + name)
        got[name] = before, {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = got["near_duplicates"]
    assert set(after) == {i for i, (_, c) in jaccard_components([tuple(r) for r in before], percent=80, words=5).items() if i == c}
    before, after = got["benchmark_decontamination"]
    assert set(after) == {r["doc_id"] for r in before if not contamination(r["text"], items)[1]}
    before, after = got["secret_scans"]
    assert set(after) == {r["doc_id"] for r in before}
    for r in before:
        now = after[r["doc_id"]]
        assert not plain_secrets(now["text"]) and now["n_chars"] == len(now["text"])
        assert plain_secrets(r["text"]) or now["text"] == r["text"]
    pieces = cp.STAGES[-1][1](spark, docs, SF).collect()
    assert {p["doc_id"] for p in pieces} == set(after)


def test_quality_stage_keeps_what_is_labelled_good(spark, real):
    import corpus_pipeline as cp

    docs, rows = real
    kept = {r["doc_id"] for r in cp.quality_rules(spark, docs, SF).select("doc_id").collect()}
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    long_enough = {i for i, t in rows if len((t or "").split()) >= 50}
    good = [i for i, q in labels if q == 1 and i in long_enough]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert {i for i in kept} <= long_enough


def test_components_of_a_path_a_star_and_a_pair(spark):
    edges = [(k, k + 1) for k in range(1, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(1, 31), 1), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("name", ["op5_jaccard_join", "op7_decontamination", "op10_secret_scans"])
def test_queries_match_their_oracles(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    duckdb = pytest.importorskip("duckdb")
    from tools.compare import digest
    from userlens.llm.oracles import ORACLE_SQL
    from userlens.llm.queries import QUERIES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns) and rows
    assert digest(df.columns, rows)[0] == digest(cols, cur.fetchall())[0]


def test_signature_ties_connect_every_id_of_a_signature_over_many_tasks(spark):
    from pyspark.sql import functions as F

    from userlens.llm.jaccard import signature_ties
    from userlens.llm.shared import ship

    ship(spark)
    rows = spark.range(6000).select((F.col("id") % 5).cast("long").alias("sig"), (F.col("id") * 7 % 3001).alias("doc_id"))
    hot = rows.withColumn("sig", F.when(F.col("doc_id") < 2000, F.lit(1)).otherwise(F.col("sig") + F.col("doc_id") * 10))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["node"]: r["component"] for r in components(signature_ties(hot)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = {}
    for r in hot.collect():
        groups.setdefault(r["sig"], set()).add(r["doc_id"])
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for ids in groups.values():
        for i in ids:
            a, b = sorted((find(i), find(min(ids))))
            up[b] = a
    assert {i: c for i, c in got.items()} == {i: find(i) for i in up if sum(find(j) == find(i) for j in up) > 1}


PROSE = "\n".join(f"The {w} harbour was quiet in the early morning, and {w} boats came home with {w} nets and tired crews." for w in "north south east west upper lower inner outer".split())
EDGE = [(1, None), (2, ""), (3, " \n "), (4, PROSE), (4, PROSE), (5, PROSE), (None, PROSE), (None, None), (6, PROSE + "\ntoken = abcdefgh123"), (7, "short")]


def test_stages_on_nulls_repeats_and_clashing_names(spark, docs_of):
    import corpus_pipeline as cp

    docs = docs_of(EDGE, True)
    got = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got[name] = sorted((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] is not None), sum(r["doc_id"] is None for r in out.select("doc_id").collect())
    kept, without_id = got["quality_rules"]
    assert {i for i, _ in kept} <= {4, 5, 6} and without_id <= 1
    kept, without_id = got["near_duplicates"]
    assert kept == [(1, None), (2, ""), (3, " \n "), (4, PROSE), (7, "short")] and without_id == 2
    with_id = sorted(((i, t) for i, t in EDGE if i is not None), key=lambda r: (r[0], r[1] or ""))
    kept, without_id = got["benchmark_decontamination"]
    assert kept == with_id and without_id == 2
    kept, without_id = got["secret_scans"]
    assert kept == [(i, t.replace("token = abcdefgh123", "[REDACTED]") if t else t) for i, t in with_id] and without_id == 2
    pieces = cp.STAGES[-1][1](spark, docs, SF)
    assert pieces.filter("start = 0").count() == len(EDGE)


def test_stages_on_an_empty_table(spark, docs_of):
    import corpus_pipeline as cp

    docs = docs_of([], True)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert cp.STAGES[-1][1](spark, docs, SF).count() == 0
