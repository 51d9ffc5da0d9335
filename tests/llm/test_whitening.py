"""Exact steps against plain versions, the whole operator against numpy, and edge rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from userlens.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int"


def leverrier(m):
    """Coefficients of det(x - m) by Faddeev and Le Verrier, in fractions."""
    d = len(m)
    out, b = [Fraction(1)], [[Fraction(int(i == j)) for j in range(d)] for i in range(d)]
    for k in range(1, d + 1):
        mb = [[sum(Fraction(m[i][t]) * b[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        out.append(-sum(mb[i][i] for i in range(d)) / k)
        b = [[mb[i][j] + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
    return [int(c) for c in out]


def gram(rows):
    a = np.array(rows, dtype=object)
    return (a.T.dot(a)).tolist()


@pytest.mark.parametrize("m", [
    gram(np.random.default_rng(3).integers(-10**6, 10**6, (9, 7))),
    gram(np.random.default_rng(4).integers(-5, 5, (3, 6))),           # of rank 3
    [[4, 0, 0], [0, 4, 0], [0, 0, 9]],
    [[7]],
    [[0, 0], [0, 0]],
])
def test_polynomial_is_exact(spark, m):
    assert wh.characteristic(spark, m) == leverrier(m)


def poly_of(roots):
    c = [1]
    for r in roots:
        c = [x - r * y for x, y in zip([*c, 0], [0, *c])]
    return c


def test_roots_are_counted_and_isolated_with_copies():
    poly = poly_of([0, 0, 3, 5, 5, 5, 10**12, 10**12 + 1])
    assert [wh.roots_beyond(poly, a) for a in (-1, 0, 3, 4, 5, 10**12, 10**12 + 1)] == [8, 6, 5, 5, 2, 1, 0]
    assert [(int(r), n) for r, n in wh.largest_roots(poly, 16)] == [(10**12 + 1, 1), (10**12, 1), (5, 3), (3, 1)]
    assert len(wh.largest_roots(poly, 1)) == 1
    root, n = wh.largest_roots([1, -4, 2], 1)[0]  # 2 + sqrt(2)
    assert n == 1 and abs(root - 2 - Fraction(math.isqrt(2 << 240), 1 << 120)) < Fraction(1, 1 << 110)


def test_components_of_close_and_equal_roots():
    m = [[2 * 10**9 + 1, 1, 0, 0], [1, 2 * 10**9 + 1, 0, 0], [0, 0, 5, 0], [0, 0, 0, 5]]
    roots = wh.largest_roots(leverrier(m), 4)
    assert [(int(r), n) for r, n in roots] == [(2 * 10**9 + 2, 1), (2 * 10**9, 1), (5, 2)]
    for r, n in roots:
        vs = [[float(x) for x in v] for v in wh.null_space(m, r, n)]
        for v in vs:
            assert np.allclose(np.array(m, float) @ v, float(r) * np.array(v), rtol=1e-15, atol=1e-6)
        assert np.allclose(np.array(vs) @ np.array(vs).T, np.eye(n), atol=1e-15)


@pytest.mark.parametrize("top", [100, 30_000, 10**7, 1 << 62])
def test_outer_sums_are_exact(top):
    rng = np.random.default_rng(top % 1000)
    x = np.concatenate([rng.integers(-top, top, (50, 3)), [[top, -top, 0], [-top, -1, 1]]])
    want = [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(3)] for i in range(3)]
    got = wh.outer_sums(x)
    assert got[:3, :3].tolist() == want and got[3, :3].tolist() == [sum(map(int, c)) for c in x.T] and got[3, 3] == len(x)
    import pyarrow as pa
    keys = pa.concat_arrays(list(wh.keys_of(x)))
    assert sorted(wh.vectors_of(keys, 3).tolist()) == sorted(x.tolist())


def brute(rows, most=16):
    """{row number: (n, deviation, |whitened|, explained)} of kept rows (vec_id, vector), by numpy's eigenvectors."""
    kept = [(k, i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for k, (i, v) in enumerate(rows)
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, _, x in kept}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(r, s)] for r in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    out = []
    for _, i, x in kept:
        z = [n * a - int(b) for a, b in zip(x, s)]
        out.append((i, n, sum(c * c for c in z), np.abs(np.array(z, float) / n @ v / np.sqrt(e)), e / np.trace(centred.T @ centred / n)))
    return out


def test_given_table_against_numpy(spark):
    import os

    from userlens.llm.shared import ship

    at = "/root/testdata/sf0.001/embeddings.parquet"
    if not os.path.isfile(at):
        pytest.skip("driver test data not present")
    ship(spark)
    df = spark.read.parquet(at)
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {}
    for r in wh.whiten(df).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    want = brute(rows)
    assert len(want) == len(got) == len(rows)
    values = []
    for i, n, deviation, whitened, explained in want:
        mine = [got[i][k] for k in range(1, 17)]
        assert {(r["n"], r["deviation"], r["deviation_text"]) for r in mine} == {(n, deviation, None)}
        assert np.allclose(np.abs([r["whitened"] for r in mine]), whitened, atol=1e-8)
        assert np.allclose([r["explained"] for r in mine], explained, rtol=1e-9)
        assert {r["identity_error"] for r in mine} == {mine[0]["identity_error"]} and mine[0]["identity_error"] < 1e-12
        values.append([r["whitened"] for r in mine])
    if len({tuple(v) for _, v in rows}) == len(rows):
        w = np.array(values)
        assert np.abs(w.T @ w / len(w) - np.eye(16)).max() < 1e-9


def test_edge_rows(spark):
    from pyspark.sql import functions as F

    from userlens.llm.shared import ship

    ship(spark)
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 1.0, 2.0]), (2, [1.0, 0.5, 0.0]), (2, [1.0, 0.5, 0.0]), (None, [-3.0, 0.25, 7.0]), (4, [0.001, 1.0, 2.0]), (5, [2.0, 2.0, 2.0])]
    bad = [(10, None), (11, [None, 1.0, 1.0]), (12, [nan, 0.0, 0.0]), (13, [inf, 0.0, 0.0]), (14, []), (15, [1.0]), (16, [1.0, 2.0, 3.0, 4.0])]
    rows = [(i, v, 0) for i, v in good + bad]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(good)
    for frame in (df, df.select("*", *[F.lit("clash").alias(c) for c in ("component", "n", "key", "dim", "__v", "whitened")])):
        got = wh.whiten(frame).collect()
        assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"], r["n"], r["deviation"]) for r in got) == sorted(
            (i is None, i or 0, k, n, s) for i, n, s, _, _ in want for k in (1, 2, 3))
        whitened = {}
        for r in got:
            whitened.setdefault(r["vec_id"], []).append((r["component"], abs(r["whitened"])))
        for i, _, _, w, _ in want:
            assert np.allclose([x for _, x in sorted(set(whitened[i]))], w, atol=1e-9)
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert wh.whiten(df.filter("vec_id = 5")).count() == 0  # no variance
    assert wh.whiten(df.filter("vec_id >= 10 and vec_id < 15")).count() == 0
    flat = wh.whiten(spark.createDataFrame([(1, [1.0, 5.0], 0), (2, [2.0, 5.0], 0)], SCHEMA)).collect()
    assert sorted(r["component"] for r in flat) == [1, 1] and np.allclose(sorted(r["whitened"] for r in flat), [-1, 1])


def test_deviation_beyond_a_long_is_text(spark):
    rows = [(1, [3e15, 0.0], 0), (2, [-3e15, 1.0], 0), (3, [1e300, -1e300], 0)]
    got = {r["vec_id"]: r for r in wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).filter("component = 1").collect()}
    x = {i: [max(-2**62, min(2**62, math.floor(Fraction(c) * 64))) for c in v] for i, v, _ in rows}
    for i, r in got.items():
        z = [3 * x[i][k] - sum(v[k] for v in x.values()) for k in (0, 1)]
        assert r["deviation"] is None and int(r["deviation_text"]) == z[0] ** 2 + z[1] ** 2
