"""Embedding whitening by the exact characteristic polynomial of the scatter matrix.

1. Entries become integers (``floor(SCALE * c)``), so everything up to the polynomial is exact. One narrow
   pass packs each kept vector into a short key, equal keys are made one by a distinct (partial before its
   shuffle, so a group of copies is one row a task), and each task adds up the outer products of its
   distinct vectors, in blocks whose sums fit a double's 53 bits. What the tasks add up meets in a
   grouped sum of d * (d + 3) / 2 + 1 rows, d being the dimension.
2. ``M = n * sum(x x') - S S'`` is an integer matrix, n^2 times the covariance. Its characteristic polynomial
   is found modulo primes below 2^31, one Spark row a prime: reduction to Hessenberg form, then the
   recurrence over its leading blocks. As many primes as the coefficients' bound needs are put
   together by Chinese remaindering. Their number grows with d and the logarithm of the rows alone.
3. All roots are real, so the sign changes of the polynomial shifted by a count the roots beyond a exactly,
   copies included (Descartes' rule). Bisection by that count isolates the largest roots, and signs of
   exact values narrow each to 2^-BITS.
4. A component is the null space of ``M - root``: inverse iteration with 60-digit decimals; a root of
   several copies gives that many orthogonal vectors.

A shift of all entries by one number changes neither n * x - S nor M, so the keys hold no shift.

Defined results: a row whose vector is null or has a null or non-finite entry is dropped; the dimension is the
length that most distinct vectors have (the smaller of equals, empty vectors apart), and rows of another
length are dropped, too; integers beyond 2^62 count as 2^62; a null id stays; repeated rows are returned each
and are in the fit once; components of no variance aren't returned, so equal vectors alone, like an empty
table, give an empty table; ``deviation`` is null where it doesn't fit a long, and ``deviation_text`` has it
then; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written

SCALE = 64
MOST = 16
#: Binary places of a root of M, and digits of the decimals of inverse iteration.
BITS, DIGITS = 128, 60
#: Integers are added up as digits of 2^LIMB, at most BLOCK products at once: 2 * LIMB + 13 <= 53 bits.
LIMB, BLOCK = 20, 1 << 13
_MOST_INT = 1 << 62
#: Sums go to Spark as four longs, digits of 2^WORD; a sum over 2^20 tasks still fits a long.
WORD = 40


# ---- vectors ---------------------------------------------------------------------------------------

def integers(column: pa.Array, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their integers) of the kept vectors, the vectors of each length together."""
    size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(size)), size)
    bad = np.bincount(row[~np.isfinite(values)], minlength=len(size)) > 0
    at = np.concatenate([[0], np.cumsum(size)])
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero((size == d) & ~bad)
        if len(rows):
            with np.errstate(over="ignore"):
                x = np.floor(values[at[rows][:, None] + np.arange(d)] * scale)
            yield rows, np.clip(x, -float(_MOST_INT), float(_MOST_INT)).astype(np.int64)


def keys_of(x: np.ndarray) -> Iterator[pa.Array]:
    """Each vector's key: the bytes of an entry, then the entries in as few bytes as they all fit."""
    least = np.max(np.maximum(x, -1 - x), axis=1)
    done = np.zeros(len(x), bool)
    for width in (1, 2, 4, 8):
        mine = ~done & (least < 1 << (8 * width - 1)) if width < 8 else ~done
        done |= mine
        if mine.any():
            body = np.ascontiguousarray(x[mine].astype(f"<i{width}")).view(np.uint8)
            data = np.concatenate([np.full((len(body), 1), width, np.uint8), body], axis=1)
            yield pa.FixedSizeBinaryArray.from_buffers(pa.binary(data.shape[1]), len(data), [None, pa.py_buffer(data.tobytes())]).cast(pa.binary())


def vectors_of(keys: pa.Array, dim: int) -> np.ndarray:
    out = np.empty((len(keys), dim), np.int64)
    lengths = pc.binary_length(keys).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        data = np.frombuffer(b"".join(keys.take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), n)
        out[rows] = np.ascontiguousarray(data[:, 1:]).view(f"<i{(n - 1) // dim}")
    return out


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Digits of 2^LIMB as doubles, the last one with the sign."""
    out = []
    while True:
        low = x & ((1 << LIMB) - 1)
        if ((x >= -(1 << LIMB)) & (x < 1 << LIMB)).all():
            return [*out, x.astype(np.float64)]
        out.append(low.astype(np.float64))
        x = x >> LIMB


def outer_sums(x: np.ndarray) -> np.ndarray:
    """sum(x x') of the rows of ``x``, with a last row and column for sum(x) and the count: Python integers."""
    d = x.shape[1]
    total = np.zeros((d + 1, d + 1), dtype=object)
    for a in range(0, len(x), BLOCK):
        parts = [np.concatenate([p, np.full((len(p), 1), 1.0 if k == 0 else 0.0)], axis=1) for k, p in enumerate(_limbs(x[a:a + BLOCK]))]
        for k, p in enumerate(parts):
            for m, q in enumerate(parts):
                total += (p.T @ q).astype(np.int64).astype(object) << (LIMB * (k + m))
    return total


def scatter(spark: SparkSession, keys: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, sum(x x')) of the distinct vectors ``keys`` of one dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                now = outer_sums(vectors_of(batch.column(0), dim))
                total = now if total is None else total + now
        if total is None:
            return
        rows = [(i, j, int(total[i, j])) for i in range(dim + 1) for j in range(i, dim + 1)]
        mask = (1 << WORD) - 1
        words = [[v >> (WORD * k) & mask if k < 3 else v >> (WORD * 3) for _, _, v in rows] for k in range(4)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), *(pa.array(w, pa.int64()) for w in words)], names=["i", "j", "w0", "w1", "w2", "w3"])

    sums = keys.mapInArrow(run, "i int, j int, w0 long, w1 long, w2 long, w3 long").groupBy("i", "j").agg(*[F.sum(f"w{k}").alias(f"w{k}") for k in range(4)])
    m = [[0] * (dim + 1) for _ in range(dim + 1)]
    for r in sums.collect():  # d * (d + 3) / 2 + 1 rows
        m[r["i"]][r["j"]] = m[r["j"]][r["i"]] = sum(r[f"w{k}"] << (WORD * k) for k in range(4))
    return m[dim][dim], m[dim][:dim], [row[:dim] for row in m[:dim]]


# ---- the polynomial --------------------------------------------------------------------------------

def primes(bits: int) -> list[int]:
    """Primes below 2^31, the largest first, whose product has more than ``bits`` bits."""
    out, have, p = [], 1, (1 << 31) - 1
    small = [q for q in range(2, 46_341) if all(q % r for r in range(2, int(q ** 0.5) + 1))] if bits else []
    while have.bit_length() <= bits:
        if all(p % q for q in small):
            out.append(p)
            have *= p
        p -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - m) modulo ``p``, the highest first, by Hessenberg reduction. ``m`` in [0, p)."""
    a, d = m.copy(), len(m)
    for k in range(d - 2):
        some = np.flatnonzero(a[k + 1:, k])
        if not len(some):
            continue
        i = k + 1 + int(some[0])
        a[[i, k + 1]] = a[[k + 1, i]]
        a[:, [i, k + 1]] = a[:, [k + 1, i]]
        f = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - f[:, None] * a[k + 1]) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * f % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)  # of the leading blocks, the lowest coefficient first
    polys[0, 0] = 1
    for k in range(1, d + 1):
        now = np.zeros(d + 1, np.int64)
        now[1:] = polys[k - 1, :-1]
        now = (now - int(a[k - 1, k - 1]) * polys[k - 1]) % p
        down = 1
        for i in range(k - 1, 0, -1):
            down = down * int(a[i, i - 1]) % p
            if not down:
                break
            now = (now - int(a[i - 1, k - 1]) * down % p * polys[i - 1]) % p
        polys[k] = now
    return polys[d][::-1].tolist()


def characteristic(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """The exact coefficients of det(x - m), the highest first, of a positive semidefinite integer matrix."""
    d = len(m)
    mean = sum(m[i][i] for i in range(d)) // d + 1  # coefficient k is at most comb(d, k) * mean^k (Maclaurin)
    bits = max((comb(d, k) * mean ** k).bit_length() for k in range(d + 1)) + 2
    moduli = primes(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            images = [polynomial_mod(np.array([[v % p for v in row] for row in m], np.int64), p) for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(images, pa.list_(pa.int64()))], names=["p", "image"])

    rows = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(min(len(moduli), 16)).mapInArrow(run, "p long, image array<long>").collect()
    whole = 1
    for p in moduli:
        whole *= p
    weight = {p: whole // p * pow(whole // p, -1, p) for p in moduli}
    out = []
    for k in range(d + 1):
        c = sum(r["image"][k] * weight[r["p"]] for r in rows) % whole
        out.append(c - whole if 2 * c > whole else c)
    return out


# ---- roots -----------------------------------------------------------------------------------------

def roots_beyond(poly: list[int], a: int) -> int:
    """How many roots of a polynomial with real roots alone are beyond ``a``, copies counted: the sign changes of
    the coefficients of poly(x + a)."""
    c = list(poly)
    for n in range(len(c), 1, -1):
        for k in range(1, n):
            c[k] += a * c[k - 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value(poly: list[int], a: int) -> int:
    v = 0
    for c in poly:
        v = v * a + c
    return v


def largest_roots(poly: list[int], most: int, bits: int = BITS) -> list[tuple[Fraction, int]]:
    """(root to 2^-bits, copies) of the ``most`` largest positive roots, copies counted, falling. All roots of
    ``poly`` are real and at least 0."""
    scaled = [c << (bits * k) for k, c in enumerate(poly)]  # its roots are 2^bits times as large
    top = (-poly[1] << bits) + 1 if len(poly) > 1 else 1  # beyond the sum of the roots
    want = min(most, roots_beyond(scaled, 0))
    out: list[tuple[Fraction, int]] = []

    def narrow(lo: int, hi: int, beyond: int) -> int:
        """The single root in (lo, hi], with ``beyond`` roots after hi."""
        while hi - lo > 1:
            mid = (lo + hi) // 2
            v = _value(scaled, mid)
            if not v:
                return mid
            if (v > 0) == (beyond % 2 == 0):  # as many roots beyond mid as beyond hi
                hi = mid
            else:
                lo = mid
        return hi

    stack = [(0, top, roots_beyond(scaled, 0), 0)]
    while stack and sum(n for _, n in out) < want:
        lo, hi, at_lo, at_hi = stack.pop()
        n = at_lo - at_hi
        if not n:
            continue
        if n == 1 or hi - lo == 1:
            out.append((Fraction(narrow(lo, hi, at_hi) if n == 1 else hi, 1 << bits), n))
            continue
        mid = (lo + hi) // 2
        at_mid = roots_beyond(scaled, mid)
        stack += [(lo, mid, at_lo, at_mid), (mid, hi, at_mid, at_hi)]
    return out


# ---- components ------------------------------------------------------------------------------------

def null_space(m: list[list[int]], root: Fraction, copies: int, digits: int = DIGITS) -> list[list[Decimal]]:
    """Orthonormal vectors v with m v = root v, by inverse iteration with the triangular factors of m - root."""
    d = len(m)
    with localcontext() as c:
        c.prec = digits
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(v) for v in row] for row in m], dtype=object)
        for i in range(d):
            a[i, i] -= shift
        tiny = (abs(shift) + 1) * Decimal(10) ** (10 - digits)
        order = list(range(d))
        for k in range(d):
            i = max(range(k, d), key=lambda r: abs(a[r, k]))
            if i != k:
                a[[i, k]] = a[[k, i]]
                order[i], order[k] = order[k], order[i]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] = a[k + 1:, k] / a[k, k]
                a[k + 1:, k + 1:] -= a[k + 1:, k:k + 1] * a[k:k + 1, k + 1:]

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(d):
                x[k + 1:] -= a[k + 1:, k] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] = x[k] / a[k, k]
                x[:k] -= a[:k, k] * x[k]
            return x

        found: list[np.ndarray] = []
        for t in range(copies):
            v = np.array([Decimal((i + 1) * (2 * t + 1) * 2654435761 % 1000003) / 1000003 - Decimal("0.4") for i in range(d)], dtype=object)
            for _ in range(3):
                v = solve(v)
                for _ in range(2):
                    for u in found:
                        v = v - u * (u * v).sum()
                    v = v / (v * v).sum().sqrt()
            found.append(v)
        return [f.tolist() for f in found]


class Whitening(NamedTuple):
    """``eigenvalues`` are those of n^2 times the covariance, falling; ``components`` their unit vectors."""

    dim: int
    n: int
    sums: list[int]
    trace: int
    eigenvalues: list[Fraction]
    components: list[list[float]]
    identity_error: float


def _identity_error(m: list[list[int]], values: list[Fraction], components: list[list[float]]) -> float:
    """The largest entry of |C - 1|, C being the covariance of the fit list projected on ``components`` as they are
    returned and divided by the roots' square roots."""
    with localcontext() as c:
        c.prec = DIGITS
        w = np.array([[Decimal(x) for x in row] for row in components], dtype=object)
        sigma = [(Decimal(v.numerator) / Decimal(v.denominator)).sqrt() for v in values]
        cov = w.dot(np.array([[Decimal(v) for v in row] for row in m], dtype=object)).dot(w.T)
        return float(max(abs(cov[i, j] / (sigma[i] * sigma[j]) - (i == j)) for i in range(len(w)) for j in range(len(w))))


def components_of(spark: SparkSession, n: int, sums: list[int], outer: list[list[int]], most: int = MOST) -> Whitening:
    dim = len(sums)
    m = [[n * outer[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    trace = sum(m[i][i] for i in range(dim))
    values, vectors = [], []
    if trace:
        for root, copies in largest_roots(characteristic(spark, m), most):
            values += [root] * copies
            vectors += null_space(m, root, copies)
    values, vectors = values[:most], [[float(x) for x in v] for v in vectors[:most]]
    return Whitening(dim, n, sums, trace, values, vectors, _identity_error(m, values, vectors) if values else 0.0)


# ---- Spark -----------------------------------------------------------------------------------------

def fit(embeddings: DataFrame, vector: str = "embedding", most: int = MOST, scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct vectors of ``embeddings``; None where there are none."""
    spark = embeddings.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in integers(batch.column(0), scale):
                for keys in keys_of(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), x.shape[1]), pa.int32()), keys], names=["dim", "key"])

    keys = written(embeddings.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, "dim int, key binary").distinct(), "vectors")
    most_common = keys.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if most_common is None:
        return None
    dim = most_common["dim"]
    return components_of(spark, *scatter(spark, keys.filter(F.col("dim") == dim).select("key"), dim), most)


def transform(embeddings: DataFrame, model: Whitening | None, vector: str = "embedding", vec_id: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error, deviation_text: one row for
    each kept row and component."""
    names = [vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"]
    kinds = [embeddings.schema[vec_id].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType(), T.StringType()]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(names, kinds, strict=True)])
    if model is None or not model.eigenvalues:
        return embeddings.sparkSession.createDataFrame([], schema)
    k = len(model.eigenvalues)
    with localcontext() as c:
        c.prec = DIGITS
        root = [float((Decimal(v.numerator) / Decimal(v.denominator)).sqrt()) for v in model.eigenvalues]
    project = np.array(model.components).T / np.array(root)
    explained = np.array([float(v / model.trace) for v in model.eigenvalues])
    dim, n, sums, error = model.dim, model.n, model.sums, model.identity_error

    def centred(x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        fits = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 1 << 62
        return (x * n - np.array(sums, np.int64)) if fits else x.astype(object) * n - np.array(sums, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch.column(1), scale):
                if x.shape[1] != dim:
                    continue
                z = centred(x)
                far = max(int(z.max()), -int(z.min()))
                square = (z * z).sum(axis=1).tolist() if dim * far * far < 1 << 63 else [sum(v * v for v in r) for r in z.tolist()]
                small = [s if s < 1 << 63 else None for s in square]
                text = [None if s < 1 << 63 else str(s) for s in square]
                out = z.astype(np.float64) @ project
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                columns = [batch.column(0).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(rows) * k, n)),
                           pa.array(small, pa.int64()).take(each), pa.array(out.ravel()), pa.array(np.tile(explained, len(rows))),
                           pa.array(np.full(len(rows) * k, error)), pa.array(text, pa.string()).take(each)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return embeddings.select(vec_id, F.col(vector).cast("array<double>").alias("__v")).mapInArrow(run, schema)


def whiten(embeddings: DataFrame, **options) -> DataFrame:
    """``transform`` of the rows of ``embeddings`` by their own ``fit``."""
    return transform(embeddings, fit(embeddings, **options))
