"""Whitening against exact covariance and a dense solver (operator 12)."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from llm_fixtures import docs, nothing  # noqa: F401
from roomrate.llm import whitening
from roomrate.llm.queries import QUERIES


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def integers(vectors):
    return [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]


def brute(vectors):
    """n, sums, deviations, covariance (exact, then double) of plain lists."""
    x = integers(vectors)
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    dev = [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]
    cov = np.array([[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3))
                     for j in range(d)] for i in range(d)])
    return n, s, dev, cov, np.array([[n * r[i] - s[i] for i in range(d)] for r in x], dtype=object)


def check(got, ids, vectors, tolerance=1e-9):
    n, _, dev, cov, centred = brute(vectors)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    y = {}
    for r in got:
        assert r.n == n
        y.setdefault(r.vec_id, {})[r.component] = r
    k = min(8, cov.shape[0])
    want = (centred.astype(np.float64) / n) @ v[:, :k] / np.sqrt(e[:k])
    have = np.array([[y[i][c + 1].whitened for c in range(k)] for i in ids])
    sign = np.sign((have * want).sum(axis=0))
    assert np.abs(have * sign - want).max() < tolerance
    for i, d in zip(ids, dev):
        assert {r.deviation for r in y[i].values()} == {d}
    for c in range(k):
        assert abs(y[ids[0]][c + 1].explained / (e[c] / np.trace(cov)) - 1) < 1e-10
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_query(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    got = QUERIES["op12_whitening"](spark, SF001).collect()
    assert len(got) == 8 * len(rows)
    check(got, [r.vec_id for r in rows], [r.embedding for r in rows], 1e-8)


def test_few_dimensions_and_large_entries(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) * [1.0, 30.0, 400.0] + [0, 5, 1e7]
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(x)]).repartition(7)
    check(whitening.whiten(df).collect(), list(range(300)), x.tolist())


def test_any_partitioning_gives_the_same_bits(spark):
    rng = np.random.default_rng(4)
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 12)))])
    runs = [{(r.vec_id, r.component): (r.whitened, r.explained, r.deviation)
             for r in whitening.whiten(df.repartition(n)).collect()} for n in (1, 9)]
    assert runs[0].keys() == runs[1].keys()
    assert all(abs(runs[0][k][0] - runs[1][k][0]) < 1e-13 and runs[0][k][1:] == runs[1][k][1:] for k in runs[0])
    fits = [whitening.fit(df.repartition(n)) for n in (1, 9)]
    assert (fits[0].vectors == fits[1].vectors).all() and (fits[0].eigenvalues == fits[1].eigenvalues).all()


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), float(i % 3), 0.25]) for i in range(20)]
    bad = [(30, None), (31, [nan, 1.0, 1.0]), (32, [1.0, None, 2.0]), (33, [inf, 0.0, 0.0]), (34, []),
           (35, [1.0, 2.0]), (36, [1e300, 0.0, 0.0])]
    df = table(spark, good + bad + [(7, [9.0, 9.0, 0.25]), (None, [3.0, 1.0, 0.25])])
    for c in ("n", "component", "_vector", "dim", "i", "v", "whitened"):
        df = df.withColumn(c, F.lit("clash"))
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got if r.component == 1) == sorted(
        (i is None, i or 0) for i in [*range(20), 7, None])
    assert {r.n for r in got} == {22} and {r.component for r in got} == {1, 2, 3}
    # the third dimension is constant: no direction to scale
    assert all((r.whitened is None) == (r.component == 3) for r in got)
    assert {r.explained for r in got if r.component == 3} == {0.0}
    assert max(r.identity_error for r in got) < 1e-12
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.filter("vec_id = 30")).count() == 0
    one = whitening.whiten(df.filter("vec_id = 3")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, None)] * 3


def test_deviation_beyond_a_long_is_null(spark):
    df = table(spark, [(i, [1e9 * (i % 2), 0.0]) for i in range(4000)])
    assert {r.deviation for r in whitening.whiten(df).collect()} == {None}


def residual(v, e, x):
    return float(np.abs(v @ x - x * e).max()), float(np.abs(x.T @ x - np.eye(len(v))).max())


@pytest.mark.parametrize("eigenvalues", [
    [9, 4, 1, 0.5, 0.25], [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.2], [1 + 1e-13, 1, 0.3, 0.3 - 1e-12, 0.3 - 2e-12],
    [1, 1, 1, 0.5, 0.5], [1, 1e-6, 1e-9, 1e-9 - 1e-14, 0], [2, 2, 2, 2, 2]])
def test_clustered_eigenvalues(eigenvalues):
    """Vectors far more exact than float32, whatever the gaps."""
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.normal(size=(5, 5)))[0].astype(np.longdouble)
    for _ in range(4):  # orthogonal to extended precision
        q = q @ (1.5 * np.eye(5) - 0.5 * q.T @ q)
    want = np.array(eigenvalues, np.longdouble)
    v = (q * want) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.refined_eigen(v)
    assert np.abs(e - np.sort(want)[::-1]).max() < 1e-16
    assert max(residual(v, e, x)) < 1e-16
    for i in range(5):  # a single eigenvalue's vector is the planted one
        if np.abs(np.delete(want, i) - want[i]).min() > 1e-10:
            j = np.abs(e - want[i]).argmin()
            assert 1 - abs(float(x[:, j] @ q[:, i])) < 1e-12


def test_exact_products():
    rng = np.random.default_rng(7)
    for top in (10, 1 << 20, 1 << 44):
        z = rng.integers(-top, top, (100, 3))
        o = z.astype(object)
        assert (whitening.exact_products(z) == o.T @ o).all()
