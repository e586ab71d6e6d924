"""Operator 11 against plain numpy on small tables, and its eigen solver alone."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x long, n string, deviation string"


def brute(rows, components=32):
    """{vec_id: (deviation, whitened)} and explained, by exact sums and float64."""
    d = len(rows[0][1])
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    n = len(x)
    s = [sum(v[k] for _, v in x) for k in range(d)]
    dev = [sum((n * v[k] - s[k]) ** 2 for k in range(d)) for _, v in x]
    y = np.array([[v[k] - s[k] / n for k in range(d)] for _, v in x])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return {i: (dv, w) for (i, _), dv, w in zip(x, dev, y @ u / np.sqrt(e))}, e / np.trace(cov), n


def awkward(seed=1, count=300, d=40):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0.3, 1 + k / 10) for k in range(d)]) for i in range(count)]
    rows += [(7, list(rows[7][1])), (None, list(rows[9][1])), (900, None), (901, [float("nan")] * d), (902, [None] + [0.5] * (d - 1)),
             (903, [float("inf")] + [0.5] * (d - 1)), (904, []), (905, [1e4] * d)]
    return rows


def result(spark, rows, parts=4):
    df = spark.createDataFrame([(i, v, 1, 5, "x", "y") for i, v in rows], SCHEMA).repartition(parts)
    m = W.fit(df)
    return df, m, W.whiten(df, m)


def test_against_numpy(spark):
    rows = awkward()
    df, m, out = result(spark, rows)
    want, explained, n = brute(rows)
    assert m.n == n == 303
    assert np.allclose(m.explained, explained, rtol=1e-9)
    got = out.collect()
    assert len(got) == n
    for r in got:
        dev, w = want[r.vec_id]
        assert r.deviation == dev
        assert np.allclose(np.abs(r.whitened), np.abs(w), atol=1e-7)
    assert W.identity_error(df, m) < 1e-9


def test_any_dealing_gives_the_same(spark):
    rows = awkward(2)
    a, b = (result(spark, rows, p)[1] for p in (1, 7))
    assert (a.vectors == b.vectors).all() and (a.values == b.values).all()


def test_clustered_eigenvalues(spark):
    """Dimensions of equal variance and none in common: every eigenvalue alike."""
    d = 6
    rows = [(2 * k + s, [(1.0 if k == j else 0.0) * (1 if s else -1) for j in range(d)]) for k in range(d) for s in (0, 1)]
    df, m, out = result(spark, rows)
    assert len(m.values) == d and np.ptp(m.values) < 1e-9 * m.values[0]
    assert W.identity_error(df, m) < 1e-9


@pytest.mark.parametrize("values", [np.linspace(1, 100, 48), [5.0] * 10 + [1.0] * 5 + [1 + 1e-9, 1 + 2e-9], [3, 3 + 1e-6, 3 + 2e-6, 7, 0, 0, 0], [1e-8, 1, 1e8], 1 + 1e-7 * np.arange(30), [2.0] * 4, [0.0] * 3])
def test_refined_eigh(values):
    r = np.random.default_rng(3)
    d = len(values)
    q = W.orthogonal(np.linalg.qr(r.normal(size=(d, d)))[0].astype(np.longdouble), 3)
    a = (q * np.array(values, np.longdouble)) @ q.T
    w, x = W.refined_eigh(a)
    x = x.astype(np.longdouble)
    assert np.allclose(w, np.sort(values)[::-1], rtol=0, atol=4e-16 * max(1e-300, np.max(values)))
    assert np.abs(x.T @ x - np.eye(d)).max() < 4e-16
    assert np.abs(a @ x - x * w).max() <= 1e-15 * np.max(values)


def test_far_entries_and_exact_deviation(spark):
    rows = [(1, [1e30, 2.0]), (2, [-1e30, 1.0]), (3, [3.0, 4.0])]
    _, m, out = result(spark, rows)
    assert {r.vec_id: r.deviation for r in out.collect()} == {1: None, 2: None, 3: 384**2 + 320**2}
    rows = [(i, [float(i % 5), float(i * i % 7), 0.0]) for i in range(50)]
    want, _, _ = brute([(i, v[:2]) for i, v in rows])
    _, m, out = result(spark, rows)
    assert len(m.values) == 2  # the third has no variance
    assert {r.vec_id: r.deviation for r in out.collect()} == {i: v[0] for i, v in want.items()}


def test_large_integers_stay_exact():
    y = np.array([[2**40 + 1, 3], [5, -(2**41)]], np.int64)
    assert W.gram(y).tolist() == [[(2**40 + 1) ** 2 + 25, 3 * (2**40 + 1) - 5 * 2**41], [3 * (2**40 + 1) - 5 * 2**41, 9 + 2**82]]


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, [])]):
        df, m, out = result(spark, rows)
        assert out.select(F.posexplode("whitened")).count() == 0
        assert W.identity_error(df, m) == 0.0


def test_other_lengths_are_left_out(spark):
    rows = [(i, [float(i), float(i % 3)]) for i in range(9)] + [(50, [1.0]), (51, [1.0, 2.0, 3.0])]
    _, m, out = result(spark, rows)
    assert m.n == 9 and {r.vec_id for r in out.collect()} == set(range(9))


def test_query(spark, sf_small):
    import __spark_entry__ as E
    rows = E.queries()["op11_whitened_embeddings"](spark, sf_small).collect()
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    want, explained, n = brute([(r.vec_id, r.embedding) for r in table])
    assert len(rows) == 32 * n
    for r in rows:
        assert r.n == n and r.deviation == want[r.vec_id][0] and r.identity_error < 1e-9
        assert abs(abs(r.whitened) - abs(want[r.vec_id][1][r.component - 1])) < 1e-6
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
