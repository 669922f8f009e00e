"""Whitening against a dense eigensolver and exact integers."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from spokes.llm import registry, whitening

SF = "/root/testdata/sf0.001"


def brute(vectors, k=4, scale=256):
    """{id: (deviation, coordinates)}, eigenvalues, trace, n of [(id, vector)]."""
    rows = [(i, [math.floor(scale * float(c)) for c in v]) for i, v in vectors]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for x in fit])
    cov = c.T @ c / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    out = []
    for i, x in rows:
        gap = [n * v - s for v, s in zip(x, sums)]
        out.append((i, sum(g * g for g in gap), np.array(gap) / n @ vecs / np.sqrt(values)))
    return out, values, np.trace(cov), n


@pytest.mark.parametrize("d, kind", [(1, "flat"), (3, "flat"), (12, "flat"), (64, "flat"), (150, "flat"), (64, "ties"), (64, "rank"), (200, "decay")])
def test_jacobi_davidson(d, kind):
    rng = np.random.default_rng(d)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = {"flat": rng.uniform(1, 2, d), "ties": np.r_[5, 5, 5, 3, 3, np.ones(max(0, d - 5))][:d], "rank": np.r_[4, 2, np.zeros(max(0, d - 2))][:d],
         "decay": 1 / np.arange(1, d + 1)}[kind]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    passes = []
    values, vectors = whitening.jacobi_davidson(lambda u: passes.append(0) or v @ u, d, 4)
    assert np.allclose(values, np.sort(e)[::-1][:4], rtol=0, atol=1e-13 * max(e))
    assert np.abs(v @ vectors - vectors * values).max() < 3e-14 * max(e)  # residuals at double precision
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert len(passes) < 150


def test_minres():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((20, 20))
    a = a + a.T  # indefinite
    b = rng.standard_normal((20, 3))
    b[:, 1] = 0
    x = whitening.minres(lambda u: a @ u, b, 1e-12, 60)
    assert np.abs(a @ x - b).max() < 1e-8 and not x[:, 1].any()


def same(rows, vectors, components=4):
    want, values, trace, n = brute(vectors, components)
    got = {}
    for r in rows:
        got.setdefault(r.component, []).append(r)
    assert set(got) == set(range(1, len(values) + 1))
    for comp, mine in got.items():
        key = lambda t: (t[0] is not None, t[0] or 0, t[1])
        mine = sorted(((r.vec_id, r.deviation, r.whitened) for r in mine), key=lambda t: (*key(t), abs(t[2])))
        theirs = sorted(((i, dev, w[comp - 1]) for i, dev, w in want), key=lambda t: (*key(t), abs(t[2])))
        assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        a, b = np.array([m[2] for m in mine]), np.array([t[2] for t in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
    for r in rows:
        assert r.n == n and r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-10)
        assert 0 <= r.identity_error < 1e-9


def test_op11(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet", columns=["vec_id", "embedding"]).to_pydict()
    rows = registry.QUERIES["op11_whitening"](spark, SF).collect()
    assert len(rows) == 4 * len(t["vec_id"])
    same(rows, list(zip(t["vec_id"], t["embedding"])))


def test_partial_sums_of_many_tasks(spark, monkeypatch):
    """More tasks than are added at once: the sums go through a tree."""
    monkeypatch.setattr(whitening, "FAN", 3)
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(-50, 50, (500, 6)) * np.array([9, 7, 5, 3, 2, 1]), axis=0)
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<bigint>").repartition(11)
    fit = whitening.Centred(df, 6)
    c = x - x.mean(axis=0)
    u = rng.standard_normal((6, 2))
    assert fit.n == len(x) and fit.sums == x.sum(axis=0).tolist() and fit.parts == 11
    assert np.allclose(fit.times(u), c.T @ (c @ u) / len(x), rtol=1e-13)
    assert fit.trace() == pytest.approx((c * c).sum() / len(x), rel=1e-13)
    assert (fit.times(u) == fit.times(u)).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2, -0.0]), (1, [0.1, 0.2, -0.0]), (None, [1.0, -2.0, 0.5]), (3, [0.0, 0.0, 3.25]), (4, [-1.5, 0.25, 0.125])]
    good += [(9, [0.5, 0.5, 0.5])] * 20
    bad = [(5, None), (6, []), (7, [1.0, None, 0.0]), (8, [nan, 0.0, 0.0]), (8, [0.0, inf, 0.0]), (8, [0.0, -inf, 0.0]), (9, [1.0, 2.0])]
    clash = ("id", "x", "n", "component", "whitened", "part", "sum")
    df = spark.createDataFrame([(*r, *["clash"] * len(clash)) for r in good + bad],
                               "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` string" for c in clash))
    rows = whitening.whiten(df).collect()
    assert len(rows) == 3 * len(good)  # three dimensions, three components
    same(rows, good)
    for none in (df.limit(0), df.where("embedding is null"), df.where("vec_id = 9 and size(embedding) = 3")):
        out = whitening.whiten(none)
        assert out.count() == 0 and out.columns == whitening.whiten(df).columns
    flat = spark.createDataFrame([(i, [float(i % 5), 2.0 * (i % 5), 7.0]) for i in range(20)], "vec_id int, embedding array<float>")
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}  # the other two have no variance
    large = spark.createDataFrame([(i, [1e15 * i, 1.0 - i, 1.0 * i * i]) for i in range(1, 6)], "vec_id int, embedding array<double>")
    got = whitening.whiten(large).collect()
    assert got and all((r.deviation is None) == (r.vec_id != 3) for r in got)  # beyond long but for the middle one
