"""Whitening against numpy on whole vectors, eigenvectors against exact ones, odd rows."""

import math

import numpy as np
import pytest

from basketry.llm import whitening as wh
from basketry.sources.tables import table


def brute(rows):
    """n, sums, eigenvalues and eigenvectors, and the clean rows' integer vectors, by numpy over everything."""
    clean = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in clean])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    return clean, x, n, s, values[::-1], vectors[:, ::-1]


def checked(found, rows, k, tolerance=1e-9):
    clean, x, n, s, values, vectors = brute(rows)
    want = ((n * x - s) / n) @ vectors[:, :k] / np.sqrt(values[:k])
    got = sorted(found, key=lambda r: (r.vec_id, r.component))
    assert len(got) == len(clean) * k
    w = np.array([r.whitened for r in got]).reshape(-1, k)
    order = np.argsort([i for i, _ in clean], kind="stable")
    signs = np.sign((w * want[order]).sum(0))
    assert np.abs(w * signs - want[order]).max() < tolerance
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x[order]]
    assert [r.deviation for r in got[::k]] == exact
    assert {r.n for r in got} == {n} and all(r.identity_error < 1e-9 for r in got)
    assert np.allclose([r.explained for r in got[:k]], values[:k] / values.sum(), rtol=1e-9)


def whitened(spark, rows, k=16, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    model = wh.fit(df, components=k)
    out = wh.whiten(df, model).selectExpr("row.vec_id", "deviation", "posexplode(whitened) as (at, whitened)").collect()
    return model, [wh_row(r, model) for r in out]


class wh_row:
    def __init__(self, r, model):
        self.vec_id, self.component, self.whitened, self.deviation = r.vec_id, r.at + 1, r.whitened, r.deviation
        self.n, self.explained, self.identity_error = model.n, float(model.explained[r.at]), model.identity_error


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    checked(wh.op13_whitening(spark, sf).collect(), rows, 16)


def test_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = [[float(c) for c in v] for v in rng.normal(size=(40, 5)) * [3, 2, 1, 0.5, 4]]
    rows = [(i, base[i % 40 if i % 3 else 0]) for i in range(300)]
    rows += [(1000, None), (1001, [None, 1.0, 1.0, 1.0, 1.0]), (1002, [math.nan] * 5), (1003, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    _, got = whitened(spark, rows, 3, "double")
    checked(got, rows, 3)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=3) * [1e5, 3e4, 10.0]]) for i in range(50)]
    model, got = whitened(spark, rows, 3, "double")
    exact = {}
    ints = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    for i, v in ints.items():
        exact[i] = sum((50 * a - s) ** 2 for a, s in zip(v, [sum(x[j] for x in ints.values()) for j in range(3)]))
    assert all(r.deviation == exact[r.vec_id] for r in got) and model.identity_error < 1e-9
    with pytest.raises(Exception, match="beyond 2\\^33"):
        whitened(spark, [(1, [1e12]), (2, [0.0])], 1, "double")


def test_no_variance_no_rows(spark):
    for rows in ([], [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)], [(1, None)], [(1, []), (2, [])]):
        model, got = whitened(spark, rows)
        assert got == [] and len(model.values) == 0
    # one of two dimensions varies
    model, got = whitened(spark, [(1, [0.5, 0.25]), (2, [1.5, 0.25])])
    assert [r.component for r in got] == [1, 1] and sorted(abs(r.whitened) for r in got) == pytest.approx([1, 1])


def test_other_lengths_go(spark):
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(20)] + [(50, [1.0]), (51, [1.0, 2.0, 3.0]), (52, [])]
    _, got = whitened(spark, rows)
    assert {r.vec_id for r in got} == set(range(20))


def test_names_are_kept_apart(spark):
    df = spark.createDataFrame([(1, [0.0], "a", 3), (2, [1.0], None, None), (2, [1.0], "b", 4)], "vec_id long, embedding array<float>, whitened string, `de viation.x` int")
    out = wh.whiten(df, wh.fit(df)).collect()
    assert sorted(str(r.row.whitened) for r in out) == ["None", "a", "b"] and {len(r.whitened) for r in out} == {1}


def test_packing():
    x = np.array([[0, 1], [-128, 127], [128, 0], [-2**31, 5], [2**40, -1]]) + wh.OFFSET
    rows = wh.packed(x)
    assert [len(r) for r in rows] == [2, 2, 4, 8, 16] and (wh.unpacked(rows, 2) == x).all()


def orthogonal(rng, d):
    return np.linalg.qr(rng.normal(size=(d, d)))[0]


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40), np.r_[np.ones(10), np.linspace(2, 3, 30)], 1 + np.arange(40) * 1e-9, np.r_[1e-14, 1e-7, 1, 1 + 1e-12, 1 + 3e-12, 1e6],
])
def test_eigenvectors(values):
    """Every eigenvalue to 1e-14 of the largest one, orthogonal vectors, small residuals; clusters of near and equal values too."""
    rng = np.random.default_rng(1)
    u = orthogonal(rng, len(values)).astype(np.longdouble)
    v = (u * values) @ u.T
    got, x = wh.eigen((v + v.T) / 2)
    assert np.abs(got - np.sort(values)[::-1]).max() < 4e-14 * values.max()
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 4e-15 * len(values)
    assert np.abs(v @ x - x * got).max() < 4e-15 * len(values) * values.max()


def test_clustered_eigenvectors_are_found():
    """Values 1e-9 apart: float32 mixes their vectors, the sub-solves tell them apart."""
    rng = np.random.default_rng(2)
    values = np.r_[1, 1 + 1e-9, 1 + 2e-9, 5, 7]
    u = orthogonal(rng, 5).astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        u = u @ (1.5 * np.eye(5) - 0.5 * (u.T @ u))
    v = (u * values) @ u.T
    _, x = wh.eigen((v + v.T) / 2)
    along = np.abs(u[:, ::-1].T.astype(np.float64) @ x)
    assert np.abs(along - np.eye(5)).max() < 1e-8
