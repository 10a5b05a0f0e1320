"""Whitening against a dense eigensolver."""

from __future__ import annotations

import math

import numpy as np
import pytest

from catalith.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def dense(rows, k=8):
    """Exact deviations and the whitened vectors up to sign, from the full covariance."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v, _ in rows], dtype=object)
    n, total = len(x), x.sum(axis=0)
    apart = x * n - total
    centred = apart.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return (apart * apart).sum(axis=1), centred @ vectors / np.sqrt(values), values / (centred**2).sum() * n


def made(n, dims, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    scale = spread ** np.arange(dims)
    x = rng.normal(size=(n, dims)) * scale + 0.3
    return [(i, [float(np.float32(c)) for c in v], 1) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]


def table(df):
    found = df.orderBy("vec_id", "component").collect()
    k = max(r.component for r in found)
    return found, np.array([r.whitened for r in found]).reshape(-1, k)


@pytest.mark.parametrize(("n", "dims", "spread"), [(300, 64, 1.0), (200, 100, 0.97), (90, 12, 0.8), (40, 3, 1.0)])
def test_components_are_those_of_a_dense_solver(spark, n, dims, spread):
    rows = made(n, dims, spread=spread)
    found, white = table(whitening.whitening_report(spark.createDataFrame(rows, VECTORS).repartition(3)))
    deviations, wanted, explained = dense(rows)
    k = min(8, dims)
    assert white.shape == (n, k)
    sign = np.sign((white * wanted).sum(axis=0))
    assert np.abs(white * sign - wanted).max() < 1e-7
    assert [r.deviation for r in found[::k]] == list(deviations)
    assert np.allclose([r.explained for r in found[:k]], explained, rtol=1e-9)
    assert {r.n for r in found} == {n}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_the_filter_certifies_close_eigenvalues(spark):
    vectors = whitening.whole_vectors(spark.createDataFrame(made(400, 80, 3), VECTORS))
    model = whitening.fit_whitening(vectors)
    assert model.residuals.max() <= whitening.FLOOR * model.values[0]
    assert (np.diff(model.values) <= 0).all()
    assert np.abs(model.vectors.T @ model.vectors - np.eye(8)).max() < 1e-12
    # One pass per degree and one per round: far fewer than a power iteration on such a spectrum.
    assert model.passes < 120


def test_odd_rows(spark):
    good = made(60, 6, 5)
    odd = [
        (100, None, 1), (101, [], 1), (102, [None] * 6, 1), (103, [float("nan")] * 6, 1), (104, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0], 1),
        (105, [1.0, 2.0], 1), (None, good[0][1], None), (0, good[0][1], 2),
    ]
    df = spark.createDataFrame(good + odd, VECTORS).selectExpr("*", "1 AS x", "'a' AS row_key", "2 AS component", "0 AS n")
    found = whitening.whitening_report(df).collect()
    kept = good + odd[-2:]
    assert len(found) == 6 * len(kept) and {r.n for r in found} == {len(kept)}
    wanted = dict(zip([r[0] for r in kept], dense(kept)[0], strict=True))
    assert {r.vec_id: r.deviation for r in found} == wanted


def test_nothing_to_whiten(spark):
    assert whitening.whitening_report(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whitening_report(spark.createDataFrame([(1, [0.5, 0.5], 1)], VECTORS)).count() == 0
    same = [(i, [0.5, 0.25, 0.125], 1) for i in range(5)]
    assert whitening.whitening_report(spark.createDataFrame(same, VECTORS)).count() == 0
    # One direction with spread: one component.
    line = [(i, [0.1 * i, 0.5], 1) for i in range(5)]
    assert [r.component for r in whitening.whitening_report(spark.createDataFrame(line, VECTORS)).collect()] == [1] * 5


def test_exact_numbers_beyond_a_long(spark):
    x = np.array([[1 << 20, 0], [0, 1 << 19]], dtype=np.int64)
    sums = x.sum(axis=0)
    n = 1 << 35
    assert whitening._deviations(x, n, sums) == [sum((int(n) * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
