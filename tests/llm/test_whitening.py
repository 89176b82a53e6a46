"""Components against a full eigendecomposition, and the exact figures against whole numbers."""

from __future__ import annotations

import numpy as np
import pytest

from loyaltylens.llm import whitening as w


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return q @ np.diag(values) @ q.T


SPECTRA = [
    [3.0],
    [2.0, 1.0],
    list(np.linspace(5, 4, 40)),
    [7.0] * 9 + [1.0] * 6 + [0.0] * 5,
    list(10.0 ** np.arange(4, -6, -1)),
    [1 + 1e-9 * i for i in range(12)],
    [9.0, 1.0, 0.0, 0.0],
]


@pytest.mark.parametrize("values", SPECTRA)
def test_inertia(values):
    matrix = symmetric(values)
    for shift in (-1.0, 0.5, 1.5, 4.2, 6.9999, 8.0):
        assert w.eigenvalues_above(matrix, shift) == sum(v > shift for v in values)
    hollow = np.array([[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]])
    assert w.eigenvalues_above(hollow, 0.0) == 1


@pytest.mark.parametrize("values", SPECTRA)
def test_components(spark, values):
    matrix = symmetric(values, 1)
    found, vectors = w.leading_components(spark, matrix, 16)
    expected = sorted((v for v in values if v > 1e-10), reverse=True)[:16]
    assert np.allclose(found, expected, rtol=1e-9, atol=1e-13 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * max(values) * len(values)


def frame(spark, rows):
    extra = [(i, v, 1, 2.0) for i, v in rows]
    return spark.createDataFrame(extra, "vec_id bigint, embedding array<float>, n int, whitened double")


def exact(vectors):
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    sums = [sum(column) for column in zip(*fit)]
    return x, fit, sums


def test_against_full_decomposition(spark):
    rng = np.random.default_rng(5)
    base = (rng.standard_normal((150, 20)) * np.linspace(4, 0.5, 20)).astype(np.float32).tolist()
    rows = [*enumerate(base), *[(900 + i, base[0]) for i in range(70)], (3, base[3]), (None, base[4])]
    bad = [None, [], base[0][:5], [None, *base[0][1:]], [float("nan"), *base[0][1:]], [float("inf"), *base[0][1:]]]
    table = frame(spark, [*rows, *((10_000 + i, v) for i, v in enumerate(bad))])
    found = w.whiten(table).collect()
    assert len(found) == 16 * len(rows) and not any((r["vec_id"] or 0) >= 10_000 for r in found)
    x, fit, sums = exact([v for _, v in rows])
    n = len(fit)
    centre = (np.array(fit) * n - np.array(sums)) / n
    covariance = centre.T @ centre / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    expected = {}
    for (vec_id, _), own in zip(rows, x):
        y = [n * a - s for a, s in zip(own, sums)]
        expected[vec_id] = (sum(a * a for a in y), np.array(y) / n @ vectors / np.sqrt(values))
    signs = {}
    for r in found:
        deviation, projected = expected[r["vec_id"]]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["explained"] - values[k] / np.trace(covariance)) < 1e-12
        assert r["identity_error"] < 1e-10
        if abs(projected[k]) > 1e-6:
            signs.setdefault(k, set()).add(bool(r["whitened"] * projected[k] > 0))
        assert abs(abs(r["whitened"]) - abs(projected[k])) < 1e-8
    assert all(len(s) == 1 for s in signs.values()) and len(signs) == 16
    assert len({r["identity_error"] for r in found}) == 1


def test_few_and_flat(spark):
    assert w.whiten(frame(spark, [])).collect() == []
    assert w.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert w.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    rows = w.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 4.0]), (2, [1.0, 4.0]), (3, [7.0])])).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"]) for r in rows) == [(1, 1, 2, 128**2), *[(2, 1, 2, 128**2)] * 2]
    assert np.allclose(sorted(abs(r["whitened"]) for r in rows), 1) and rows[0]["explained"] == pytest.approx(1)


def test_exact_beyond_64_bits(spark):
    large = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 3.0]), (3, [5.0, 2.0**41])]
    rows = w.whiten(frame(spark, large)).collect()
    x, fit, sums = exact([v for _, v in large])
    for r in rows:
        own = x[r["vec_id"] - 1]
        deviation = sum((3 * a - s) ** 2 for a, s in zip(own, sums))
        assert r["deviation"] == (deviation if deviation < 1 << 63 else None)
    y = w.centred(np.array([[1 << 61, 1]]), 5, [1 << 62, 3])
    assert y.tolist() == [[(5 << 61) - (1 << 62), 2]]
    assert w.exact_deviation(np.array([[3, 4]], object)).to_pylist() == [25]
