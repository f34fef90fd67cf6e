import math

import numpy as np
import pytest

from vigil.llm.registry import op11_whitening
from vigil.llm.whitening import deviations, eigen, fit_whitening, one_sided_jacobi, pivoted_cholesky, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n int, vector string, part int"


def frame(spark, vectors, ids=None):
    """With columns named like the operator's own."""
    return spark.createDataFrame([(i, v, 0, 7, "x", 3) for i, v in zip(ids or range(len(vectors)), vectors)], SCHEMA)


def brute(vectors):
    """Covariance, eigenvalues and eigenvectors from exact whole numbers."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    t = [[n * c - s for c, s in zip(row, sums)] for row in x]
    width = len(sums)
    covariance = np.array([[sum(r[i] * r[j] for r in t) / n**3 for j in range(width)] for i in range(width)])
    values, vectors_ = np.linalg.eigh(covariance)
    return t, covariance, values[::-1], vectors_[:, ::-1]


def check(rows, vectors, ids, k):
    t, covariance, values, components = brute(vectors)
    n = len(vectors)
    assert len(rows) == n * k
    by_key = {(r.vec_id, r.component): r for r in rows}
    for i, row in zip(ids, t):
        for c in range(k):
            r = by_key[(i, c + 1)]
            assert r.n == n and r.deviation == sum(v * v for v in row)
            assert r.explained == pytest.approx(values[c] / np.trace(covariance), rel=1e-9)
            expected = np.array(row) / n @ components[:, c] / math.sqrt(values[c])
            sign = 1 if expected * r.whitened >= 0 else -1
            assert sign * r.whitened == pytest.approx(expected, abs=1e-8)
            assert r.identity_error < 1e-9
    for c in range(k):  # one sign per component
        expected = np.array(t) / n @ components[:, c]
        signs = {np.sign(e * by_key[(i, c + 1)].whitened) for i, e in zip(ids, expected) if abs(e) > 1e-6}
        assert len(signs) == 1


@pytest.mark.parametrize("width,partitions", [(12, 1), (12, 7), (3, 5)])
def test_equals_brute_force(spark, width, partitions):
    made = np.random.default_rng(width).normal(size=(60, width)) * np.linspace(0.05, 1, width) + 0.3
    vectors = [[float(np.float32(c)) for c in v] for v in made]
    vectors += vectors[:5]  # repeated
    rows = frame(spark, vectors).repartition(partitions)
    found = whiten(rows, fit_whitening(rows)).collect()
    check(found, vectors, range(len(vectors)), min(8, width))


def test_odd_vectors(spark):
    good = [[0.1, 0.2, -0.3], [0.4, -0.1, 0.2], [-0.5, 0.3, 0.1], [0.2, 0.2, 0.9], [0.1, -0.7, 0.4]]
    odd = [None, [0.1, None, 0.2], [0.1, float("nan"), 0.2], [float("inf"), 0.0, 0.0], [0.0, float("-inf"), 1.0]]
    short = [[], [0.25]]
    rows = frame(spark, good + odd + short, ids=[None, *range(1, 12)])
    found = whiten(rows, fit_whitening(rows)).collect()
    used = good + [v + [0.0] * (3 - len(v)) for v in short]
    check(found, used, [None, 1, 2, 3, 4, 10, 11], 3)


def test_no_vectors_and_no_variance(spark):
    for vectors in ([], [None, [None], [float("nan")]], [[]]):
        rows = frame(spark, vectors)
        assert whiten(rows, fit_whitening(rows)).collect() == []
    same = frame(spark, [[0.5, 0.25]] * 3)
    found = whiten(same, fit_whitening(same)).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {
        (i, c, 3, 0, None, 0.0, 0.0) for i in range(3) for c in (1, 2)
    }
    flat = frame(spark, [[0.5, 0.5], [0.25, 0.25], [0.0, 0.0]])  # one direction only
    model = fit_whitening(flat)
    assert len(model.eigenvalues) == 1 and model.explained[0] == pytest.approx(1)
    second = [r.whitened for r in whiten(flat, model).collect() if r.component == 2]
    assert second == [None] * 3


def test_large_numbers(spark):
    vectors = [[1e30, 1.0], [-1e30, 2.0], [3.0, 1e6]]
    rows = frame(spark, vectors)
    found = whiten(rows, fit_whitening(rows)).collect()
    x = np.array([[2**40, 1024], [-(2**40), 2048], [3072, 1024 * 10**6]]) + 100000
    sums = [int(s) for s in x.sum(axis=0)]
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert [(r.vec_id, r.deviation) for r in sorted(found) if r.component == 1] == [
        (i, e if e < 2**63 else None) for i, e in enumerate(exact)
    ]
    assert exact[0] >= 2**63 > exact[2]
    x = np.array([[2**20, 5], [7, 2**31], [1, 1]], np.int64) + 100000
    sums = tuple(int(s) for s in x.sum(axis=0))
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert deviations(x, 3, sums) == [e if e < 2**63 else None for e in exact]
    assert deviations(x + 2**33, 3 * 10**9, tuple(s * 10**9 for s in sums)) == [None] * 3


def test_eigen_equals_numpy():
    chooser = np.random.default_rng(4)
    for width, rank in ((1, 1), (2, 2), (9, 9), (40, 40), (40, 11), (5, 0)):
        half = chooser.normal(size=(width, rank)) * np.logspace(0, -5, rank)
        matrix = half @ half.T
        factor, order = pivoted_cholesky(matrix)
        assert np.allclose(np.tril(factor), factor) and np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], atol=1e-13)
        assert np.all(np.diff(np.diag(factor)) <= 1e-12)
        turned = one_sided_jacobi(factor)
        products = turned.T @ turned
        assert np.allclose(products, np.diag(np.diag(products)), atol=1e-13)
        values, vectors = eigen(matrix)
        expected = np.linalg.eigvalsh(matrix)[::-1]
        assert len(values) <= rank
        assert np.allclose(values, expected[: len(values)], rtol=1e-6, atol=1e-14)
        assert np.allclose(matrix @ vectors, vectors * values, atol=1e-13)


def test_query_over_the_table(spark):
    rows = op11_whitening(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(rows, [r.embedding for r in table], [r.vec_id for r in table], 8)
