"""Whitening against numpy's own decomposition and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string, whitened double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "x", 0.5) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 40])
def test_decomposition_equals_numpy(n):
    rng = np.random.default_rng(n)
    for matrix in (rng.normal(size=(n, n)), np.diag(rng.normal(size=n)), np.ones((n, n)), np.eye(n), np.zeros((n, n))):
        a = (matrix + matrix.T) / 2
        diagonal, second, q = whitening.tridiagonal(a)
        t = np.diag(diagonal) + np.diag(second, 1) + np.diag(second, -1)
        assert np.allclose(q @ t @ q.T, a, atol=1e-12) and np.allclose(q @ q.T, np.eye(n), atol=1e-12)
        want = np.linalg.eigvalsh(a)[::-1]
        found = whitening.leading(diagonal, second, n)
        assert np.allclose(found, want, atol=1e-12 * max(1, np.abs(want).max()))
        v = whitening.eigenvectors(diagonal, second, found)
        assert np.allclose(v.T @ v, np.eye(n), atol=1e-10)
        assert np.allclose(t @ v, v * found, atol=1e-9)


def test_clusters_get_orthogonal_vectors():
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    values = np.concatenate([[5, 5, 5, 5 - 1e-9, 3, 3 - 1e-7, 1], np.linspace(0.5, 0, 23)])
    found, v = whitening.principal((q * values) @ q.T, 8)
    assert np.allclose(found, values[:8], atol=1e-12)
    assert np.allclose(v.T @ v, np.eye(8), atol=1e-12)


def expected(rows, k=8):
    """{id: (deviation, projections without sign)} and the shares, from exact integers."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    off = x * n - s
    centred = (off / n).astype(float)
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    keep = [i for i in range(min(k, len(values))) if values[i] > 1e-10 * values[0]]
    projected = centred @ vectors_[:, keep] / np.sqrt(values[keep])
    return {i: (int((o * o).sum()), np.abs(p)) for (i, _), o, p in zip(rows, off, projected)}, values[keep] / values.sum()


@pytest.mark.parametrize("dims", [3, 20])
def test_rows_equal_exact_arithmetic(spark, dims):
    rng = np.random.default_rng(dims)
    scale = np.linspace(3, 0.2, dims)
    rows = [(i, (rng.normal(size=dims) * scale - 0.3).astype(np.float32).tolist()) for i in range(300)]
    bad = [(900, None), (901, [float("nan"), *[0.0] * (dims - 1)]), (902, [*[0.0] * (dims - 1), float("inf")])]
    bad += [(903, [None, *[0.0] * (dims - 1)]), (904, []), (905, [1.0] * (dims + 1)), (906, [1e30] * dims)]
    found = whitening.whiten(vectors(spark, rows + bad)).collect()
    want, shares = expected(rows)
    assert len(found) == len(rows) * min(8, dims) and {r.vec_id for r in found} == set(want)
    for r in found:
        deviation, projected = want[r.vec_id]
        assert r.n == 300 and r.deviation == deviation
        assert abs(abs(r.whitened) - projected[r.component - 1]) < 1e-8
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_large_entries_and_few_directions(spark):
    rows = [(i, [float(1 << 40) * (i % 3), 1.0, -2.0]) for i in range(6)] + [(None, [0.0, 1.0, -2.0])]
    found = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.component for r in found} == {1} and len(found) == 7
    assert {r.deviation for r in found} == {None}  # beyond 64 bits
    assert max(abs(r.identity_error) for r in found) < 1e-9
    same = [(1, [1.0, 2.0]), (2, [1.0, 2.0])]
    assert whitening.whiten(vectors(spark, same)).count() == 0
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None)])).count() == 0


def test_the_query_whitens_its_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in table]
    want, shares = expected(rows)
    found = queries.op12_whitening(spark, sf_dir).withColumn("size", F.abs("whitened")).collect()
    assert len(found) == 8 * len(rows)
    for r in found:
        deviation, projected = want[r.vec_id]
        assert r.deviation == deviation and abs(r["size"] - projected[r.component - 1]) < 1e-6
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-6 and r.identity_error < 1e-6
