"""Whitening against plain numpy, and the refinement on hard spectra."""

import math

import numpy as np
import pytest

from marketframe.llm import queries as Q
from marketframe.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, n int, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA).repartition(3)


def plain(vectors, dim, components=8):
    x = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        x[i, :len(v)] = np.asarray(v, "float32").astype(float)
    x = np.floor(1024 * x) + 100_000
    c = x - x.mean(0)
    values, vecs = np.linalg.eigh(c.T @ c / len(x))
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    n, s = len(x), [int(t) for t in x.sum(0)]
    deviation = [sum((n * int(a) - b) ** 2 for a, b in zip(row, s)) for row in x]
    return deviation, c @ vecs / np.sqrt(values), values / np.trace(c.T @ c / len(x))


def test_query_equals_numpy(spark, sf_dir):
    rows = Q.op13_whitening(spark, sf_dir).toPandas()
    src = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    deviation, want, share = plain(list(src.embedding), 64)
    got = rows.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    got *= np.sign((got * want).sum(0))
    assert list(rows.component.unique()) == list(range(1, 9))
    assert np.abs(got - want).max() < 1e-9
    one = rows[rows.component == 1].sort_values("vec_id")
    assert list(one.deviation) == deviation and set(one.n) == {len(src)}
    assert np.allclose(rows.groupby("component").explained.first(), share, rtol=1e-9)
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-9


def test_odd_vectors(spark):
    good = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [1.0, -1.0]), (4, [0.0]), (5, []), (6, [-3.5, 2.0]), (7, [2.0, 2.5])]
    bad = [(2, None), (3, [1.0, None]), (8, [math.nan, 0.0]), (9, [math.inf, 0.0]), (10, [1e30, 0.0])]
    out = W.whitened(table(spark, good + bad)).toPandas()
    assert len(out) == len(good) and set(out.n) == {7}
    deviation, want, share = plain([v for _, v in good], 2)
    assert sorted(int(d) for d in out.deviation) == sorted(deviation)
    assert np.allclose(out.explained[0], share)
    assert np.allclose(sorted(abs(w[0]) for w in out.whitened), sorted(abs(want[:, 0])))
    assert out.identity_error[0] < 1e-9


def test_nothing_to_whiten(spark):
    assert W.whitened(table(spark, [])).count() == 0
    assert W.whitened(table(spark, [(1, None), (2, [])])).count() == 0
    same = W.whitened(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [list(r.whitened) for r in same] == [[None, None]] * 2
    assert all(r.identity_error is None and r.deviation == 0 for r in same)
    line = W.whitened(table(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)])).collect()
    assert all(r.whitened[1] is None and r.whitened[0] is not None for r in line)
    assert line[0].explained[0] == pytest.approx(1.0) and line[0].identity_error < 1e-9


def test_sums_are_exact_for_large_entries():
    rng = np.random.default_rng(1)
    for top in (1 << 12, 1 << 20, 1 << 22, 1 << 41):
        y = rng.integers(-top, top, (700, 3), endpoint=True)
        total = W._Products(3, top)
        for at in range(0, 700, 90):
            total.add(y[at:at + 90])
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert total.exact() == want


def hard(values, seed):
    """A symmetric matrix in extended precision with known eigenpairs."""
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ ((np.eye(len(q), dtype=np.longdouble) - q.T @ q) / 2)
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 2, 1.0], [1, 1 - 1e-5, 1 - 2e-5, 0.5, 0.5 - 1e-9, 0.1], [1e8, 1e8 - 1, 3, 3 + 1e-4, 1e-6, 1e-7],
    [1 + 1e-11, 1, 0.25, 0.2, 0.1, 0.05]])
def test_refined_vectors_reach_double_precision(values):
    a, q = hard(sorted(values, reverse=True), 3)
    found, x = W.eigenpairs((a + a.T) / 2)
    assert np.allclose(found.astype(float), sorted(values, reverse=True), rtol=1e-15 * max(values), atol=1e-17 * max(values))
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 1e-17
    gaps = np.abs(np.diff(sorted(values)))
    allowed = max(1e-16, 64 * float(np.finfo(np.longdouble).eps) * max(values) / gaps.min())
    assert np.abs(np.abs((q * x).sum(0)) - 1).max() < allowed
    assert np.abs(q * np.sign((q * x).sum(0)) - x).max() < allowed


def test_equal_eigenvalues_give_an_orthonormal_basis():
    a, _ = hard([4, 2, 2, 2, 1], 5)
    found, x = W.eigenpairs((a + a.T) / 2)
    assert np.allclose(found.astype(float), [4, 2, 2, 2, 1])
    assert np.abs(x.T @ x - np.eye(5)).max() < 1e-17 and np.abs(a @ x - x * found).max() < 1e-16
