"""op13 against numpy's eigenvectors of the whole covariance."""

import numpy as np
import pytest

from conftest import EDGE_VECTORS
from ledgerspark.llm import whitening as W


def expected(vectors):
    x = np.floor(64 * np.asarray(vectors, dtype=float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = (n * fit - sums) / n
    values, vecs = np.linalg.eigh(c.T @ c / n)
    stay = values[::-1] > W.FLOOR * values.sum()
    values, vecs = values[::-1][stay][:W.COMPONENTS], vecs[:, ::-1][:, stay][:, :W.COMPONENTS]
    return n, ((n * x - sums) ** 2).sum(axis=1), ((n * x - sums) / n) @ vecs / np.sqrt(values), values / np.trace(c.T @ c / n)


def check(rows, ids, vectors):
    n, deviation, whitened, explained = expected(vectors)
    k = len(explained)
    assert len(rows) == k * len(ids)
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9
    assert len({r.identity_error for r in rows}) == 1
    by = {}
    for r in rows:
        by.setdefault(r.component, []).append((str(r.vec_id), r.deviation, r.whitened, r.explained))
    assert sorted(by) == list(range(1, k + 1))
    for c, mine in by.items():
        assert np.allclose([m[3] for m in mine], explained[c - 1], rtol=1e-9)
        want = [sorted(zip(map(str, ids), deviation.tolist(), sign * whitened[:, c - 1])) for sign in (1, -1)]
        have = sorted(m[:3] for m in mine)
        assert [h[:2] for h in have] == [w[:2] for w in want[0]]
        assert any(np.allclose([h[2] for h in have], [w[2] for w in side], atol=1e-8) for side in want)


@pytest.mark.parametrize("n, d, groups", [(400, 64, 256), (300, 24, 256), (200, 7, 2)])
def test_scores_against_numpy(spark, monkeypatch, n, d, groups):
    monkeypatch.setattr(W, "GROUPS", groups)
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((n, d)) / np.arange(1, d + 1)).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:50], vectors[:1].repeat(200, axis=0)])  # repeats weigh nothing
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>").repartition(5)
    check(W.whiten(df).collect(), ids, vectors)


def test_awkward_rows(spark, edge_dir):
    used = [(i, v) for i, v in EDGE_VECTORS if v is not None and len(v) == 3 and all(e is not None and np.isfinite(e) for e in v)]
    check(W.query(spark, edge_dir).collect(), [i for i, _ in used], np.array([v for _, v in used], dtype=np.float32))


def test_wide_numbers_stay_exact(spark):
    vectors = [[1e300, 0.0], [-5e9, 1.0], [3.25, 2.0], [0.0, -1e300]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = W.whiten(df).collect()
    x = [[int(np.floor(64 * max(-2.0 ** 40, min(2.0 ** 40, e)))) + 1_000_000 for e in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((4 * e - s) ** 2 for e, s in zip(v, sums)) for v in x]
    assert {(r.vec_id, r.deviation) for r in rows} == {(i, w if w < 1 << 63 else None) for i, w in enumerate(want)}


@pytest.mark.parametrize("d, shape", [(200, "plain"), (150, "steep"), (120, "low rank"), (300, "flat"), (40, "double")])
def test_solver_reaches_double_precision(d, shape):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((3 * d, d))
    a = {"plain": a, "steep": a / np.arange(1, d + 1) ** 2, "low rank": a[:, :5] @ rng.standard_normal((5, d)), "flat": a * (1 + 0.01 * rng.random(d)),
         "double": np.concatenate([a[:, :20], a[:, :20]], axis=1) @ np.kron(np.eye(2), np.eye(20))}[shape]
    v = a.T @ a / len(a)
    values, vecs = W.jacobi_davidson(lambda b: v @ b, d)
    true = np.linalg.eigvalsh(v)[::-1][:16]
    assert len(values) == 16 and np.abs(values - true).max() < 1e-12 * true[0]
    assert np.linalg.norm(v @ vecs - vecs * values, axis=0).max() < 1e-12 * true[0]
    assert np.abs(vecs.T @ vecs - np.eye(16)).max() < 1e-12
