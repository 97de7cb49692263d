"""Whitening against numpy on the whole fit list."""

import math
import random

import numpy as np
import pytest

from tessera.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(vectors, k=4):
    """Distinct integer rows; variances and components from a singular value decomposition of the centred rows."""
    x = np.array(sorted({tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors}), float)
    mean = x.mean(axis=0)
    _, s, right = np.linalg.svd(x - mean, full_matrices=True)
    e = np.zeros(x.shape[1])
    e[:len(s)] = s ** 2 / len(x)
    return x, mean, e[:k], right[:k], e.sum()


def vectors(n, dim, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(dim, dim)) * np.linspace(1, 0.05, dim)[:, None]
    return (rng.normal(size=(n, dim)) @ mixed * scale).tolist()


def test_equals_numpy(spark):
    data = vectors(300, 8, 1)
    rows = [(i, v, 0) for i, v in enumerate(data)] + [(500 + i, data[0], 1) for i in range(200)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    models = whitening.fit(df)
    x, mean, e, parts, total = plain(data)
    assert [m.n for m in models] == [len(x)] and models[0].identity_error < 1e-9
    assert np.allclose(models[0].variances, e, rtol=1e-10)
    assert np.allclose(models[0].explained, e / total, rtol=1e-10)
    got = {r.vec_id: r.white for r in whitening.whiten(df, models, "white").collect()}
    assert len(got) == len(rows)
    sign = np.sign((models[0].components * parts).sum(axis=1))
    for i, v, _ in rows:
        own = np.array([math.floor(256 * float(np.float32(c))) for c in v])
        want = (own - mean) @ parts.T / np.sqrt(e) * sign
        assert np.allclose(got[i].whitened, want, atol=1e-8)
        assert got[i].deviation == sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(own, x.sum(axis=0)))


def test_ill_conditioned_rows_become_orthonormal():
    """Three passes on columns of conditions up to 1e9; a plain Cholesky of the Gram matrix fails there."""
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.normal(size=(400, 10)))
    v, _ = np.linalg.qr(rng.normal(size=(10, 10)))
    x = u * np.logspace(0, -9, 10) @ v.T
    made = lambda factors: whitening.solved(x, factors)
    factors, _ = whitening.triangular_factors(lambda f: made(f).T @ made(f), 400, 10)
    q = made(factors)
    with pytest.raises(np.linalg.LinAlgError):
        np.linalg.cholesky(x.T @ x - 1e-17 * np.eye(10))
    # On the ridge of 1e-9 the last direction keeps half of its length.
    assert np.allclose((q.T @ q)[:8, :8], np.eye(8), atol=1e-2)
    ridge = np.sqrt(whitening.RIDGE * np.trace(x.T @ x)) * np.eye(10)
    both = np.vstack([q, whitening.solved(ridge, factors)])
    assert np.allclose(both.T @ both, np.eye(10), atol=1e-12)


def test_far_from_zero(spark):
    """Sums of large integers and a small spread: centring is exact."""
    rng = random.Random(4)
    data = [[2.0 ** 14 + rng.randrange(8) / 256, -(2.0 ** 15) + rng.randrange(4) / 256, 5.0] for _ in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    model, = whitening.fit(df)
    x, _, e, _, total = plain(data)
    assert np.allclose(model.variances, e[:3], rtol=1e-9, atol=1e-12)
    assert model.variances[2] == 0 and model.identity_error < 1e-9
    row = whitening.whiten(df, [model], "w").first().w
    assert row.whitened[2] is None and row.explained[2] == 0 and None not in row.whitened[:2]


def test_awkward_vectors(spark, tmp_path):
    rows = [(1, None, 0), (2, [1.0, None], 0), (3, [float("nan"), 1.0], 0), (4, [float("inf"), 0.0], 0),
            (5, [], 0), (6, [0.5, 0.25], 0), (7, [0.5, 0.25], 0), (None, [-0.5, 0.1], 0), (9, [-0.0, 0.9], 0),
            (10, [1.0, 2.0, 3.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'a' AS x", "1 AS n", "2 AS white")
    models = whitening.fit(df)
    assert [(m.dim, m.n) for m in models] == [(2, 3), (3, 1)]
    got = whitening.whiten(df, models, "made")
    assert got.columns == [*df.columns, "made"]
    found = {r.vec_id: r.made for r in got.collect()}
    assert set(found) == {6, 7, None, 9, 10}
    assert found[6] == found[7] and len(found[6].whitened) == 2
    assert found[10].whitened == [None] * 3 and found[10].deviation == 0 and found[10].explained == [None] * 3
    assert found[10].identity_error is None
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    out = queries.op11_whitening(spark, str(tmp_path)).collect()
    assert sorted((str(r.vec_id), r.component) for r in out) == sorted(
        (str(i), c) for i, k in [(6, 2), (7, 2), (None, 2), (9, 2), (10, 3)] for c in range(1, k + 1))


def test_empty_and_unusable_tables(spark):
    for rows in [], [(1, None, 0), (2, [], 1)]:
        df = spark.createDataFrame(rows, VECTORS)
        assert whitening.fit(df) == []
        assert whitening.whiten(df, [], "w").count() == 0


def test_large_deviation():
    big = whitening.Whitening(2, 10, [3, -4], np.eye(2), [1.0, 1.0], [0.5, 0.5])
    x = np.array([[2 ** 40, 1], [7, 8], [2 ** 27, -5]])
    want = [sum((10 * int(a) - s) ** 2 for a, s in zip(r, (3, -4))) for r in x.tolist()]
    assert big.deviations(x) == [None if w >= 2 ** 63 else w for w in want]
    assert big.deviations(x[1:]) == want[1:]


def test_entries_beyond_64_bits(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 4.0]), (4, [1e300, 8.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    models = whitening.fit(df)
    got = {r.vec_id: r.w for r in whitening.whiten(df, models, "w").collect()}
    assert all(r.deviation is None for r in got.values())
    assert got[1].whitened[0] * got[2].whitened[0] < 0 and abs(got[3].whitened[0]) < abs(got[2].whitened[0])
