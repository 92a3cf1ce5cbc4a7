import math

import numpy as np
import pytest

from skyledger.llm.whitening import leading, minres, op13_whitening, whiten


def whole(vectors):
    return [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]


def brute(vectors):
    """Whole numbers, exact deviations, eigenvalues and the covariance, by dense arithmetic."""
    x = whole(vectors)
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    u = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x], dtype=np.float64)
    return u, deviation, u.T @ u / n


def compare(rows, ids, vectors, components=32):
    u, deviation, v = brute(vectors)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int(np.sum(values > 1e-13 * values[0])))
    assert len(rows) == len(ids) * k
    white = np.full((len(ids), k), np.nan)
    place = {i: j for j, i in enumerate(ids)}
    for r in rows:
        j = place[r.vec_id]
        assert (r.n, int(r.deviation)) == (len(ids), deviation[j])
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        assert r.identity_error < 1e-9
        white[j, r.component - 1] = r.whitened
    centred = white - white.mean(axis=0)
    assert np.abs(centred.T @ centred / len(ids) - np.eye(k)).max() < 1e-9
    # Each column is the projection on an eigenvector: applying the covariance to it only scales it.
    for c in range(k):
        axis = u.T @ white[:, c] / len(ids) / np.sqrt(values[c])
        assert np.linalg.norm(axis) == pytest.approx(1, abs=1e-9)
        assert np.linalg.norm(v @ axis - values[c] * axis) < 1e-12 * values[0] * len(v)
        gap = min(abs(values[c] - values[o]) for o in range(len(values)) if o != c) if len(values) > 1 else 1
        if gap > 1e-3 * values[0]:
            assert np.abs(np.abs(u @ axes[:, c] / np.sqrt(values[c])) - np.abs(white[:, c])).max() < 1e-8


@pytest.mark.parametrize("spectrum", ["spread", "flat", "pairs"])
def test_jacobi_davidson_against_a_dense_solver(spectrum):
    rng = np.random.default_rng(1)
    dim = 400
    values = {"spread": 0.9 ** np.arange(dim), "flat": 1 + 0.5 * rng.random(dim), "pairs": np.repeat(np.linspace(5, 1, dim // 2), 2)}[spectrum]
    axes = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    matrix = (axes * values) @ axes.T
    passes = []
    times = lambda block: passes.append(block.shape[1]) or matrix @ block
    found, vectors = leading(times, dim, 20)
    assert np.abs(found - np.sort(values)[::-1][:20]).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(20)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * values.max()
    assert max(passes) < 100  # never a block of all dimensions


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    outside = np.linalg.qr(rng.standard_normal((30, 4)))[0]
    away = np.eye(30) - outside @ outside.T
    rhs, shifts = away @ rng.standard_normal((30, 3)), np.array([0.1, -2.0, 7.0])
    found = minres(lambda v: a @ v, rhs, shifts, outside, 60)
    for j, shift in enumerate(shifts):
        left = away @ (a - shift * np.eye(30)) @ away @ found[:, j]
        assert np.abs(left - rhs[:, j]).max() < 1e-6
        assert np.abs(outside.T @ found[:, j]).max() < 1e-12


def test_rows_equal_a_dense_whitening(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((700, 50)) * 2.0 ** -np.linspace(0, 3, 50) @ rng.standard_normal((50, 50))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    compare(got, range(700), vectors)


def test_odd_vectors_lengths_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    six = [(i, [float(x) for x in rng.standard_normal(6)], i) for i in range(60)]
    two = [(100 + i, [float(x) for x in rng.standard_normal(2) * 1e6], None) for i in range(9)]
    odd = [(200, None, 1), (201, [1.0, None] * 3, 1), (202, [float("nan")] * 6, 1), (203, [float("inf")] * 6, 1), (204, [], 1)]
    docs = spark.createDataFrame(six + two + odd, "vec_id long, embedding array<double>, component int")
    rows = whiten(docs).collect()
    compare([r for r in rows if r.vec_id < 100], [i for i, *_ in six], [v for _, v, _ in six])
    compare([r for r in rows if r.vec_id >= 100], [i for i, *_ in two], [v for _, v, _ in two])
    assert whiten(docs.limit(0)).count() == 0
    assert whiten(docs.where("vec_id = 1")).count() == 0  # one vector has no spread


def test_repeats_null_ids_and_dependent_dimensions(spark):
    rng = np.random.default_rng(5)
    flat = rng.standard_normal((40, 2)) @ rng.integers(-3, 4, (2, 5)) * 10
    rows = [(None if i % 3 == 0 else 7, [round(float(c)) * 1.0 for c in v]) for i, v in enumerate(np.concatenate([flat, flat[:10]]))]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    n = {r.component: 0 for r in got}
    for r in got:
        n[r.component] += 1
        assert r.n == 50 and r.identity_error < 1e-9
    u, deviation, _ = brute([v for _, v in rows])
    assert set(n.values()) == {50} and len(n) == np.linalg.matrix_rank(u)
    assert sorted(int(r.deviation) for r in got if r.component == 1) == sorted(deviation)


def test_exact_deviation_of_large_entries(spark):
    rows = [(i, [float(2**40 * (i % 7)), float(-i), 0.0]) for i in range(5000)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1").collect()
    _, deviation, _ = brute([v for _, v in rows])
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviation))
    with pytest.raises(Exception, match="too large to be whitened"):
        whiten(spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id long, embedding array<double>")).collect()


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(op13_whitening(spark, sf).collect(), [r.vec_id for r in table], [r.embedding for r in table])
