import numpy as np
import pytest

from skyledger.llm.neighbours import PROJECTED, chi_square, cosines, nearest, op6_nearest


def brute(ids, vectors, k=5, each=50):
    out = {}
    for i in np.flatnonzero(ids % each == 0):
        score = cosines(vectors[i], vectors)
        rows = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in rows]
    return out


def compare(rows, want, least):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {q for q, found in want.items() if found}
    assert all(len(got[q]) == len(want[q]) for q in got)
    known = {q: dict(found) for q, found in want.items()}
    hits = sum(v in known[q] for q, found in got.items() for v, _ in found)
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(s == pytest.approx(known[q][v], abs=1e-12) for v, s in found if v in known[q])
    assert hits >= least * sum(len(found) for found in want.values())
    return hits / max(1, sum(len(f) for f in want.values()))


def test_chi_square():
    draws = np.random.default_rng(0).standard_normal((200_000, PROJECTED))
    for x in (2.0, 8.0, 15.5):
        assert abs(chi_square(x) - np.mean(np.sum(draws**2, axis=1) <= x)) < 0.01


def test_ties_nulls_odd_vectors_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    good = [(int(i), [float(x) for x in rng.standard_normal(6)], "c") for i in range(300)]
    hot = [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], "c") for i in range(200)]
    short = [(2000 + i, [float(i), 1.0], "c") for i in range(3)]
    odd = [(3000, None, "c"), (3050, [0.0] * 6, "c"), (3100, [float("nan")] * 6, "c"), (3150, [1.0, None, 1.0, 1.0, 1.0, 1.0], "c"), (3200, [], "c"), (3250, [float("inf")] + [1.0] * 5, "c"), (None, [1.0] * 6, None), (0, [float(x) for x in good[0][1]], "c")]
    vectors = spark.createDataFrame(good + hot + short + odd, "vec_id long, embedding array<double>, cell string")
    rows = nearest(vectors, cell_rows=60).collect()
    six = [v[:2] for v in good + hot]
    want = brute(np.array([i for i, _ in six]), np.array([v for _, v in six]))
    want |= brute(np.array([i for i, *_ in short]), np.array([v for _, v, _ in short]))
    compare(rows, want, 0.9)
    assert [r.vec_id for r in rows if r.query_id == 1150] == [1000, 1001, 1002, 1003, 1004]
    assert nearest(vectors.limit(0)).count() == 0
    assert nearest(vectors.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    table = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    want = brute(table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(np.float64))
    assert compare(op6_nearest(spark, path).collect(), want, 0.9)


def test_different_vectors_of_one_id_are_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i % 100), [float(x) for x in rng.standard_normal(4)]) for i in range(300)]
    rows += [(7, [-x for x in rows[0][1]])]
    got = nearest(spark.createDataFrame(rows + rows[:50], "vec_id long, embedding array<double>"), cell_rows=60).collect()
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    want = []
    for i in np.flatnonzero(ids % 50 == 0):
        score = cosines(vectors[i], vectors)
        best = [j for j in np.lexsort((ids, -score)) if j != i][:5]
        want += [(int(ids[i]), rank + 1, int(ids[j]), round(float(score[j]), 9)) for rank, j in enumerate(best)]
    assert len(got) == len(want) == 6 * 5
    assert len({(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got} & set(want)) >= 0.9 * len(want)
