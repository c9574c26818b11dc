import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import whitening as W


def brute(vectors, k=8):
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    y = (n * x - s).astype(object)
    v = ((y.T @ y).astype(float)) / n**3
    e, q = np.linalg.eigh(v)
    return n, (y * y).sum(1), e[::-1][:k], q[:, ::-1][:, :k], np.trace(v), y.astype(float) / n


def check(out, ids, vectors, k=8):
    n, deviation, e, q, trace, y = brute(vectors, k)
    want = y @ q / np.sqrt(e)
    got = {}
    for r in out:
        assert r["n"] == n and r["identity_error"] <= 1e-9
        got.setdefault(r["id"], {})[r["component"]] = r
    assert sorted(got) == sorted(ids)
    for j in range(len(e)):
        mine = np.array([got[i][j + 1]["whitened"] for i in ids])
        sign = np.sign((mine * want[:, j]).sum())
        assert np.abs(mine - sign * want[:, j]).max() < 1e-8
        assert abs(got[ids[0]][j + 1]["explained"] / (e[j] / trace) - 1) < 1e-10
    assert [int(got[i][1]["deviation"]) for i in ids] == [int(d) for d in deviation]
    assert all(sorted(g) == list(range(1, len(e) + 1)) for g in got.values())


@pytest.mark.parametrize("dim,kind", [(24, "float"), (5, "double")])
def test_against_eigh(spark, dim, kind):
    rng = np.random.default_rng(dim)
    v = (rng.standard_normal((700, dim)) * np.linspace(3, 0.2, dim)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, x.tolist(), "kept") for i, x in enumerate(v)], f"vec_id int, embedding array<{kind}>, x string").repartition(5)
    check(W.whiten(df, "vec_id", "embedding").collect(), list(range(700)), v)


def test_solver_against_eigh():
    rng = np.random.default_rng(3)
    for d in (1, 2, 8, 13, 60, 150):
        a = rng.standard_normal((400, d)) * np.geomspace(1, 1e-3, d)
        m = a.T @ a
        m = (m + m.T) / 2
        e, v, r = W.jacobi_davidson(lambda b: m @ b, d, 8)
        w, q = np.linalg.eigh(m)
        k = min(d, 8)
        assert np.abs(e - w[::-1][:k]).max() < 1e-13 * w[-1] and r.max() < 1e-12
        assert np.abs(np.abs((q[:, ::-1][:, :k] * v).sum(0)) - 1).max() < 1e-10


def test_solver_repeated_eigenvalues():
    m = np.diag([5.0] * 3 + [4.0] * 4 + [1.0] * 40)
    e, v, _ = W.jacobi_davidson(lambda b: m @ b, 47, 8)
    assert np.allclose(e, [5, 5, 5, 4, 4, 4, 4, 1]) and np.allclose(v.T @ v, np.eye(8))


def test_minres_solves():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((20, 20))
    m, b = a + a.T, rng.standard_normal((20, 3))
    x = W._minres(lambda v: m @ v, b, 40)
    assert np.abs(m @ x - b).max() < 1e-6


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [3.5, -1.0], [0.25, 8.0], [-7.0, 2.5]]
    rows = [(i, v) for i, v in enumerate(good)] + [(20, None), (21, [1.0, None]), (22, [nan, 1.0]), (23, [1.0, -inf]), (24, []), (25, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("dim", F.lit("kept")).withColumn("a.b", F.lit(1))
    check(W.whiten(df, "vec_id", "embedding").collect(), [0, 1, 2, 3], good)
    assert W.whiten(df.limit(0), "vec_id", "embedding").count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert W.whiten(same, "vec_id", "embedding").count() == 0  # nothing varies
    line = spark.createDataFrame([(1, [1.0, 2.0]), (1, [2.0, 2.0]), (None, [4.0, 2.0])], "vec_id bigint, embedding array<double>")
    out = W.whiten(line, "vec_id", "embedding").collect()
    assert len(out) == 3 and {r["component"] for r in out} == {1} and out[0]["explained"] == pytest.approx(1)


def test_large_entries_stay_exact(spark):
    v = [[1e12, 3.0], [1e12 + 1, 5.0], [1e12 - 7, -2.0]]
    df = spark.createDataFrame(list(enumerate(v)), "vec_id bigint, embedding array<double>")
    _, deviation, *_ = brute(v)
    out = {r["id"]: int(r["deviation"]) for r in W.whiten(df, "vec_id", "embedding").collect()}
    assert [out[i] for i in range(3)] == [int(x) for x in deviation]
