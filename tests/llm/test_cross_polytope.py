import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import cross_polytope as C

NAN, INF = float("nan"), float("inf")


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.9):
    """(id, links, component, kept) of every row, over all pairs."""
    n = len(rows)
    near = [[] for _ in rows]
    for a in range(n):
        for b in range(a + 1, n):
            x, y = rows[a][1], rows[b][1]
            if usable(x) and usable(y) and len(x) == len(y):
                x, y = np.asarray(x, float), np.asarray(y, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    near[a].append(b)
                    near[b].append(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        name = min(ids) if ids else None
        out.append((rows[a][0], len(near[a]), name, rows[a][0] == name))
    return sorted(out, key=repr)


def result(df, **kw):
    return sorted([tuple(r) for r in C.near_duplicates(df, "vec_id", "embedding", **kw).collect()], key=repr)


def clustered(n, dim, seed, noise):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(1, n // 12), dim))
    out = centres[rng.integers(0, len(centres), n)] + noise * rng.standard_normal((n, dim))
    out[: n // 3] = out[0] + 0.5 * noise * rng.standard_normal((n // 3, dim))  # a third in one group
    out[n // 2 : n // 2 + 5] = out[n // 2]  # copies
    return [(int(i), v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(out)]


@pytest.mark.parametrize("dim,kind,noise", [(32, "float", 0.2), (12, "double", 0.15)])
def test_against_all_pairs(spark, dim, kind, noise):
    rows = clustered(240, dim, dim, noise)
    df = spark.createDataFrame([(i, v, "kept") for i, v in rows], f"vec_id int, embedding array<{kind}>, node string").repartition(3)
    want = brute(rows)
    assert result(df, recall=0.9999) == want
    # small buckets and parts: several hashes a table, groups cut into pairs of parts
    assert result(df, recall=0.9999, bucket=30, part=16) == want


def test_recall_at_the_threshold():
    """Pairs at exactly the threshold are found as often as asked for, however many hashes a bucket joins."""
    rng = np.random.default_rng(5)
    for dim, vectors in ((64, 10_000), (64, 3_000_000), (20, 200_000)):
        widths = C.widths_for(dim, vectors)
        h = C.Hashes(dim, widths, C.tables_for(dim, widths))
        a = C.unit_rows(rng.standard_normal((3000, dim)))
        b = rng.standard_normal((3000, dim))
        b = C.unit_rows(b - (a * b).sum(1, keepdims=True) * a)
        b = 0.9 * a + math.sqrt(0.19) * b
        found = np.zeros(len(a), bool)
        for t in range(h.tables):
            found |= (h.keys(a, t)[:, :, None] == h.keys(b, t)[:, None, :]).any((1, 2))
        assert found.mean() >= 0.97, (dim, vectors, found.mean())


def test_hadamard_is_orthogonal():
    for n in (1, 2, 8, 64):
        m = C._hadamard(np.eye(n))
        assert np.allclose(m @ m.T, np.eye(n)) and np.allclose(np.abs(m), 1 / math.sqrt(n))


def test_probes_are_the_cheapest_buckets():
    """Joint choices against all of them."""
    rng = np.random.default_rng(6)
    h = C.Hashes(8, [8, 4], 1)
    unit = C.unit_rows(rng.standard_normal((50, 8)))
    got = h.keys(unit, 0, 4)
    y = []
    for j, w in enumerate(h.widths):
        v = unit
        for r in range(C.ROUNDS):
            v = C._hadamard(v * h.signs[0, j, r])
        y.append(np.concatenate((v[:, :w], -v[:, :w]), axis=1))
    for i in range(len(unit)):
        cost = {a * 8 + b: (y[0][i].max() - y[0][i][a]) ** 2 + (y[1][i].max() - y[1][i][b]) ** 2 for a in range(16) for b in range(8)}
        assert sorted(got[i].tolist()) == sorted(sorted(cost, key=cost.get)[:4])


def test_edges(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [NAN, 1.0]), (6, [INF, 1.0]), (7, [1.0, None]), (8, [1e200, 1e190]), (9, [1e-200, 0.0]), (None, [2.0, 0.1]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, -0.0]), (4, [0.0, 0.0]), (None, [0.0, -3.0]), (12, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("root", F.lit("kept")).withColumn("a.b", F.lit(1))
    want = brute([(i, [x / 1e200 for x in v] if i == 8 else [x * 1e200 for x in v] if i == 9 else v) for i, v in rows])
    assert result(df) == want
    assert C.near_duplicates(df.limit(0), "vec_id", "embedding").count() == 0
    whole = spark.createDataFrame([(1, [3, 4]), (2, [6, 8]), (3, [-4, 3])], "vec_id int, embedding array<int>")
    assert result(whole) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
