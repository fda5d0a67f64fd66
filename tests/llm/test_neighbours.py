"""Nearest neighbours: error bounds, recall and rules against brute force."""

import numpy as np
import pytest

from blotter.llm.neighbours import codes_of, estimates, nearest, rotation


def brute(rows, every, k):
    good = {}
    for i, e in rows:
        if i is not None and e is not None and None not in e and np.isfinite(e).all() and np.any(np.array(e) != 0):
            good.setdefault((i, tuple(np.float32(e))), None)
    ids = np.array([i for i, _ in good])
    x = np.array([e for _, e in good], float)
    out = {}
    for n, i in enumerate(ids):
        if i % every == 0:
            s = (x * x[n]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("dim", [7, 64, 100])
def test_bounds_hold(dim):
    rng = np.random.default_rng(dim)
    x, q = rng.normal(size=(3000, dim)), rng.normal(size=(40, dim))
    centre, rotate = x.mean(axis=0), rotation(dim)
    assert np.allclose(rotate @ rotate.T, np.eye(dim))
    guess, error = estimates(q, *codes_of(x, centre, rotate), centre, rotate)
    off = np.abs(guess - q @ x.T)
    assert (off <= error).mean() > 0.999
    assert np.corrcoef(guess.ravel(), (q @ x.T).ravel())[0, 1] > 0.6


@pytest.mark.parametrize("blocks", [(8192, 1024), (50, 7)])
def test_nearest_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    x = np.float32(rng.normal(size=(400, 16)))
    rows = [(i, e.tolist()) for i, e in enumerate(x)]
    same = x[5].tolist()
    rows += [(1000 + i, same) for i in range(90)]           # a hot vector, queries among its ids
    rows += [(2000, [0.0] * 16), (2020, None), (2040, [None] + [1.0] * 15), (2060, [float("nan")] + [1.0] * 15),
             (2080, [float("inf")] + [1.0] * 15), (None, same), (2100, [1.0] * 3), rows[20], (-20, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS search", "2 AS score")
    got = {}
    for r in nearest(df.repartition(4), 20, 20, vector_block=blocks[0], query_block=blocks[1]).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute([r for r in rows if r[0] != 2100], 20, 20)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
        for (_, v, s), (w, t) in zip(found, want[q]):
            assert s == pytest.approx(t, abs=1e-9) or v == w
    assert hits / (20 * len(want)) > 0.98


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(20, [1.0, 2.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0])], schema)
    assert [tuple(r) for r in nearest(one).orderBy("rank").collect()] == [(20, 1, 3, 1.0), (20, 2, 4, 1.0)]
    assert nearest(spark.createDataFrame([], schema)).count() == 0
    assert nearest(spark.createDataFrame([(20, [0.0])], schema)).count() == 0
    assert nearest(spark.createDataFrame([(20, [1.0])], schema)).count() == 0
