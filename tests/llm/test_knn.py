import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwatch.llm import knn

SCHEMA = "vec_id long, embedding array<float>, rank string"


def brute(rows, k, every):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[i] = np.floor(64 * np.array(v, np.float32).astype(float))
    out = set()
    for q in good:
        if q % every == 0:
            best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def vectors(n, seed):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(6, 8))
    out = [(i, (centres[i % 6] * (1 + i % 3) + 0.1 * g.normal(size=8)).tolist(), "x") for i in range(n)]
    out += [(1000 + i, [0.5] * 8, "x") for i in range(40)]  # ties
    return out


@pytest.mark.parametrize(("k", "pivots", "block"), [(5, 16, 4096), (20, 8, 16), (3, 64, 7)])
def test_search_equals_brute_force(spark, monkeypatch, k, pivots, block):
    monkeypatch.setattr(knn, "BLOCK_ROWS", block)
    monkeypatch.setattr(knn, "CHUNK_QUERIES", 5)
    rows = vectors(300, k)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = knn.search(df, F.col("vec_id") % 10 == 0, k, pivots)
    assert {tuple(r) for r in got.collect()} == brute(rows, k, 10)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], "x"), (10, [1.0, -2.0], "x"), (11, [0.0, 0.0], "x"), (12, None, "x"), (13, [], "x"),
        (14, [1.0, None], "x"), (15, [float("nan"), 1.0], "x"), (16, [float("inf"), 1.0], "x"), (17, [1.0], "x"),
        (None, [3.0, 3.0], "x"), (18, [9.0, 9.0], "x"), (18, [9.0, 9.0], "x"), (20, [-0.01, 0.02], "x"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in knn.search(df, F.col("vec_id") % 10 == 0).collect()}
    assert got == brute(rows, 20, 10)
    assert {r[0] for r in got} == {0, 10, 20}
    assert knn.search(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame(rows[:1], SCHEMA)
    assert knn.search(one, F.col("vec_id") % 10 == 0).count() == 0


def test_each_length_is_searched_on_its_own(spark):
    rows = vectors(200, 3) + [(500, [1.0] * 9, "x")] + [(600 + i, [float(i), 1.0, 2.0], "x") for i in range(30)]
    got = knn.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)
    assert {tuple(r) for r in got.collect()} == brute(rows, 20, 10)


def test_far_cells_are_left_out():
    """Tight clusters: a query is sent to few cells, and none that holds a neighbour is missed."""
    rng = random.Random(2)
    x = np.array([[100.0 * (c == d) + rng.random() for d in range(10)] for c in range(10) for _ in range(30)])
    top = float((x**2).sum(axis=1).max())
    cells = knn.Cells(x[::30], np.sqrt(top - (x[::30] ** 2).sum(axis=1)), top)
    d = cells.data_distances(x)
    home = d.argmin(axis=1)
    own = d[np.arange(len(x)), home]
    cells.count = np.bincount(home, minlength=10)
    cells.near = np.array([own[home == c].min() for c in range(10)])
    cells.far = np.array([own[home == c].max() for c in range(10)])
    cells.nearest = np.stack([np.sort(own[home == c])[:6] for c in range(10)])
    q = x[:20]
    dq = cells.query_distances(q)
    reach = cells.reach(dq, 5)
    exact = np.sqrt(np.maximum((q**2).sum(axis=1)[:, None] + top - 2 * q @ x.T, 0))
    fifth = np.sort(exact, axis=1)[:, 5]
    assert (reach >= fifth - 1e-6).all()
    need = cells.needed(dq, dq.argmin(axis=1), fifth)
    for i in range(20):
        assert need[i, home[exact[i] <= fifth[i]]].all()
    assert need.sum(axis=1).mean() < 5
