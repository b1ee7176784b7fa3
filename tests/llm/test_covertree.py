import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rankwatch.llm import covertree as ct
from tests.llm.brute import roots

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    n = len(rows)
    whole = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and None not in v
        v = np.array(v, float) if ok else np.zeros(0)
        whole.append(v if ok and np.isfinite(v).all() and v.any() else None)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = whole[i], whole[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                links[i].append(j)
                links[j].append(i)
    root = roots(n, [(i, j) for i in range(n) for j in links[i]])
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]] = min(least.get(root[i], r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        c = least.get(root[i])
        out.append((r[0], len(links[i]), c, r[0] is not None and r[0] == c))
    return out


def same(got, want):
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def vectors(seed, n, dim=16, groups=12, noise=0.12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dim))
    kind = rng.integers(groups, size=n)
    x = base[kind] + noise * rng.normal(size=(n, dim)) * rng.choice([0.1, 1, 3], size=(n, 1))
    return x.astype(np.float32)


@pytest.mark.parametrize("chunk", [4096, 60, 13])
def test_equals_all_pairs(spark, chunk):
    x = vectors(1, 700)
    rows = [(i * 3 % 701, v.tolist(), int(i % 3 == 0)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    same(ct.near_duplicates(df, chunk=chunk), brute(rows))


@pytest.mark.parametrize("noise, cosine", [(0.01, 0.98), (0.05, 0.98), (0.3, 0.9), (0.001, 1 - 1e-6)])
def test_trees_count_what_pairs_count(noise, cosine):
    x = vectors(2, 900, noise=noise).astype(float)
    weight = np.random.default_rng(0).integers(1, 4, len(x))
    norm = np.linalg.norm(x, axis=1)
    near = (x @ x.T) / np.outer(norm, norm) >= cosine
    order, tree = ct.build_tree(x, weight)
    mine, _, first = ct.traverse(tree, None, cosine)
    np.fill_diagonal(near, False)
    assert np.array_equal(mine, (near @ weight)[order])
    i, j = np.nonzero(near[np.ix_(order, order)])
    assert [first[k] for k in range(len(x))] == roots(len(x), list(zip(i, j, strict=True)))
    half = 400
    (p, one), (q, two) = ct.build_tree(x[:half], weight[:half]), ct.build_tree(x[half:], weight[half:])
    mine, theirs, first = ct.traverse(one, two, cosine)
    cross = near[:half, half:][np.ix_(p, q)]
    assert np.array_equal(mine, cross @ two.weight) and np.array_equal(theirs, cross.T @ one.weight)
    i, j = np.nonzero(cross)
    assert first.tolist() == roots(len(x), list(zip(i, j + half, strict=True)))


def test_levels_halve_and_cover():
    x = vectors(3, 2000).astype(float)
    _, tree = ct.build_tree(x, np.ones(len(x), int))
    u = tree.x / tree.norm[:, None]
    for node in tree.node:
        own = u[node["start"] : node["end"]]
        d = np.sqrt(np.maximum(2 - 2 * own @ u[node["centre"]], 0))
        assert abs(d.max() - node["radius"]) < 1e-6
        kids = tree.node[node["kids"] : node["kids_end"]] if node["kids"] else []
        if len(kids):
            level = 2.0 ** np.floor(np.log2(node["radius"]))
            assert kids[0]["centre"] == node["centre"] and max(kids["radius"]) <= level
            c = u[kids["centre"]]
            apart = np.sqrt(np.maximum(2 - 2 * c @ c.T, 0))[np.triu_indices(len(kids), 1)]
            assert apart.min() > min(level, node["radius"]) / 2


def test_dense_group_is_counted_without_its_pairs(spark):
    rng = np.random.default_rng(5)
    x = np.ones(8) + 0.001 * rng.normal(size=(3000, 8))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = ct.near_duplicates(df, chunk=256)
    assert got.groupBy("n_links", "component_id").count().collect() == [(2999, 0, 3000)]


def test_odd_input(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 0.01], 1),
            (12, [1.0, 0.0, 0.0], 1), (13, [1.0], 1), (1, [0.0, 1.0], 1), (0, [0.0, 5.0], 1), (14, [-1.0, 0.0], 1),
            (15, [-0.0, 3e38], 2), (16, [0.0, 1e-38], 2), (None, None, None)] + [(20, [0.3, 0.4], 3)] * 40
    df = spark.createDataFrame(rows, COLUMNS)
    clash = df.withColumns({c: F.lit(1) for c in ("g", "v", "key", "cell", "n", "weight", "links", "a", "b", "least")})
    same(ct.near_duplicates(clash), brute(rows))
    same(ct.near_duplicates(clash, chunk=3), brute(rows))
    assert ct.near_duplicates(df.limit(0)).collect() == []


def test_very_long_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6, 200_000)).astype(np.float32)
    x[3:] = x[:3] + 0.05 * x[3:]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    same(ct.near_duplicates(spark.createDataFrame(rows, COLUMNS)), brute(rows))


def test_query_on_a_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(entry.queries()["op13_embedding_near_dedup"](spark, d), brute(rows))
