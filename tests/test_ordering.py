import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankwatch.operators import ordering
from rankwatch.operators.ordering import (
    Cuts,
    Target,
    cut_points,
    global_rank,
    medians,
    order_statistics,
    running_totals,
    slice_count,
)

SHAPES = {
    "spread": lambda g, i: g.random(),
    "one third equal": lambda g, i: 0.5 if i % 3 == 0 else g.random(),
    "few values": lambda g, i: round(g.random(), 1),
    "constant": lambda g, i: 0.25,
    "gaps": lambda g, i: (None, float("nan"), g.random())[i % 3],
    "edges": lambda g, i: (float("inf"), float("-inf"), g.random())[i % 3],
}


def table(spark, shape, n=1500, ids=lambda i: i):
    g = random.Random(7)
    data = [(ids((i * 37) % n), SHAPES[shape](g, i), f"row {i}") for i in range(n)]
    kind = "string" if isinstance(data[0][0], str) else "long"
    return spark.createDataFrame(data, f"id {kind}, p double, note string").repartition(5)


@pytest.mark.parametrize("shape", SHAPES)
def test_rank_equals_plain_window(spark, shape):
    df = table(spark, shape)
    got = global_rank(df, "p", "id", "rank", slices=64)
    assert got.columns == ["id", "p", "note", "rank"]
    clean = F.when(~F.isnan("p"), F.col("p"))
    plain = F.row_number().over(Window.orderBy(clean.desc_nulls_last(), F.col("id")))
    want = {r["id"]: r["w"] for r in df.select("id", plain.alias("w")).collect()}
    assert {r["id"]: r["rank"] for r in got.collect()} == want


@pytest.mark.parametrize("prefix", ["c", "", "a long common beginning of ids "])
def test_rank_with_text_ids_is_the_order_of_the_ids(spark, prefix):
    df = table(spark, "one third equal", 600, ids=lambda i: f"{prefix}{i}")
    got = global_rank(df, "p", "id", "rank", slices=64)
    plain = F.row_number().over(Window.orderBy(F.col("p").desc(), F.col("id")))
    want = {r["id"]: r["w"] for r in df.select("id", plain.alias("w")).collect()}
    assert {r["id"]: r["rank"] for r in got.collect()} == want


def test_rank_with_null_ids(spark):
    for kind, one in (("long", 1), ("string", "1")):
        holes = spark.createDataFrame([(None, 0.5), (one, 0.5), (None, None)], f"id {kind}, p double")
        assert sorted(r["rank"] for r in global_rank(holes, "p", "id", "rank").collect()) == [1, 2, 3]


def test_slices_follow_the_rows(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert slice_count(spark, 10) == 4 * parts
    assert slice_count(spark, 10**12) == 10**12 // ordering.ROWS_PER_SLICE


def test_offsets_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SLICES_PER_BLOCK", 3)
    totals = spark.range(20).selectExpr("id * 2 AS s", "id + 1 AS n")
    got = {r["s"]: r["b"] for r in ordering._offsets(totals, "s", {"b": "n"}).collect()}
    assert got == {2 * i: i * (i + 1) // 2 for i in range(20)}


def test_a_wrong_count_is_an_error(spark):
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS v")
    with pytest.raises(ValueError, match="number of values"):
        order_statistics(df, {"v": Target(F.col("v"), 500, 500, 1000)}, 5, 1000)


def test_rank_of_nothing(spark):
    assert global_rank(table(spark, "spread").limit(0), "p", "id", "rank").count() == 0


def test_rank_with_sampled_cut_points(spark, monkeypatch):
    df = table(spark, "one third equal", 3000)
    few = lambda d, c, n, rows: cut_points(d, c, n, rows, 1)
    monkeypatch.setattr(ordering, "cut_points", few)
    got = global_rank(df, "p", "id", "rank", slices=8)
    plain = F.row_number().over(Window.orderBy(F.col("p").desc(), F.col("id")))
    want = {r["id"]: r["w"] for r in df.select("id", plain.alias("w")).collect()}
    assert {r["id"]: r["rank"] for r in got.collect()} == want


def global_rank_slices(df):
    """Rows per window partition of the rank plan."""
    seen = {}
    original = ordering._offsets

    def spy(totals, key, sums):
        seen["totals"] = totals
        return original(totals, key, sums)

    ordering._offsets = spy
    try:
        global_rank(df, "p", "id", "rank", slices=64)
    finally:
        ordering._offsets = original
    return [r["_n"] for r in seen["totals"].collect()]


def test_crowded_score_is_spread_over_tasks(spark):
    """A score held by a third of the rows may not meet in one slice."""
    df = table(spark, "one third equal", 6400)
    found = cut_points(df, {"p": F.col("p")}, 64, 6400)["p"]
    assert found.hot == {0.5: pytest.approx(64 / 3, abs=2)}
    sizes = global_rank_slices(df)
    assert max(sizes) <= 2 * 6400 / 64 and sum(sizes) == 6400
    cuts = Cuts.of([0.1, 0.5, 0.5, 0.5, 0.5, 0.9])
    assert cuts.points == (0.1, 0.5, 0.9)
    assert cuts.hot == {0.5: 4}
    assert cuts.fan_out(10_000) == {128: [0.5]}
    assert cuts.fan_out(50) == {50: [0.5]}


BEGINNINGS = {
    "dates": lambda i: f"2024-{i % 10 + 10}-15-of-the-northern-branch-{i:07d}",
    "long and short": lambda i: ("x" * (i % 7) + "/") * (1 + i % 3) + f"{i * 7919 % 6400:05d}",
    "nested": lambda i: f"{'ab'[i % 2]}-a-long-beginning-{'cd'[i % 3 % 2]}-another-{i % 50:02d}-end-{i:06d}",
    "zero bytes": lambda i: "k" + "\0" * (i % 40) + ("z" if i % 5 else ""),
    "signs of all widths": lambda i: "aé€😀"[i % 4] * (1 + i % 3) + f"{i:05d}",
}


@pytest.mark.parametrize("shape", BEGINNINGS)
def test_few_beginnings_of_text_ids_fill_many_slices(spark, shape):
    """One score, and ids that share few beginnings: slices stay even, and the order right."""
    n, of = 6400, BEGINNINGS[shape]
    df = spark.createDataFrame([(of(i), 0.5) for i in range(n)], "id string, p double").repartition(3)
    sizes = global_rank_slices(df)
    most = max(df.groupBy("id").count().agg(F.max("count")).first()[0], 2 * n // 64)
    assert sum(sizes) == n and (shape == "zero bytes" or max(sizes) <= most), max(sizes)
    got = global_rank(df, "p", "id", "rank", slices=64).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, n + 1))
    assert [r["id"] for r in got] == sorted((of(i) for i in range(n)), key=lambda t: t.encode())


def test_how_many_texts_are_below(spark):
    cuts = sorted({f"{c}{i:02d}".encode() for c in "bdf" for i in range(0, 60, 7)} | {b"\xff", b"d"})
    texts = ["", "a", "b", "b00", "b000", "b30", "d", "d0", "é", "z", *(c.decode("latin1") for c in cuts)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for known in (cuts, cuts[:1], cuts[:8], []):
        got = df.select("t", ordering.texts_upto(F.col("t").cast("binary"), known).alias("n")).collect()
        assert all(r["n"] == sum(c <= r["t"].encode() for c in known) for r in got)


def test_running_totals(spark):
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) / 7 AS k", "id % 5 AS a", "1 AS b")
    got = running_totals(df, "k", {"ta": "a", "tb": "b"}, df, slices=16).orderBy(F.desc("k")).collect()
    ta = tb = 0
    for r in got:
        ta, tb = ta + r["a"], tb + r["b"]
        assert (r["ta"], r["tb"]) == (ta, tb)
    assert len(got) == 1000


@pytest.mark.parametrize(("direct", "sample"), [(10, 10_000), (50, 300), (100, 40), (10_000, 1)])
def test_medians_match_sorting(spark, direct, sample):
    g = random.Random(3)
    data = [(g.gauss(0, 1), float(g.randrange(4)), 5.0 if i % 3 else None) for i in range(1001)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
    got = medians(df, {c: F.col(c) for c in df.columns}, counts, direct, sample)
    for i, c in enumerate(df.columns):
        v = sorted(r[i] for r in data if r[i] is not None)
        n = len(v)
        assert got[c] == (v[(n - 1) // 2] + v[n // 2]) / 2


def test_median_of_even_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a double, b double")
    assert medians(df, {"a": F.col("a"), "b": F.col("b")}, {"a": 4, "b": 0}) == {"a": 2.5, "b": None}


@pytest.mark.parametrize(("direct", "sample"), [(5, 1000), (40, 100), (1000, 1)])
def test_order_statistics_positions(spark, direct, sample):
    df = spark.range(500).selectExpr("CAST(pmod(id * 7919, 500) AS DOUBLE) AS v")
    t = {str(k): Target(F.col("v"), k, k, 500) for k in (0, 1, 249, 498, 499)}
    got = order_statistics(df, t, direct, sample)
    assert {k: (f.low, f.high, f.upto) for k, f in got.items()} == {
        str(k): (float(k), float(k), k + 1) for k in (0, 1, 249, 498, 499)
    }


@pytest.mark.parametrize("shape", ["two heavy", "heavy low", "heavy high", "straddle", "one", "ends infinite"])
def test_order_statistics_with_heavy_values(spark, shape, monkeypatch):
    """Heavy values at the ends of a bracket are counted and left out: what is ordered stays small."""
    n = 40_000
    value = {
        "two heavy": "CASE WHEN id % 1000 < 499 THEN 1D WHEN id % 1000 < 998 THEN 9D ELSE 1 + 8D * id / 40000 END",
        "heavy low": "CASE WHEN id % 10 < 9 THEN 1D ELSE 2D + id END",
        "heavy high": "CASE WHEN id % 10 < 9 THEN 1e9 ELSE 2D + id END",
        "straddle": "CASE WHEN id < 20000 THEN 1D ELSE 1D + id END",
        "one": "7D",
        "ends infinite": "CASE WHEN id % 3 = 0 THEN CAST('-Infinity' AS DOUBLE) WHEN id % 3 = 1 THEN CAST('Infinity' AS DOUBLE) ELSE 1D * id END",
    }[shape]
    df = spark.range(n).selectExpr(f"{value} AS v").repartition(4).cache()
    values = sorted(r["v"] for r in df.collect())
    places = {"first": (0, 0), "last": (n - 1, n - 1), "mid": ((n - 1) // 2, n // 2), "third": (n // 3, n // 3), "near": (19_999, 20_000)}
    targets = {k: ordering.Target(F.col("v"), a, b, n) for k, (a, b) in places.items()}
    seen = []
    monkeypatch.setattr(ordering.Bracket, "found", _watch(ordering.Bracket.found, seen))
    got = ordering.order_statistics(df, targets, direct_rows=60, sample_rows=2_000)
    for k, (a, b) in places.items():
        assert (got[k].low, got[k].high) == (values[a], values[b]), k
        assert got[k].upto == sum(v <= values[b] for v in values), k
    assert all(inside <= 60 or settled for inside, settled in seen), seen


def _watch(found, seen):
    def run(self, *args):
        seen.append((self.inside, self.settled))
        return found(self, *args)

    return run
