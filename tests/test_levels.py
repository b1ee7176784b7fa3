import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankwatch.operators import levels as lv
from rankwatch.operators import model as md
from rankwatch.operators import prep as pr
from rankwatch.sources.outputs import load_bundle, save_bundle


def matrix(df, columns=("customer_id",)):
    rows = df.select(*columns, vector_to_array(pr.FEATURES).alias("x")).orderBy(*columns).collect()
    return np.array([r["x"] for r in rows])


@pytest.mark.parametrize("odd", [[None, "zz", "Multan", "\u00e9\u4e2d", ""], ["only"] * 3 + [None]])
def test_joined_levels_equal_labels(frame, cfg, odd):
    df = frame(40).withColumn("city", F.element_at(F.array(*[F.lit(x).cast("string") for x in odd]), (F.col("customer_id") % len(odd) + 1).cast("int")))
    (labels, one), (table, two) = (pr.fit_prep(df, cfg, "2024-03-01", most_labels=m) for m in (10_000, 0))
    assert bool(lv.tables_of(labels)) == ("" in odd) and len(lv.tables_of(table)) == 1
    assert np.allclose(matrix(one), matrix(two))
    new = frame(8).withColumns({"city": F.lit("never seen"), "gender": F.lit(None).cast("string")})
    assert np.allclose(matrix(labels.transform(new)), matrix(table.transform(new)))


def test_numbers_follow_the_order_of_levels(spark):
    values = [("a", f"{i % 997:04d}-x") for i in range(3000)] + [("b", v) for v in ("\u00e9", "z", "Z", "", "\U0001f600", "\uffee")]
    counts = lv.level_counts(spark.createDataFrame([(v if c == "a" else None, v if c == "b" else None) for c, v in values], "a string, b string"), ["a", "b", "c"])
    got = {}
    for r in lv.numbered_levels(counts, ["a", "b", "c"]).collect():
        got.setdefault(r["feature"], {})[r["level"]] = r["index"]
    for c in ("a", "b"):
        own = sorted({v for f, v in values if f == c}, key=lambda v: v.encode())
        assert got[c] == {v: i for i, v in enumerate(own)}


def test_300_000_levels_stay_off_the_driver(spark, cfg, monkeypatch):
    n = 300_000
    base = spark.range(n).selectExpr("id AS customer_id", "concat('2024-01-15-', lpad(id, 7, '0')) AS city", "IF(id % 3 = 0, 'x', 'y') AS kind")
    own = cfg.with_(categorical=("city", "kind"))
    monkeypatch.setattr(lv, "labels_of", None)  # no list of levels is asked for
    stages, kept = pr.fit_levels(base, own, {})
    assert kept == ["city", "kind"]
    vectors = PipelineModel(stages).transform(base.where("customer_id % 1000 = 7"))
    rows = vectors.select("customer_id", lv.set_position("city").alias("p"), lv.set_position("kind").alias("k")).collect()
    assert len(rows) == 300 and all(r["p"] == r["customer_id"] and r["k"] == (r["customer_id"] % 3 > 0) for r in rows)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_bundle_takes_its_levels_along(spark, frame, cfg, tmp_path, monkeypatch):
    monkeypatch.setattr(pr, "MOST_LABELS", 0)
    df = frame(60)
    monkeypatch.setattr(pr.fit_prep, "__defaults__", (None, pr.DIRECT_ROWS, 0))
    bundle = md.train(df, cfg)
    assert lv.tables_of(bundle.model)
    want = sorted(map(tuple, bundle.predict_proba(df).select("customer_id", "churn_probability").collect()))
    save_bundle(bundle, f"{tmp_path}/one")
    (tmp_path / "two").mkdir()
    (tmp_path / "one").rename(tmp_path / "two/bundle")
    for table in lv.tables_of(bundle.model):
        from rankwatch.sources.staging import _delete

        _delete(spark, table)
    back = load_bundle(spark, f"{tmp_path}/two/bundle")
    got = sorted(map(tuple, back.predict_proba(df).select("customer_id", "churn_probability").collect()))
    assert got == want


def test_no_levels_at_all(spark, cfg):
    df = spark.createDataFrame([(1, None), (2, None)], "customer_id long, kind string")
    stages, kept = pr.fit_levels(df, cfg.with_(categorical=("kind",)), {})
    assert kept == [] and len(stages) == 1
