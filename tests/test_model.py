import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankwatch.operators import model as md
from rankwatch.operators import prep as pr
from rankwatch.operators.split import stratified_split
from rankwatch.sources import tables as tb
from rankwatch.sources.outputs import load_bundle, save_bundle

from .conftest import SMALL_DIR


def matrix(df):
    return np.array([r[0] for r in df.select(vector_to_array("features")).collect()])


def test_width_and_unseen_level(frame, cfg):
    df = frame(4)
    stages, prepared = pr.fit_prep(df, cfg, "2024-02-01")
    levels = sum(df.select(c).distinct().count() for c in cfg.categorical)
    x = matrix(prepared)
    assert x.shape == (4, 12 + levels)
    odd = df.limit(1).withColumn("city", F.lit("Elsewhere"))
    y = matrix(stages.transform(odd))
    assert y.shape == (1, 12 + levels)
    assert y.sum() == pytest.approx(matrix(stages.transform(df.limit(1))).sum() - 1)


def test_missing_level_takes_the_mode(frame, cfg):
    df = frame(5).withColumn("city", F.expr("CASE WHEN customer_id < 10002 THEN city END"))
    assert pr.learn_categories(df, cfg)[1]["city"] == "Multan"  # one each: the smaller value
    _, prepared = pr.fit_prep(df, cfg)
    assert matrix(prepared)[:, 12:].sum(axis=1).tolist() == [5.0] * 5


def test_mode_of_letters(spark, cfg):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "a", "b", None]], "x string")
    assert pr.learn_categories(df, cfg.with_(categorical=("x",))) == ({"x": ["a", "b", "c"]}, {"x": "a"})


def test_scaling_after_filling(spark, cfg):
    small = cfg.with_(numeric=("v", "gone", "same"), text_column="t", ticket_column="same")
    df = spark.createDataFrame(
        [(1.0,), (2.0,), (None,), (3.0,), (10.0,)], "v double"
    ).selectExpr(
        "v", "CAST(NULL AS DOUBLE) AS gone", "7D AS same", "'x' AS t", "DATE '2024-01-01' AS signup_date"
    )
    derived = pr.derive_stage(df.schema, small).transform(df)
    fit = pr.fit_numeric(derived, small)
    filled = np.array([1.0, 2.0, 2.5, 3.0, 10.0])
    assert (fit["v"].median, fit["v"].mean) == (2.5, pytest.approx(filled.mean()))
    assert fit["v"].std == pytest.approx(filled.std())
    assert fit["same"].std == 0 and pr.scale_sql(derived.schema, "same", fit["same"]) == "0D"
    assert fit["gone"] == pr.NumericFit(0.0, 0.0, 0.0)


def test_many_levels(spark, cfg):
    df = spark.range(30_000).selectExpr("CAST(id AS STRING) AS x")
    levels, _ = pr.learn_categories(df, cfg.with_(categorical=("x",)))
    assert len(levels["x"]) == 30_000


@pytest.fixture(scope="module")
def snapshot(spark):
    return tb.snapshot(spark, SMALL_DIR).cache()


@pytest.fixture(scope="module")
def bundle(spark, snapshot):
    from rankwatch.config import Config

    return md.train(snapshot, Config())


def newton(x, y):
    """Minimum of the weighted log loss plus half the squared coefficients, no penalty on
    the intercept."""
    n, pos = len(y), y.sum()
    w = np.where(y == 1, n / (2 * pos), n / (2 * (n - pos)))
    a = np.hstack([x, np.ones((n, 1))])
    b, ridge = np.zeros(a.shape[1]), np.eye(a.shape[1])
    ridge[-1, -1] = 0
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ b))
        grad = a.T @ (w * (p - y)) + ridge @ b
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + ridge
        b -= np.linalg.solve(hess, grad)
    return b


def test_fit_is_the_optimum(snapshot, bundle, cfg):
    train = stratified_split(snapshot, cfg).where("split = 'train'").orderBy("customer_id")
    x = matrix(bundle.model.transform(train))
    y = np.array([r["churn"] for r in train.collect()], dtype=float)
    want = newton(x, y)
    p = 1 / (1 + np.exp(-(x @ want[:-1] + want[-1])))
    got = [r["churn_probability"] for r in bundle.predict_proba(train).collect()]
    assert np.abs(np.array(got) - p).max() < 1e-6


def test_bundle_facts(snapshot, bundle, cfg):
    m = bundle.meta
    assert (m["train_rows"], m["validation_rows"], m["test_rows"]) == (90, 30, 30)
    assert m["model_name"] == "logistic_regression"
    assert m["reference_date"] == "1998-08-08"
    assert m["validation_support"] == round(m["validation_positive_rate"] * 30)
    # Raw rows have no tenure column, so it is not part of the profile.
    names = {r["feature"] for r in bundle.ref_numeric.collect()}
    assert names == set(cfg.monitor_numeric) - {cfg.tenure_column}
    scored = bundle.predict_proba(snapshot.drop("churn"))
    assert scored.where("churn_probability BETWEEN 0 AND 1").count() == 150
    labels = bundle.predict(snapshot.drop("churn"), threshold=0.3)
    assert labels.where("predicted_label = 1").count() == scored.where("churn_probability >= 0.3").count()


def test_bundle_round_trip(spark, snapshot, bundle, tmp_path):
    path = str(tmp_path / "bundle")
    save_bundle(bundle, path)
    again = load_bundle(spark, path)
    assert again.meta == bundle.meta
    key = lambda b: {tuple(r) for r in b.predict_proba(snapshot).select("customer_id", "churn_probability").collect()}
    assert key(again) == key(bundle)
    assert {tuple(r) for r in again.ref_categorical.collect()} == {
        tuple(r) for r in bundle.ref_categorical.collect()
    }


def test_missing_bundle(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, str(tmp_path / "nothing"))


def test_one_class_is_refused(frame, cfg):
    with pytest.raises(ValueError, match="both classes"):
        md.train(frame(20).withColumn("churn", F.lit(0)), cfg)
