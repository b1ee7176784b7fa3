import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from rankwatch.operators import challenger as ch
from rankwatch.operators import lineage as ln
from rankwatch.operators import metrics as mt
from rankwatch.operators import model as md
from rankwatch.plans import runs
from rankwatch.sources.outputs import load_bundle, save_bundle

from .conftest import csv_lines


def hashed(df, columns=None):
    return ln.content_hash(df, columns).first()["content_hash"]


def test_hash_is_of_rows_not_of_their_order(spark, frame):
    df = frame(50)
    want = hashed(df)
    assert hashed(df.repartition(7)) == want == hashed(df.orderBy(F.desc("age")).coalesce(1))
    assert hashed(df.select(*reversed(df.columns))) == want
    assert hashed(df.withColumn("age", F.when(F.col("customer_id") == 10007, 1).otherwise(F.col("age")))) != want
    assert hashed(df.limit(49)) != want and hashed(df.union(df.limit(1))) != want
    assert hashed(df.limit(0)) == "0"


def test_fields_are_kept_apart(spark):
    pairs = [("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("-", "abc"), ("1:a", None), ("1:a", "-")]
    own = {hashed(spark.createDataFrame([p], "x string, y string")) for p in pairs}
    assert len(own) == len(pairs)


@pytest.fixture()
def bundle(frame, small_cfg):
    return md.train(frame(60), small_cfg)


def test_version_outlives_a_round_trip(spark, frame, small_cfg, bundle, tmp_path):
    save_bundle(bundle, f"{tmp_path}/b")
    assert ln.model_version(load_bundle(spark, f"{tmp_path}/b")) == ln.model_version(bundle)
    other = md.train(frame(56), small_cfg)
    assert ln.model_version(other) != ln.model_version(bundle)


def test_scored_rows_carry_their_run(spark, small_cfg, bundle, write_csv, tmp_path):
    p = lambda name: f"{tmp_path}/{name}"
    save_bundle(bundle, p("b"))
    write_csv("batch/a.csv", csv_lines(9, target=False))
    write_csv("batch/b.csv", csv_lines(14, target=False)[:1] + csv_lines(14, target=False)[10:])
    scored, _ = runs.run_scoring(spark, p("batch"), small_cfg, p("b"), p("s"), p("sum"), run_id="r-7")
    run = spark.read.parquet(p("sum.run")).first()
    assert (run["run_id"], run["input_rows"], run["model_name"]) == ("r-7", 14, md.MODEL_NAME)
    rows = scored.collect()
    assert {r["run_id"] for r in rows} == {"r-7"} and {r["input_hash"] for r in rows} == {run["input_hash"]}
    files = {r["customer_id"]: r[ln.SOURCE_FILE].rsplit("/", 1)[1] for r in rows}
    assert [files[10000 + i] for i in range(14)] == ["a.csv"] * 9 + ["b.csv"] * 5
    record = ln.Run(**run.asDict())
    assert {r["rows"] for r in ln.unlike(scored, record).collect()} == {0}
    odd = scored.withColumn("model_version", F.when(F.col("review_rank") > 3, F.col("model_version")))
    assert {r["column"]: r["rows"] for r in ln.unlike(odd, record).collect()}["model_version"] == 3


def test_challenger_sees_the_same_test_rows(spark, frame, cfg):
    df = frame(80)
    models, scored = ch.challenge(df, cfg, trees=3, depth=2)
    held = runs.stratified_split(df, cfg).where("split = 'test'")
    assert {r[0] for r in scored.select("customer_id").collect()} == {r[0] for r in held.select("customer_id").collect()}
    champion = md.train(df, cfg).predict_proba(held.drop("split"), "p").join(scored, "customer_id")
    assert champion.where(F.abs(F.col("p") - F.col(ch.CHAMPION)) > 1e-6).count() == 0
    report = {r["model"]: r for r in ch.compare(scored, cfg).collect()}
    for name in (ch.CHAMPION, ch.CHALLENGER):
        want = mt.model_metrics(scored, cfg, name).first()
        assert report[name]["recall"] == want["recall"] and report[name]["rows"] == scored.count()
        assert 0 <= report[name]["pr_auc"] <= 1
    again = models[ch.CHALLENGER].transform(held.drop("split"))
    assert isinstance(models[ch.CHALLENGER], PipelineModel) and again.count() == scored.count()


def test_challenger_needs_both_classes(frame, cfg):
    with pytest.raises(ValueError, match="both classes"):
        ch.challenge(frame(20).withColumn("churn", F.lit(1)), cfg)
