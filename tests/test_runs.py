import pathlib

import pytest
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.operators import metrics as mt
from rankwatch.operators import profile as pf
from rankwatch.operators import verify as vf
from rankwatch.operators.quality import DataValidationError
from rankwatch.plans import runs
from rankwatch.sources import staging
from rankwatch.sources.outputs import read_report, read_scored
from rankwatch.sources.staging import shared_dir
from rankwatch.streaming.arrivals import score_arrivals

from .conftest import csv_lines


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return tmp_path_factory.mktemp("runs")


@pytest.fixture(scope="module")
def cfg():
    return Config(test_size=0.25, validation_size=0.25, top_k=3)


@pytest.fixture(scope="module")
def trained(spark, place, cfg):
    path = place / "train.csv"
    path.write_text("\n".join(csv_lines(12)) + "\n")
    runs.run_training(spark, str(path), cfg, str(place / "bundle"))
    return str(path)


def batch(place, name, n=12):
    path = place / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(csv_lines(n, target=False)) + "\n")
    return str(path)


def test_everything_from_csv_to_handoff(spark, place, cfg, trained):
    p = lambda name: str(place / name)
    path = batch(place, "batch.csv")
    for fmt in ("parquet", "csv"):
        scored, _ = runs.run_scoring(
            spark, path, cfg, p("bundle"), p(f"scored_{fmt}"), p(f"summary_{fmt}"), out_fmt=fmt
        )
        back = read_scored(spark, p(f"scored_{fmt}"), fmt)
        assert sorted(r["review_rank"] for r in back.collect()) == list(range(1, 13))
        assert back.where("review_queue_flag").count() == 3
    tables = runs.run_evaluation(spark, trained, cfg, p("evaluation"))
    assert tables["model_metrics"].first()["rows"] == 3
    names = {r["slice_name"] for r in tables["slice_metrics"].collect()}
    assert {"city", "age_band", "support_ticket_band"} <= names
    runs.run_monitoring(spark, path, cfg, p("bundle"), p("drift"))
    sections = {r["section"] for r in read_report(spark, p("drift")).collect()}
    assert sections == {"numeric_drift", "categorical_drift", "prediction_drift", "findings"}

    checks = runs.run_handoff(
        spark, p("bundle"), p("scored_parquet"), cfg, p("evaluation"), p("drift"), 3
    )
    summary = {r["name"]: r["passed"] for r in vf.handoff([checks]).collect()}
    assert summary == dict.fromkeys(
        ("model_artifact", "prediction_artifact", "evaluation_report", "drift_report", "handoff"),
        True,
    )
    checks = runs.run_handoff(spark, p("bundle"), p("scored_csv"), cfg, top_k=3, fmt="csv")
    assert checks.where("NOT passed").count() == 0
    assert checks.where("check = 'skipped'").count() == 2


def staged_files(spark):
    root = pathlib.Path(shared_dir(spark).removeprefix("file:")) / f"rankwatch-{staging._RUN}"
    return [p for p in root.rglob("*.parquet")] if root.exists() else []


def test_runs_leave_nothing_staged(spark, place, cfg, trained):
    staging.drop_staged(spark)
    p = lambda name: str(place / name)
    path = batch(place, "left.csv")
    runs.run_training(spark, trained, cfg, p("lb"))
    runs.run_evaluation(spark, trained, cfg, p("le"))
    runs.run_scoring(spark, path, cfg, p("lb"), p("ls"), p("lss"))
    runs.run_monitoring(spark, path, cfg, p("lb"), p("ld"))
    runs.run_profile(spark, trained, cfg, p("lp"))
    runs.run_upload(spark, path, cfg, p("lb"), p("lu"), p("lus"))
    batch(place, "left/one.csv", 12)
    q = score_arrivals(spark, p("left"), p("lb"), cfg, p("lout"), p("lstate"))
    q.awaitTermination()
    assert q.exception() is None
    assert staged_files(spark) == []


def test_missing_tickets_or_labels_stop_evaluation_and_profile(frame, cfg):
    gaps = frame(8).withColumn("churn_probability", F.lit(0.5)).withColumn(
        "support_tickets", F.expr("CASE WHEN customer_id > 10001 THEN support_tickets END")
    )
    with pytest.raises(mt.RuleError, match="support_tickets"):
        runs.evaluate(gaps, cfg)
    with pytest.raises(mt.RuleError, match="support_tickets"):
        pf.profile(gaps, cfg)


def test_handoff_without_files(spark, place, cfg):
    p = lambda name: str(place / name)
    checks = runs.run_handoff(spark, p("no"), p("no"), cfg, p("no"), p("no"))
    assert {r["name"] for r in checks.where("NOT passed").collect()} == {
        "model_artifact", "prediction_artifact", "evaluation_report", "drift_report",
    }


def test_profile_run(spark, place, cfg, trained):
    tables = runs.run_profile(spark, trained, cfg, str(place / "profile"))
    assert len(tables) == 9
    assert spark.read.parquet(str(place / "profile" / "overview")).first()["row_count"] == 12


def test_empty_batch(spark, place, cfg, trained):
    scored, summary = runs.run_scoring(
        spark, batch(place, "empty.csv", 0), cfg, str(place / "bundle"), str(place / "e1"), str(place / "e2")
    )
    assert scored.count() == 0 and summary.first()["row_count"] == 0


def test_upload(spark, place, cfg, trained):
    p = lambda name: str(place / name)
    run = lambda path: runs.run_upload(spark, path, cfg, p("bundle"), p("u1"), p("u2"))
    run(batch(place, "upload.csv", 8))
    assert read_scored(spark, p("u1"), "csv").count() == 8
    bad = place / "short.csv"
    bad.write_text("customer_id,age\n1,20\n")
    with pytest.raises(DataValidationError, match="required_column in city"):
        run(str(bad))
    with pytest.raises(FileNotFoundError):
        runs.run_upload(spark, batch(place, "upload.csv", 8), cfg, p("no"), p("u1"), p("u2"))


def test_arriving_files(spark, place, cfg, trained):
    p = lambda name: str(place / name)
    batch(place, "inbox/one.csv", 12)

    def go():
        q = score_arrivals(spark, p("inbox"), p("bundle"), cfg, p("out"), p("state"), reject=True)
        q.awaitTermination()
        assert q.exception() is None

    go()
    assert spark.read.parquet(p("out/scored")).count() == 12
    batch(place, "inbox/two.csv", 8)
    bad = place / "inbox" / "bad.csv"
    bad.write_text("\n".join(csv_lines(4, target=False)).replace("Quetta", "NA") + "\n")
    go()
    scored = spark.read.parquet(p("out/scored"))
    per = {r["batch"]: r["count"] for r in scored.groupBy("batch").count().collect()}
    assert sorted(per.values()) == [8, 12]
    for b, n in per.items():
        ranks = [r["review_rank"] for r in scored.where(f"batch = {b}").collect()]
        assert sorted(ranks) == list(range(1, n + 1))
    codes = {r["code"] for r in spark.read.parquet(p("out/rejected")).collect()}
    assert codes == {"missing_values"}
    assert spark.read.parquet(p("out/drift")).select("batch").distinct().count() == 2
    go()
    assert spark.read.parquet(p("out/scored")).count() == 20


def test_config_from_a_document():
    raw = {
        "data": {"id_column": "id", "target_column": "gone"},
        "features": {"numeric": ["a"], "categorical": ["b"], "date": ["d"], "text": ["t"],
                     "derived": {"tenure_column": "days"}},
        "baseline": {"support_tickets_threshold": 5},
        "evaluation": {"split": {"test_size": 0.1, "random_seed": 1}, "review_queue": {"default_top_k": 9}},
        "validation": {"required_columns": ["id"], "allow_missing_values": False,
                       "numeric_ranges": {"a": {"min": 0, "max": 9}}},
        "monitoring": {"key_numeric_features": ["a"], "key_categorical_features": []},
    }
    both = {**raw, "features": {**raw["features"], "date": ["d", "e"], "text": ["t", "u"]}}
    assert (Config.from_dict(both).dates, Config.from_dict(both).texts) == (("d", "e"), ("t", "u"))
    assert (Config.from_dict(both).date_column, Config.from_dict(both).text_column) == ("d", "t")
    c = Config.from_dict(raw)
    assert (c.id_column, c.target_column, c.numeric, c.tenure_column) == ("id", "gone", ("a",), "days")
    assert (c.ticket_threshold, c.test_size, c.seed, c.top_k) == (5, 0.1, 1, 9)
    assert c.ranges == {"a": (0, 9)} and c.allow_missing is False
    assert Config.from_dict({"validation": {}}).allow_missing is True
