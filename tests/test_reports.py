"""Metrics, scoring, drift, profile and output checks on hand-size tables."""

import re

import pytest
from pyspark.sql import functions as F

from rankwatch.operators import drift as dr
from rankwatch.operators import metrics as mt
from rankwatch.operators import profile as pf
from rankwatch.operators import scoring as sc
from rankwatch.operators import verify as vf

P = sc.PROBABILITY


@pytest.fixture()
def five(spark):
    data = [(1, 0.9, 1, 5), (2, 0.8, 0, 1), (3, 0.8, 1, 0), (4, 0.3, 0, 3), (5, 0.2, 1, 2)]
    return spark.createDataFrame(
        data, f"customer_id long, {P} double, churn int, support_tickets int"
    )


def fired(findings):
    return {r["code"] for r in findings.where("fired").collect()}


def test_rule(frame, cfg):
    df = frame(4)
    pred = [r[0] for r in df.selectExpr("customer_id", f"{mt.rule_prediction(df, cfg)} AS p").orderBy("customer_id").select("p").collect()]
    assert pred == [0, 1, 1, 0]
    row = mt.evaluate_rule(df, cfg, strict=True).first()
    assert (row["true_positives"], row["true_negatives"], row["false_positives"], row["false_negatives"]) == (2, 2, 0, 0)
    assert (row["threshold"], row["precision"], row["recall"], row["positive_predictions"]) == (3.0, 1.0, 1.0, 2)
    with pytest.raises(mt.RuleError):
        mt.evaluate_rule(df.withColumn("support_tickets", F.lit("x")), cfg, strict=True)
    with pytest.raises(KeyError):
        mt.check_rule(df.drop("support_tickets"), cfg)


def test_hand_metrics(five, cfg):
    row = mt.model_metrics(five, cfg, P).first()
    assert (row["true_positives"], row["false_positives"], row["true_negatives"], row["false_negatives"]) == (2, 1, 1, 1)
    assert row["f1_score"] == pytest.approx(2 / 3)
    assert row["brier_score"] == pytest.approx(0.284)
    assert mt.brier(five, cfg, P).first()[0] == pytest.approx(0.284)
    assert mt.average_precision(five, cfg, P).first()[0] == pytest.approx(0.7555555555)


def test_metrics_of_nothing(five, cfg):
    none = five.limit(0)
    row = mt.model_metrics(none, cfg, P).first()
    assert (row["rows"], row["accuracy"], row["recall"], row["brier_score"]) == (0, 0.0, 0.0, 0.0)
    assert mt.average_precision(none, cfg, P).first()[0] == 0.0
    assert mt.average_precision(five.withColumn("churn", F.lit(0)), cfg, P).first()[0] == 0.0


def test_average_precision_by_brute_force(spark, cfg):
    df = spark.range(2000).selectExpr(
        f"round(rand(3), 2) AS {P}", "CAST(rand(4) < 0.3 AS INT) AS churn"
    ).cache()
    data = [tuple(r) for r in df.collect()]
    total, area, n, tp = sum(y for _, y in data), 0.0, 0, 0
    for s in sorted({p for p, _ in data}, reverse=True):
        group = [y for p, y in data if p == s]
        n, tp = n + len(group), tp + sum(group)
        area += sum(group) / total * tp / n
    assert mt.average_precision(df, cfg, P, slices=16).first()[0] == pytest.approx(area)


def test_slices_add_up(frame, cfg):
    df = frame(12).withColumn(P, F.col("support_tickets") / 5).withColumn(
        "city", F.expr("CASE WHEN customer_id > 10001 THEN city END")
    )
    rows = mt.slice_metrics(df, cfg, P).collect()
    for name in (*cfg.categorical, "age_band", "support_ticket_band"):
        assert sum(r["row_count"] for r in rows if r["slice_name"] == name) == 12
    assert {r["slice_value"] for r in rows if r["slice_name"] == "city"} == {"UNKNOWN", "Multan", "Quetta"}
    assert {r["slice_value"] for r in rows if r["slice_name"] == "age_band"} == {"18-24", "35-44", "45-54"}
    no_city = mt.slice_metrics(df.drop("city"), cfg, P)
    assert no_city.where("slice_name = 'city'").count() == 0


def test_evaluation_findings(frame, cfg):
    df = frame(12).withColumn(P, F.lit(0.9))
    got = fired(mt.evaluation_findings(mt.metric_comparison(df, cfg, P), mt.slice_metrics(df, cfg, P)))
    assert got == {"recall_not_above_rule", "flags_over_half", "recall_not_improved", "precision_fell"}
    none = df.limit(0)
    got = fired(mt.evaluation_findings(mt.metric_comparison(none, cfg, P), mt.slice_metrics(none, cfg, P)))
    assert {"empty_test", "no_slices"} <= got


def test_missing_probability_ranks_last(spark, cfg):
    df = spark.createDataFrame([(1, 0.2), (2, float("nan")), (3, 0.8)], f"customer_id long, {P} double")
    rows = sc.review_queue(df, cfg, top_k=1).orderBy("review_rank").collect()
    assert [r["customer_id"] for r in rows] == [3, 1, 2]
    assert [(r["risk_band"], r["predicted_label"]) for r in rows] == [("high", 1), ("low", 0), ("low", 0)]
    assert [r["review_queue_flag"] for r in rows] == [True, False, False]
    assert [r["review_priority"] for r in rows] == ["review", "monitor", "monitor"]
    assert [r["customer_id"] for r in sc.top_of_queue(df, cfg, 2).collect()] == [3, 1]
    assert fired(sc.scoring_findings(sc.batch_summary(df, cfg))) == {
        "missing_probabilities", "queue_below_capacity",
    }


def test_batch_summary(five, cfg):
    row = sc.batch_summary(five, cfg, 3).first()
    assert (row["row_count"], row["review_queue_size"], row["positive_predictions"]) == (5, 3, 3)
    assert (row["high_count"], row["medium_count"], row["low_count"]) == (3, 0, 2)
    assert (row["max_probability"], row["mean_probability"]) == (0.9, pytest.approx(0.6))
    empty = sc.batch_summary(five.limit(0), cfg, 0)
    assert empty.first()["mean_probability"] == 0.0
    assert fired(sc.scoring_findings(empty)) == {
        "empty_batch", "top_k_not_positive", "scores_nearly_constant", "queue_at_capacity",
    }
    flat = five.withColumn(P, F.lit(0.5))
    assert "scores_nearly_constant" in fired(sc.scoring_findings(sc.batch_summary(flat, cfg)))


def test_drift(spark, frame, cfg):
    ref, cur = frame(8), frame(8).withColumns(
        {
            "city": F.lit("Nowhere"),
            "monthly_bill": F.lit(None).cast("double"),
            "support_tickets": F.col("support_tickets") + 1,
        }
    ).drop("call_minutes")
    num = {r["feature"]: r for r in dr.numeric_drift(cur, dr.reference_numeric(ref, cfg), cfg).collect()}
    assert set(num) == {"monthly_bill", "internet_usage_gb", "support_tickets"}
    assert num["monthly_bill"]["mean_shift"] is None
    assert (num["monthly_bill"]["missing_rate_shift"], num["monthly_bill"]["status"]) == (1.0, "significant")
    assert (num["support_tickets"]["mean_shift"], num["internet_usage_gb"]["status"]) == (1.0, "stable")
    cat = {r["feature"]: r for r in dr.categorical_drift(cur, dr.reference_categorical(ref, cfg), cfg).collect()}
    assert (cat["city"]["mean_shift"], cat["contract_type"]["mean_shift"]) == (1.0, 0.0)
    gaps = cur.withColumn("city", F.lit(None).cast("string"))
    row = dr.categorical_drift(gaps, dr.reference_categorical(ref, cfg), cfg).where("feature = 'city'").first()
    assert (row["current_missing_rate"], row["true_missing_rate"], row["mean_shift"]) == (0.0, 1.0, 1.0)


def scans(df):
    """File scans of the plan that ran; a reused shuffle is no scan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan")


def test_tagged_drift_is_that_of_two_tables(spark, frame, cfg, tmp_path):
    late = "city = 'Quetta' OR monthly_income > 45000"
    cur = frame(12).withColumns({
        "city": F.when(F.expr("age = 48"), None).otherwise(F.col("city")),
        "monthly_bill": F.when(F.expr("support_tickets = 3"), None).otherwise(F.col("monthly_bill")),
    })
    cur.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def rows(found):
        return sorted((r[0], r[1], *(x if x is None else round(x, 9) for x in r[2:4]), r[4]) for r in found.collect())

    for is_ref in ("NOT (city <=> 'Quetta' OR monthly_income > 45000)", "true", "false", "CAST(NULL AS BOOLEAN)"):
        ref = df.where(F.expr(is_ref))
        new = df.where(~F.expr(f"coalesce({is_ref}, false)"))
        want = dr.drift_status_rows(
            dr.numeric_drift(new, dr.reference_numeric(ref, cfg), cfg),
            dr.categorical_drift(new, dr.reference_categorical(ref, cfg), cfg),
        )
        got = dr.tagged_drift(df, is_ref, cfg)
        assert rows(got) == rows(want) and got.columns == want.columns, is_ref
    assert scans(dr.tagged_drift(df, f"NOT ({late})", cfg)) == 2
    one = cfg.with_(monitor_categorical=())
    assert {r["kind"] for r in dr.tagged_drift(df, "true", one).collect()} == {"numeric"}


def test_drift_without_reference(spark, frame, cfg):
    ref = dr.reference_numeric(frame(4), cfg.with_(monitor_numeric=("monthly_bill",)))
    rows = {r["feature"]: r for r in dr.numeric_drift(frame(4), ref, cfg).collect()}
    assert (rows["call_minutes"]["reference_mean"], rows["call_minutes"]["status"]) == (None, "unknown")
    empty = dr.numeric_drift(frame(4).limit(0), ref, cfg).where("feature = 'monthly_bill'").first()
    assert (empty["current_mean"], empty["status"]) == (None, "unknown")


def test_prediction_drift(five, cfg, frame):
    meta = {"validation_positive_rate": 0.35, "validation_rows": 5}
    pred = dr.prediction_drift(sc.batch_summary(five, cfg, 0), meta)
    row = pred.first()
    assert (row["mean_shift"], row["review_queue_shift"]) == (pytest.approx(0.25), -2)
    same = dr.drift_status_rows(
        dr.numeric_drift(frame(4), dr.reference_numeric(frame(4), cfg), cfg),
        dr.categorical_drift(frame(4), dr.reference_categorical(frame(4), cfg), cfg),
    )
    assert fired(dr.drift_findings(same, pred)) == {
        "prediction_mean_shifted", "empty_queue", "compare_recent_batches",
    }


def test_profile(frame, cfg):
    df = frame(4).withColumn("monthly_income", F.col("monthly_income") - 30000)
    out = pf.profile(df, cfg)
    assert tuple(out["overview"].first()) == (4, 15, 0.5)
    assert {tuple(r) for r in out["target"].collect()} == {("0", 2), ("1", 2)}
    assert out["rule"].first()["positive_predictions"] == 2
    tickets = out["numeric"].where("feature = 'support_tickets'").first()
    assert (tickets["min"], tickets["max"], tickets["median"], tickets["std"]) == (0, 4, 2.0, pytest.approx(1.5811388))
    assert tuple(out["date"].first()) == ("signup_date", True, *[r for r in out["date"].first()[2:4]], 3)
    assert out["text"].first()["unique_ratio"] == 1.0
    assert {(r["code"], r["column"]) for r in out["findings"].where("fired").collect()} == {
        ("id_unique", "customer_id"), ("date_parseable", "signup_date"),
        ("text_unique", "customer_feedback"), ("negative_values", "monthly_income"),
        *[("high_cardinality", c) for c in cfg.categorical],
    }


def test_profile_of_gaps(spark, cfg):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",), ("b",), ("c",)], "city string")
    small = cfg.with_(categorical=("city",), numeric=("age",))
    top = pf.categorical_top(df, small).orderBy("position").collect()
    assert [(r["value"], r["n"]) for r in top] == [("b", 2), (None, 2), ("a", 1)]
    assert tuple(pf.categorical_profile(df, small).first()) == ("city", 3, 0.5)
    dates = df.selectExpr("city AS signup_date")
    assert tuple(pf.date_profile(dates, small).first())[1:] == (False, None, None, None)
    ages = pf.numeric_profile(df.selectExpr("CAST(NULL AS INT) AS age"), small).first()
    assert tuple(ages) == ("age", 6, None, None, None, None, None)


@pytest.fixture()
def queue(spark, cfg):
    df = spark.range(50).selectExpr("id AS customer_id", f"round(rand(5), 1) AS {P}")
    return sc.review_queue(df, cfg, 10).cache()


def failed(checks):
    return {r["check"] for r in checks.where("NOT passed").collect()}


def test_good_queue(queue, cfg):
    checks = vf.verify_scored(queue, cfg, 10)
    assert failed(checks) == set() and checks.count() == 10
    row = vf.scored_details(queue).first()
    assert (row["row_count"], row["queue_size"]) == (50, 10)
    assert failed(vf.verify_scored(queue, cfg, 99)) == {"queue_size"}


@pytest.mark.parametrize("block", [1, 4, 1 << 20])
def test_order_check_over_blocks(queue, block):
    assert vf.rank_order(queue, block).first()["rises"] == 0
    p = F.when(F.col("review_rank") == 20, 2.0).otherwise(F.col(P))
    assert vf.rank_order(queue.withColumn(P, p), block).first()["rises"] == 1


def test_order_check_of_odd_ranks(spark):
    """Any ranks at all, against a plain walk over them."""
    far = 2**53 - 1  # ranks are read as doubles
    ranks = [None, None, -far, -5, 0, 1, 1, 7, 4_194_303, 4_194_304, 2**42 - 1, 2**42, far - 1, far]
    rows = [(r, None if i == 6 else (i * 7 % 5) / 5) for i, r in enumerate(ranks)]
    df = spark.createDataFrame(rows, f"review_rank long, {P} double")
    of = {r: [p for q, p in rows if q == r and p is not None] for r in ranks if r is not None}
    steps = [of[r] for r in sorted(of)]
    rises = sum(1 for a, b in zip(steps, steps[1:]) if a and b and max(b) > min(a))
    for block in (1, 2, 1 << 21):
        row = vf.rank_facts(df, block).first()
        assert (row["rises"], row["first_r"], row["last_r"]) == (rises, -far, far)
        assert (row["distinct_r"], row["n"]) == (len(of), len(rows))
    empty = vf.rank_facts(df.limit(0)).first()
    assert (empty["rises"], empty["n"], empty["first_r"]) == (0, 0, None)


def test_one_shuffle_by_rank(queue, cfg):
    """Rows are grouped by rank once, for the sequence and for the order."""
    checks = vf.verify_scored(queue, cfg, 10)
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(r#", plan)) == 1


def test_broken_queues(queue, cfg):
    def broken(**changes):
        return failed(vf.verify_scored(queue.withColumns({k: F.expr(e) for k, e in changes.items()}), cfg, 10))

    assert broken(review_rank="review_rank + 1") >= {"contiguous_ranks"}
    assert "contiguous_ranks" in broken(review_rank="CASE WHEN review_rank = 9 THEN 8 ELSE review_rank END")
    assert broken(review_rank="51 - review_rank") >= {"sorted_by_probability", "flags_are_top_ranks"}
    assert broken(risk_band="'odd'") == {"known_bands"}
    assert broken(review_priority="'review'") == {"priority_matches_flag"}
    assert broken(review_queue_flag="review_rank <= 9") == {"queue_size", "priority_matches_flag"}
    assert "flags_are_top_ranks" in broken(review_queue_flag="review_rank BETWEEN 2 AND 11")
    assert broken(churn_probability="churn_probability + 1") == {"probabilities_in_range"}
    assert "numeric_probabilities" in broken(churn_probability="CAST(NULL AS DOUBLE)")
    assert failed(vf.verify_scored(queue.limit(0), cfg)) == {"not_empty"}
    assert failed(vf.verify_scored(queue.select("customer_id", P), cfg)) == {"required_columns"}


def test_report_checks(spark, five, cfg):
    table = vf.report({"model_metrics": mt.model_metrics(five, cfg, P)})
    checks = vf.verify_report(table, "r", ("model_metrics", "missing"), spark)
    assert {(r["check"], r["detail"]) for r in checks.where("NOT passed").collect()} == {
        ("required_section", "missing")
    }
    assert failed(vf.verify_report(None, "r", (), spark)) == {"exists"}
    assert failed(vf.verify_bundle(spark, None, "gone")) == {"loads"}
