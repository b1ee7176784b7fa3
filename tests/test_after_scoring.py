"""Measures after scoring: history of batches, promotion gate, reviews, deciles, extra features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankwatch.operators import extended as ext
from rankwatch.operators import gate as gt
from rankwatch.operators import history as hs
from rankwatch.operators import review as rv


def scores(spark, batches):
    rows = [(b, p) for b, ps in batches.items() for p in ps]
    return spark.createDataFrame(rows, "batch string, p double")


def codes(findings):
    return {r["code"] for r in findings.where("fired").collect()}


def test_sketches_add_up_and_survive_a_history(spark, tmp_path):
    even = [i / 1000 for i in range(1000)]
    df = scores(spark, {"1": even, "2": even[:500], "3": [0.7] * 50, "4": [None, float("nan"), 1.7, -2.0]})
    sketch = hs.score_sketch(df, "batch", "p")
    path = f"{tmp_path}/history"
    assert hs.read_history(spark, path) is None
    for b in "1234":
        hs.append_history(sketch.where(F.col("batch") == b), path)
    hs.append_history(sketch.where("batch = '2'"), path)  # again: replaced, not doubled
    back = hs.read_history(spark, path)
    assert sorted(map(tuple, back.select(sketch.columns).collect())) == sorted(map(tuple, sketch.collect()))
    both = hs.merged(back.where("batch IN ('1', '2')"), "12")
    assert both.agg(F.sum("rows")).first()[0] == 1500 and both.count() == 1000
    assert {r["batch"] for r in hs.latest_before(back, "3").collect()} == {"2"}
    spread = {r["batch"]: r for r in hs.batch_spread(back).collect()}
    assert spread["3"]["collapsed"] and not spread["1"]["collapsed"] and spread["4"]["rows"] == 2
    assert spread["1"]["mean_score"] == pytest.approx(sum(even) / 1000)


def test_shift_is_measured_in_the_tenths_of_the_previous_batch(spark):
    even = [i / 1000 for i in range(1000)]
    df = scores(spark, {"1": even, "2": even, "3": even[500:], "4": [0.35] * 10})
    sketch = hs.score_sketch(df, "batch", "p")
    of = lambda b: sketch.where(F.col("batch") == b)
    same = hs.score_shift(of("1"), of("2")).collect()
    assert len(same) == 10 and all(r["previous_share"] == r["current_share"] == pytest.approx(0.1) for r in same)
    assert codes(hs.shift_findings(of("1"), of("2"))) == set()
    assert codes(hs.shift_findings(of("1"), of("3"))) == {"score_distribution_shifted"}
    assert codes(hs.shift_findings(of("1"), of("4"))) == {"score_distribution_shifted", "scores_collapsed", "one_bin_holds_most"}
    none = of("9")
    assert "no_scores" in codes(hs.shift_findings(of("1"), none)) and hs.score_shift(none, of("1")).count() == 0


def judged(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, churn int, city string, a double, b double")


def test_gate_compares_the_same_rows(spark, cfg):
    rows = [(i, i % 2, "X" if i % 4 < 2 else "Y", 0.9 if i % 2 else 0.1, 0.9 if i % 2 else 0.1) for i in range(200)]
    assert gt.may_promote(gt.promotion_gate(judged(spark, rows), cfg, "a", "b"))
    # The candidate misses all of city Y.
    worse = [(i, y, c, a, 0.2 if c == "Y" else b) for i, y, c, a, b in rows]
    found = gt.promotion_gate(judged(spark, worse), cfg, "a", "b")
    assert codes(found) >= {"recall_lost", "slice_recall_lost", "brier_grew"} and not gt.may_promote(found)
    lost = {r["column"]: r["value"] for r in found.where("code = 'slice_recall_lost'").collect()}
    assert lost == {"city=X": 0.0, "city=Y": 1.0}
    assert gt.may_promote(gt.promotion_gate(judged(spark, worse), cfg, "b", "a", gt.Bounds(changed=1.0)))
    # Rows without a score of one of them take no part; few rows make no slice.
    holes = [(i, y, c, a if i % 3 else None, b if i % 5 else float("nan")) for i, y, c, a, b in rows]
    one = gt.paired_metrics(judged(spark, holes), cfg, "a", "b").first()
    assert one["rows"] == sum(1 for i in range(200) if i % 3 and i % 5) and one["champion_recall"] == 1
    assert codes(gt.promotion_gate(judged(spark, rows[:0]), cfg, "a", "b")) == {"nothing_to_compare"}


def test_next_event_of_every_entry(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    queue = spark.createDataFrame(
        [("d1", 1, t(0)), ("d1", 2, t(0)), ("d1", 3, t(0)), ("d2", 1, t(10)), ("d2", None, t(0)), ("d1", 1, t(0)), ("d2", 4, None)],
        "day string, id long, at timestamp",
    )
    events = spark.createDataFrame(
        [(1, t(-1), "call"), (1, t(5), "other"), (1, t(7), "call"), (1, t(7), "drop"), (2, t(0), "drop"), (3, t(49), "call"),
         (1, t(12), "drop"), (None, t(1), "call"), (1, None, "call")] + [(1, t(20 + i), "call") for i in range(200)],
        "id long, when timestamp, kind string",
    )
    found = rv.next_events(queue, events, {"call": rv.CONTACTED, "drop": rv.OVERRIDDEN}, "2 DAYS", "id", "at", "day", "when", "kind")
    got = {(r["batch"], r["id"]): (r["outcome"], r["hours"]) for r in found.collect()}
    assert got == {("d1", 1): ("contacted", 7.0), ("d1", 2): ("overridden", 0.0), ("d1", 3): (None, None),
                   ("d2", 1): ("overridden", 2.0), ("d2", None): (None, None), ("d2", 4): (None, None)}
    by = {r["batch"]: r for r in rv.review_metrics(found).collect()}
    assert (by["d1"]["queued"], by["d1"]["reviewed"], by["d1"]["mean_hours"]) == (3, 2, 3.5)
    assert (by["d2"]["reviewed_rate"], by["d2"]["overridden_rate"]) == (pytest.approx(1 / 3), 1.0)


def test_deciles_hold_equal_rows_and_ties_stay_together(spark, cfg):
    df = spark.createDataFrame([(i / 100, i % 2) for i in range(100)] + [(None, 1), (0.5, None)], "p double, churn int")
    got = {r["decile"]: r for r in ext.calibration_deciles(df, cfg, "p").collect()}
    assert {d: r["rows"] for d, r in got.items()} == {d: 10 for d in range(10)}
    assert (got[3]["lowest"], got[3]["highest"]) == (0.30, 0.39)
    tied = spark.createDataFrame([(0.2, 1)] * 70 + [(0.9, 0)] * 30, "p double, churn int")
    assert {r["decile"]: r["rows"] for r in ext.calibration_deciles(tied, cfg, "p").collect()} == {0: 70, 7: 30}
    assert ext.calibration_deciles(tied.limit(0), cfg, "p").collect() == []


def test_calendar_and_keyword_rates(spark, cfg):
    df = spark.createDataFrame([("2024-03-05", "POOR line", "a"), ("nope", None, "a"), (None, "an Issue, poor", None)],
                               "signup_date string, customer_feedback string, city string")
    got = ext.calendar_features(df, cfg).select("signup_month", "signup_year").collect()
    assert [tuple(r) for r in got] == [(3, 2024), (None, None), (None, None)]
    rates = {(r["group"], r["word"]): r["rate"] for r in ext.keyword_rates(df, cfg, ["poor", "issue"], "city").collect()}
    assert rates == {("a", "poor"): 0.5, ("a", "issue"): 0.0, (None, "poor"): 1.0, (None, "issue"): 1.0}
