import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankwatch.operators import features as ft


@pytest.fixture()
def three(spark, frame):
    days = {10000: "2024-01-01", 10001: "2024-01-02", 10002: "2024-01-05"}
    texts = {10000: "Coverage is acceptable", 10001: "Billing issues keep happening",
             10002: "Support response was slow"}
    m = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])[F.col("customer_id")]
    return frame(3).withColumns(
        {"signup_date": m(days).cast("date"), "customer_feedback": m(texts)}
    )


def values(df, *cols):
    return [list(c) for c in zip(*[tuple(r) for r in df.orderBy("customer_id").select(*cols).collect()])]


def test_all_features(three, cfg):
    out = ft.add_features(three, cfg, "2024-01-10", strict=True)
    assert out.columns == three.columns + list(cfg.derived)
    assert values(out, *cfg.derived) == [
        [9, 8, 5], [0, 1, 1], [22, 29, 25], [0, 1, 0], [1, 0, 0], [0, 0, 1],
    ]


def test_reference_defaults_to_latest(three, cfg):
    assert values(ft.tenure_days(three, cfg), cfg.tenure_column) == [[4, 3, 0]]


def test_text_dates(three, cfg):
    text = three.withColumn("signup_date", F.col("signup_date").cast("string"))
    assert values(ft.tenure_days(text, cfg, "2024-01-10"), cfg.tenure_column) == [[9, 8, 5]]


def test_missing_text_counts_as_empty(three, cfg):
    out = ft.text_features(three.withColumn("customer_feedback", F.lit(None).cast("string")), cfg)
    assert values(out, cfg.length_column, *cfg.keyword_columns) == [[0] * 3] * 4


def test_length_counts_characters(spark, cfg):
    df = spark.createDataFrame([(1, "žluť 😀")], "customer_id int, customer_feedback string")
    assert ft.text_features(df, cfg).first()[cfg.length_column] == 6


def test_errors_name_the_values(three, cfg):
    bad = three.withColumn(
        "signup_date", F.expr("CASE customer_id WHEN 10001 THEN 'soon' ELSE '2024-01-01' END")
    )
    with pytest.raises(ft.FeatureError, match="invalid_date.*1 rows"):
        ft.add_features(bad, cfg, strict=True)
    with pytest.raises(ft.FeatureError, match="negative_tenure"):
        ft.check_features(three, cfg, dt.date(2024, 1, 3))
    tickets = three.withColumn("support_tickets", F.lit("many"))
    with pytest.raises(ft.FeatureError, match="invalid_tickets.* rows") as caught:
        ft.check_features(tickets, cfg)
    assert [r["value"] for r in caught.value.values["invalid_tickets"].collect()] == ["many"]
    with pytest.raises(KeyError):
        ft.add_features(three.drop("signup_date"), cfg)
