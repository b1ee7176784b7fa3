import datetime as dt

import pytest

from rankwatch.functions import values as v
from rankwatch.functions.features import tenure


def column(spark, data, kind, expr_of):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(data)], f"i int, x {kind}")
    return [r["y"] for r in df.selectExpr("i", f"{expr_of(df)} AS y").orderBy("i").collect()]


def test_numbers_from_text(spark):
    data = ["1", " 2 ", "1e3", "-.5", "Infinity", "1d", "1f", "0x10", "1_0", "True", "", None, "x"]
    got = column(spark, data, "string", lambda df: v.num(df.schema, "x"))
    assert got == [1.0, 2.0, 1000.0, -0.5, float("inf")] + [None] * 8


def test_nan_is_missing(spark):
    got = column(spark, [1.0, float("nan"), None], "double", lambda df: v.missing(df.schema, "x"))
    assert got == [False, True, True]
    got = column(spark, [1.0, float("nan"), None], "double", lambda df: v.num(df.schema, "x"))
    assert got == [1.0, None, None]


def test_null_tokens(spark):
    data = ["NA", "null", "None", "n/a", "nan", "", "-", "ok", " "]
    got = column(spark, data, "string", lambda df: v.tokens_to_null("x").removesuffix(" AS `x`"))
    assert got == [None] * 6 + ["-", "ok", " "]


def test_dates_from_text(spark):
    data = ["2024-01-05", "2024", "2024-1-5", "2024-13-01", "2024-01-05 10:00", "x", None]
    got = column(spark, data, "string", lambda df: v.day(df.schema, "x", "yyyy-MM-dd"))
    assert got == [dt.date(2024, 1, 5)] + [None] * 6


def test_age_bands(spark):
    data = [-1.0, 0.0, 17.0, 24.0, 24.5, 34.0, 35.0, 54.0, 55.0, 120.0, 121.0, None]
    assert column(spark, data, "double", lambda df: v.age_band("x")) == [
        "UNKNOWN", "18-24", "18-24", "18-24", "25-34", "25-34", "35-44", "45-54", "55+", "55+",
        "UNKNOWN", "UNKNOWN",
    ]


def test_ticket_bands(spark):
    data = [-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0, 3.0, 100.0, 101.0, None]
    assert column(spark, data, "double", lambda df: v.ticket_band("x")) == [
        "UNKNOWN", "0", "0", "0", "1", "1", "2", "3+", "3+", "UNKNOWN", "UNKNOWN",
    ]


def test_risk_band_of_missing_is_low(spark):
    data = [0.75, 0.5, 0.49, float("nan"), None]
    got = column(spark, data, "double", lambda df: v.risk_band("x", 0.75, 0.5))
    assert got == ["high", "medium", "low", "low", "low"]


@pytest.mark.parametrize(
    ("shift", "miss", "status"),
    [
        (None, None, "unknown"),
        (0.5, 0.1, "moderate"),
        (-0.51, None, "significant"),
        (None, 0.11, "significant"),
        (0.2, 0.05, "stable"),
        (0.0, -0.06, "moderate"),
    ],
)
def test_drift_status(spark, shift, miss, status):
    expr = v.drift_status(v.double(shift), v.double(miss))
    assert spark.range(1).selectExpr(f"{expr} AS s").first()["s"] == status


def test_ratio_of_nothing_is_zero(spark):
    row = spark.range(1).selectExpr(f"{v.ratio('1', '0')} AS a", f"{v.ratio('1', 'NULL')} AS b")
    assert tuple(row.first()) == (0.0, 0.0)


def test_days_round_down(spark, cfg):
    stamps = [dt.datetime(2024, 1, 9, 23), dt.datetime(2024, 1, 10, 1), dt.datetime(2024, 1, 10)]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame([(x,) for x in stamps], f"signup_date {kind}")
        got = df.selectExpr(f"{tenure(df.schema, cfg, 'DATE_LIT')} AS d".replace(
            "DATE_LIT", "DATE '2024-01-10'"))
        assert [r["d"] for r in got.collect()] == [0, -1, 0]


def test_text_literals_are_escaped(spark):
    odd = "it's a \\ 'test'"
    assert spark.range(1).selectExpr(f"{v.text(odd)} AS s").first()["s"] == odd
