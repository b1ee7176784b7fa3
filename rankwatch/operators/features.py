"""Derived model features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions import features as fx
from rankwatch.functions.rows import aggregate, finding, to_rows
from rankwatch.functions.values import day, num, quoted


class FeatureError(ValueError):
    """Dates or ticket counts that no feature can be derived from."""


_REFERENCE = "_reference_day"


def batch_reference_day(df: DataFrame, cfg: Config) -> Column:
    """Midnight of the latest valid date of the batch, as a scalar subquery."""
    latest = day(df.schema, cfg.date_column, cfg.date_format)
    return df.agg(F.expr(f"to_date(max({latest}))")).scalar()


def _with_reference(
    df: DataFrame, cfg: Config, reference_date: str | dt.date | None
) -> DataFrame:
    if reference_date is None:
        return df.withColumn(_REFERENCE, batch_reference_day(df, cfg))
    return df.withColumn(_REFERENCE, F.lit(str(reference_date)[:10]).cast("date"))


def _require(df: DataFrame, *columns: str) -> None:
    for c in columns:
        if c not in df.columns:
            raise KeyError(f"missing required column: {c}")


def tenure_days(
    df: DataFrame, cfg: Config, reference_date: str | dt.date | None = None
) -> DataFrame:
    """Append whole days from the date column to the reference day."""
    _require(df, cfg.date_column)
    return (
        _with_reference(df, cfg, reference_date)
        .withColumn(cfg.tenure_column, F.expr(fx.tenure(df.schema, cfg, _REFERENCE)))
        .drop(_REFERENCE)
    )


def ticket_flag(df: DataFrame, cfg: Config) -> DataFrame:
    _require(df, cfg.ticket_column)
    return df.withColumn(cfg.ticket_flag_column, F.expr(fx.ticket_flag(df.schema, cfg)))


def text_features(df: DataFrame, cfg: Config) -> DataFrame:
    """Append length in characters and one flag per keyword, over the whole text."""
    _require(df, cfg.text_column)
    return df.withColumns({c: F.expr(e) for c, e in fx.text_features(cfg).items()})


def add_features(
    df: DataFrame,
    cfg: Config,
    reference_date: str | dt.date | None = None,
    strict: bool = False,
) -> DataFrame:
    """Append all derived columns; `strict` first raises on inputs that have no value."""
    _require(df, cfg.date_column, cfg.ticket_column, cfg.text_column)
    if strict:
        check_features(df, cfg, reference_date)
    exprs = fx.derived(df.schema, cfg, _REFERENCE)
    return (
        _with_reference(df, cfg, reference_date)
        .withColumns({c: F.expr(e) for c, e in exprs.items()})
        .drop(_REFERENCE)
    )


def feature_findings(
    df: DataFrame, cfg: Config, reference_date: str | dt.date | None = None
) -> DataFrame:
    """Invalid dates, dates after the reference day, non-numeric ticket counts (one scan)."""
    d, t, scope = cfg.date_column, cfg.ticket_column, "features"
    value = day(df.schema, d, cfg.date_format)
    one = aggregate(
        df,
        {
            "rows": "count(*)",
            "bad_dates": f"count_if(({value}) IS NULL)",
            "latest": f"max({value})",
            "bad_tickets": f"count_if(({num(df.schema, t)}) IS NULL)",
        },
    )
    # Negative tenure can only come from values later than the reference midnight.
    limit = "to_date(latest)" if reference_date is None else f"DATE '{str(reference_date)[:10]}'"
    none_valid = "rows > 0 AND latest IS NULL"
    return to_rows(
        one,
        [
            finding(scope, "invalid_date", "bad_dates > 0", "bad_dates", 0, d),
            finding(scope, "no_valid_date", none_valid, column=d),
            finding(scope, "negative_tenure", f"latest > {limit}", column=d),
            finding(scope, "invalid_tickets", "bad_tickets > 0", "bad_tickets", 0, t),
        ],
    )


def _invalid(df: DataFrame, column: str, parsed: str) -> DataFrame:
    return (
        df.where(f"({parsed}) IS NULL")
        .groupBy(F.expr(f"CAST({quoted(column)} AS STRING) AS value"))
        .count()
    )


def invalid_dates(df: DataFrame, cfg: Config) -> DataFrame:
    """Distinct date values that do not parse, with counts."""
    return _invalid(df, cfg.date_column, day(df.schema, cfg.date_column, cfg.date_format))


def invalid_tickets(df: DataFrame, cfg: Config) -> DataFrame:
    """Distinct ticket values that are not numbers, with counts."""
    return _invalid(df, cfg.ticket_column, num(df.schema, cfg.ticket_column))


def check_features(
    df: DataFrame, cfg: Config, reference_date: str | dt.date | None = None
) -> None:
    """Raise on inputs without a value; one small job when all is well.

    The error counts them and carries a table of every distinct offending value."""
    fired = feature_findings(df, cfg, reference_date).where("fired").collect()
    if not fired:
        return
    listed = {"invalid_date": invalid_dates, "invalid_tickets": invalid_tickets}
    parts = [
        f"{r['code']}({r['column']})" + (f": {r['value']:g} rows" if r["code"] in listed else "")
        for r in fired
    ]
    error = FeatureError("; ".join(parts))
    error.values = {r["code"]: listed[r["code"]](df, cfg) for r in fired if r["code"] in listed}
    raise error

