"""Stored training profile and its comparison with a later batch."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, finding, to_rows, unpivot
from rankwatch.functions.values import double as dbl
from rankwatch.functions.values import drift_status, filled, missing, num, ratio, text
from rankwatch.operators.quality import category_counts

PREDICTION_SHIFT = 0.15  # fixed value: limit of the mean probability shift


def batch_facts(df: DataFrame, cfg: Config) -> DataFrame:
    """One row: row count, mean and gaps of the monitored numeric columns, gaps of the monitored
    categorical ones. Staged, it serves numeric and categorical drift with one scan."""
    aggs = {"rows": "count(*)"}
    for i, c in _present(df, cfg.monitor_numeric):
        v = num(df.schema, c)
        aggs |= {f"mean{i}": f"avg({v})", f"miss{i}": f"count_if(({v}) IS NULL)"}
    for i, c in _present(df, cfg.monitor_categorical):
        aggs[f"gap{i}"] = f"count_if({missing(df.schema, c)})"
    return aggregate(df, aggs)


def _present(df: DataFrame, columns: Iterable[str]) -> list[tuple[int, str]]:
    return list(enumerate(c for c in columns if c in df.columns))


def _numeric_profile(df: DataFrame, cfg: Config, facts: DataFrame | None = None) -> DataFrame:
    """(feature, mean, missing_rate): one scan, one aggregate row turned into rows."""
    rows = [
        {"feature": text(c), "mean": f"mean{i}", "missing_rate": f"try_divide(miss{i}, rows)"}
        for i, c in _present(df, cfg.monitor_numeric)
    ]
    fields = (("feature", "string"), ("mean", "double"), ("missing_rate", "double"))
    return to_rows(facts or batch_facts(df, cfg), rows, fields)


def reference_numeric(df: DataFrame, cfg: Config) -> DataFrame:
    """(feature, mean, missing_rate) of the monitored numeric columns the table has."""
    return _numeric_profile(df, cfg).selectExpr(
        "feature", "coalesce(mean, 0D) AS mean", "coalesce(missing_rate, 0D) AS missing_rate"
    )


def reference_categorical(df: DataFrame, cfg: Config) -> DataFrame:
    """(feature, value, share) of the monitored categorical columns the table has.

    Totals come from the grouped counts, one row per feature, and not from a window that
    would bring all values of a feature together.
    """
    counts = category_counts(df, list(cfg.monitor_categorical))
    totals = counts.groupBy("feature").agg(F.expr("sum(n) AS total"))
    return counts.join(F.broadcast(totals), "feature").selectExpr(
        "feature", "value", f"{ratio('n', 'total')} AS share"
    )


def numeric_drift(
    batch: DataFrame, ref_numeric: DataFrame, cfg: Config, facts: DataFrame | None = None
) -> DataFrame:
    """Mean and missing-rate shift per feature. Both sides have one row per configured
    feature, so the reference is broadcast. `facts` are the batch's, if already computed."""
    ref = ref_numeric.selectExpr(
        "feature", "mean AS reference_mean", "missing_rate AS reference_missing_rate"
    )
    cur = _numeric_profile(batch, cfg, facts).selectExpr(
        "feature", "mean AS current_mean", "missing_rate AS current_missing_rate"
    )
    mean_shift = "(current_mean - reference_mean)"
    missing_shift = "(current_missing_rate - reference_missing_rate)"
    return cur.join(F.broadcast(ref), "feature", "left").selectExpr(
        "feature",
        "reference_mean",
        "current_mean",
        f"{mean_shift} AS mean_shift",
        "reference_missing_rate",
        "current_missing_rate",
        f"{missing_shift} AS missing_rate_shift",
        f"{drift_status(mean_shift, missing_shift)} AS status",
    )


def categorical_drift(
    batch: DataFrame, ref_categorical: DataFrame, cfg: Config, facts: DataFrame | None = None
) -> DataFrame:
    """Total variation distance per feature.

    Shares of both sides are added with opposite signs per (feature, value) and summed: a
    union and two grouped sums instead of a full outer join. Missing is a value of its own,
    so the missing rate is 0 by definition; `true_missing_rate` is the real one.
    """
    cols = [c for c in cfg.monitor_categorical if c in batch.columns]
    current = reference_categorical(batch, cfg.with_(monitor_categorical=tuple(cols)))
    reference = ref_categorical.where(F.col("feature").isin(*cols))
    distance = (
        current.unionByName(reference.withColumn("share", F.expr("-share")))
        .groupBy("feature", "value")
        .agg(F.expr("sum(share) AS d"))
        .groupBy("feature")
        .agg(F.expr("sum(abs(d)) / 2 AS mean_shift"))
    )
    rows = [
        {
            "feature": text(c),
            "current_missing_rate": "CASE WHEN rows > 0 THEN 0D END",
            "true_missing_rate": f"try_divide(gap{i}, rows)",
        }
        for i, c in enumerate(cols)
    ]
    fields = (
        ("feature", "string"),
        ("current_missing_rate", "double"),
        ("true_missing_rate", "double"),
    )
    shift = "coalesce(mean_shift, 0D)"
    present = to_rows(facts or batch_facts(batch, cfg), rows, fields)
    # One row per configured feature on either side.
    return present.join(F.broadcast(distance), "feature", "left").selectExpr(
        "feature",
        f"{shift} AS mean_shift",
        "current_missing_rate",
        "current_missing_rate AS missing_rate_shift",
        "true_missing_rate",
        f"{drift_status(shift, 'current_missing_rate')} AS status",
    )


def tagged_drift(df: DataFrame, reference: str, cfg: Config) -> DataFrame:
    """(kind, feature, shift, missing_rate_shift, status) between the rows of one table where the
    SQL condition `reference` holds and the others (also those where it is null).

    Equal to drift between the two as tables of their own, in two scans: one row of filtered
    aggregates, and one grouped count of values on both sides.
    """
    tag = f"coalesce({reference}, false)"
    sides = {"ref": tag, "cur": f"NOT {tag}"}
    aggs = {f"{s}_rows": f"count_if({is_})" for s, is_ in sides.items()}
    rows = []
    for i, c in _present(df, cfg.monitor_numeric):
        v = num(df.schema, c)
        for s, is_ in sides.items():
            aggs[f"{s}_mean{i}"] = f"avg({v}) FILTER (WHERE {is_})"
            aggs[f"{s}_miss{i}"] = f"count_if(({v}) IS NULL AND {is_})"
        mean = f"cur_mean{i} - coalesce(ref_mean{i}, 0D)"
        gaps = f"try_divide(cur_miss{i}, cur_rows) - coalesce(try_divide(ref_miss{i}, ref_rows), 0D)"
        rows.append({"kind": text("numeric"), "feature": text(c), "shift": mean, "missing_rate_shift": gaps})
    cols = [c for _, c in _present(df, cfg.monitor_categorical)]
    for c in cols:
        gaps = "CASE WHEN cur_rows > 0 THEN 0D END"
        rows.append({"kind": text("categorical"), "feature": text(c), "missing_rate_shift": gaps})
    fields = (
        ("kind", "string"), ("feature", "string"), ("shift", "double"), ("missing_rate_shift", "double")
    )
    found = to_rows(aggregate(df, aggs), rows, fields)
    status = f"{drift_status('shift', 'missing_rate_shift')} AS status"
    if not cols:
        return found.selectExpr(*(n for n, _ in fields), status)

    long = unpivot(df, [f"{tag} AS is_ref"], {c: filled(c) for c in cols}, "feature", "value")
    counts = long.groupBy("feature", "value").agg(
        F.expr("count_if(is_ref) AS r"), F.expr("count_if(NOT is_ref) AS c")
    )
    totals = counts.groupBy("feature").agg(F.expr("sum(r) AS all_r"), F.expr("sum(c) AS all_c"))
    apart = f"abs({ratio('c', 'all_c')} - {ratio('r', 'all_r')})"
    distance = (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.expr(f"sum({apart}) / 2 AS distance"))
        .withColumn("kind", F.lit("categorical"))
    )
    shift = "CASE WHEN kind = 'categorical' THEN coalesce(distance, 0D) ELSE shift END AS shift"
    return (
        found.join(F.broadcast(distance), ["kind", "feature"], "left")
        .selectExpr("kind", "feature", shift, "missing_rate_shift")
        .selectExpr("*", status)
    )


def prediction_drift(summary: DataFrame, meta: Mapping[str, Any]) -> DataFrame:
    """Mean probability against the validation positive rate; queue size against half the
    validation rows."""
    reference = dbl(meta["validation_positive_rate"])
    half = int(meta["validation_rows"] * 0.5)
    return summary.selectExpr(
        f"{reference} AS reference_mean_probability",
        "mean_probability AS current_mean_probability",
        f"mean_probability - {reference} AS mean_shift",
        "review_queue_size",
        f"review_queue_size - {half}L AS review_queue_shift",
    )


def drift_status_rows(numeric: DataFrame, categorical: DataFrame) -> DataFrame:
    """(kind, feature, shift, missing_rate_shift, status) of both kinds."""
    cols = ("feature", "mean_shift AS shift", "missing_rate_shift", "status")
    return numeric.selectExpr("'numeric' AS kind", *cols).unionByName(
        categorical.selectExpr("'categorical' AS kind", *cols)
    )


def drift_findings(status_rows: DataFrame, prediction: DataFrame) -> DataFrame:
    """Warnings and conditional advice of a drift run."""
    significant = status_rows.agg(F.expr("count_if(status = 'significant')")).scalar()
    one = prediction.withColumn("significant", significant)
    limit, size, s = PREDICTION_SHIFT, "review_queue_size", "drift"
    shifted, n = f"abs(mean_shift) > {dbl(limit)}", "significant"
    return to_rows(
        one,
        [
            finding(s, "prediction_mean_shifted", shifted, "mean_shift", limit),
            finding(s, "empty_queue", f"{size} = 0", size, 1),
            finding(s, "significant_feature_drift", f"{n} > 0", n, 0),
            finding(s, "review_before_promotion", f"{n} > 0", n, 0),
            finding(s, "compare_recent_batches", shifted, "mean_shift", limit),
        ],
    )
