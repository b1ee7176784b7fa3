"""Classification metrics, the threshold rule, slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, finding, to_rows, unpivot
from rankwatch.functions.values import (
    age_band,
    at_least,
    filled,
    num,
    quoted,
    ratio,
    ticket_band,
)
from rankwatch.operators.ordering import running_totals

METRICS = (
    "true_negatives",
    "false_positives",
    "false_negatives",
    "true_positives",
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "support",
)


class RuleError(ValueError):
    """The threshold rule met a row it has no answer for."""


def confusion_aggs(label: str, pred: str, prefix: str = "") -> dict[str, str]:
    """SQL aggregates of the four counts, rows, positives and predicted positives."""
    label, pred = f"({label})", f"({pred})"
    aggs = {
        "true_negatives": f"count_if({label} = 0 AND {pred} = 0)",
        "false_positives": f"count_if({label} = 0 AND {pred} = 1)",
        "false_negatives": f"count_if({label} = 1 AND {pred} = 0)",
        "true_positives": f"count_if({label} = 1 AND {pred} = 1)",
        "rows": "count(*)",
        "support": f"count_if({label} = 1)",
        "positive_predictions": f"count_if({pred} = 1)",
    }
    return {prefix + name: e for name, e in aggs.items()}


def ratios(prefix: str = "") -> dict[str, str]:
    """Accuracy, precision, recall and F1 from the counts; 0 where undefined."""
    tn, fp, fn, tp = (prefix + m for m in METRICS[:4])
    precision, recall = ratio(tp, f"({tp} + {fp})"), ratio(tp, f"({tp} + {fn})")
    out = {
        "accuracy": ratio(f"({tp} + {tn})", f"{prefix}rows"),
        "precision": precision,
        "recall": recall,
        "f1_score": ratio(f"(2D * {precision} * {recall})", f"({precision} + {recall})"),
        "predicted_positive_rate": ratio(f"{prefix}positive_predictions", f"{prefix}rows"),
    }
    return {prefix + name: e for name, e in out.items()}


def _with_ratios(counts: DataFrame, *prefixes: str) -> DataFrame:
    named = {n: e for p in prefixes or ("",) for n, e in ratios(p).items()}
    return counts.selectExpr("*", *[f"{e} AS {n}" for n, e in named.items()])


def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and ratios, one row per group (or one in all)."""
    aggs = [F.expr(f"{e} AS {n}") for n, e in confusion_aggs(label, pred).items()]
    return _with_ratios(df.groupBy(*by).agg(*aggs))


def rule_prediction(df: DataFrame, cfg: Config) -> str:
    """1 when the ticket count reaches the threshold."""
    return f"CAST({at_least(num(df.schema, cfg.ticket_column), cfg.ticket_threshold)} AS INT)"


def check_rule(df: DataFrame, cfg: Config, need_target: bool = True) -> None:
    """Raise when tickets or labels are missing or not numbers (one small job)."""
    columns = [cfg.ticket_column] + ([cfg.target_column] if need_target else [])
    for c in columns:
        if c not in df.columns:
            raise KeyError(f"missing required column: {c}")
    row = aggregate(df, {c: f"count_if(({num(df.schema, c)}) IS NULL)" for c in columns}).first()
    bad = [c for c in columns if row[c]]
    if bad:
        raise RuleError(f"non-numeric values in {', '.join(bad)}")


def evaluate_rule(df: DataFrame, cfg: Config, strict: bool = True) -> DataFrame:
    """The threshold rule against the labels, one row. Rows without tickets or label have no
    answer and raise, unless `strict` is off."""
    if strict:
        check_rule(df, cfg)
    out = confusion(df, num(df.schema, cfg.target_column), rule_prediction(df, cfg))
    return out.select(
        F.lit(float(cfg.ticket_threshold)).alias("threshold"),
        "positive_predictions",
        "predicted_positive_rate",
        *METRICS,
    )


def predicted_label(probability: str, threshold: float) -> str:
    return f"CAST({at_least(quoted(probability), threshold)} AS INT)"


def _squared_error(df: DataFrame, cfg: Config, score: str) -> str:
    y = num(df.schema, cfg.target_column)
    return f"coalesce(avg(power({quoted(score)} - ({y}), 2D)), 0D)"


def brier(df: DataFrame, cfg: Config, score: str) -> DataFrame:
    """Mean squared distance of score and label, 0 for an empty table."""
    return aggregate(df, {"brier_score": _squared_error(df, cfg, score)})


def average_precision(
    df: DataFrame, cfg: Config, score: str, slices: int | None = None
) -> DataFrame:
    """Step-wise area under the precision-recall curve, tied scores as one step.

    Rows collapse to one per distinct score before anything is ordered; the running counts
    are taken per slice of the score range. Empty input or no positives gives 0.
    """
    y = num(df.schema, cfg.target_column)
    pairs = df.selectExpr(
        f"{num(df.schema, score)} AS score", f"CAST({y} AS BIGINT) AS y"
    ).where("score IS NOT NULL")
    steps = pairs.groupBy("score").agg(F.expr("count(*) AS n"), F.expr("sum(y) AS tp"))
    run = running_totals(steps, "score", {"cum_n": "n", "cum_tp": "tp"}, pairs, slices)
    area = ratio("sum(tp * cum_tp / cum_n)", "sum(tp)")
    return aggregate(run, {"average_precision": area})


def model_metrics(df: DataFrame, cfg: Config, score: str) -> DataFrame:
    """Metrics of thresholded scores in one row, Brier included (one pass)."""
    y, pred = num(df.schema, cfg.target_column), predicted_label(score, cfg.decision_threshold)
    aggs = confusion_aggs(y, pred) | {"brier_score": _squared_error(df, cfg, score)}
    return _with_ratios(aggregate(df, aggs)).select(
        "rows", "positive_predictions", "predicted_positive_rate", "brier_score", *METRICS
    )


def metric_comparison(df: DataFrame, cfg: Config, score: str) -> DataFrame:
    """Model and rule side by side in one pass, with the differences model - rule."""
    y, pred = num(df.schema, cfg.target_column), predicted_label(score, cfg.decision_threshold)
    rule = rule_prediction(df, cfg)
    both = _with_ratios(
        aggregate(df, confusion_aggs(y, pred, "model_") | confusion_aggs(y, rule, "rule_")),
        "model_",
        "rule_",
    )
    names = ("recall", "precision", "f1_score")
    return both.selectExpr(
        "model_rows AS rows",
        *[f"{side}_{n}" for side in ("model", "rule") for n in names],
        "model_predicted_positive_rate",
        *[f"model_{n} - rule_{n} AS {n.removesuffix('_score')}_delta" for n in names],
    )


def slice_values(df: DataFrame, cfg: Config) -> dict[str, str]:
    """Slice name -> value expression, for the columns the table has."""
    out = {c: filled(c) for c in cfg.categorical if c in df.columns}
    if cfg.age_column in df.columns:
        out["age_band"] = age_band(f"({num(df.schema, cfg.age_column)})")
    if cfg.ticket_column in df.columns:
        out["support_ticket_band"] = ticket_band(f"({num(df.schema, cfg.ticket_column)})")
    return out


def slice_metrics(df: DataFrame, cfg: Config, score: str) -> DataFrame:
    """Metrics per value of every slice column: one scan, one shuffle of partial counts."""
    y, pred = num(df.schema, cfg.target_column), predicted_label(score, cfg.decision_threshold)
    keep = [f"{y} AS _y", f"{pred} AS _pred"]
    long = unpivot(df, keep, slice_values(df, cfg), "slice_name", "slice_value")
    return confusion(long, "_y", "_pred", ["slice_name", "slice_value"]).selectExpr(
        "slice_name",
        "slice_value",
        "rows AS row_count",
        f"{ratio('support', 'rows')} AS positive_rate",
        *METRICS,
    )


def evaluation_findings(comparison: DataFrame, slices: DataFrame) -> DataFrame:
    """Warnings and conditional advice of an evaluation."""
    one = comparison.withColumn("slice_rows", slices.agg(F.count(F.lit(1))).scalar())
    s, rate = "evaluation", "model_predicted_positive_rate"
    below = "rule_recall >= model_recall"
    return to_rows(
        one,
        [
            finding(s, "empty_test", "rows = 0", "rows", 1),
            finding(s, "recall_not_above_rule", below, "model_recall", "rule_recall"),
            finding(s, "flags_over_half", f"{rate} > 0.5D", rate, 0.5),
            finding(s, "no_slices", "slice_rows = 0", "slice_rows", 1),
            finding(s, "recall_improved", "recall_delta > 0", "recall_delta", 0),
            finding(s, "recall_not_improved", "recall_delta <= 0", "recall_delta", 0),
            finding(s, "precision_fell", "precision_delta < 0", "precision_delta", 0),
        ],
    )
