"""From probabilities to a ranked review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, finding, to_rows
from rankwatch.functions.values import num, quoted, ratio, risk_band
from rankwatch.operators.metrics import predicted_label
from rankwatch.operators.ordering import global_rank

PROBABILITY = "churn_probability"
SCORED_COLUMNS = (
    PROBABILITY,
    "predicted_label",
    "risk_band",
    "review_rank",
    "review_queue_flag",
    "review_priority",
)


def label_and_band(df: DataFrame, cfg: Config) -> DataFrame:
    """Append predicted label and risk band; a missing probability is 0 / low."""
    band = risk_band(quoted(PROBABILITY), cfg.high_risk, cfg.medium_risk)
    return df.selectExpr(
        "*",
        f"{predicted_label(PROBABILITY, cfg.decision_threshold)} AS predicted_label",
        f"{band} AS risk_band",
    )


def review_queue(
    df: DataFrame, cfg: Config, top_k: int | None = None, slices: int | None = None
) -> DataFrame:
    """Every row with its rank by probability (ties by id), queue flag and priority."""
    k = int(cfg.top_k if top_k is None else top_k)
    ranked = global_rank(label_and_band(df, cfg), PROBABILITY, cfg.id_column, "review_rank", slices)
    return ranked.selectExpr(
        "*",
        f"review_rank <= {k} AS review_queue_flag",
        f"CASE WHEN review_rank <= {k} THEN 'review' ELSE 'monitor' END AS review_priority",
    )


def top_of_queue(df: DataFrame, cfg: Config, top_k: int | None = None) -> DataFrame:
    """Only the first `top_k` rows: each task keeps k rows, nothing else moves."""
    k = max(0, cfg.top_k if top_k is None else top_k)
    return (
        label_and_band(df, cfg)
        .orderBy(
            F.expr(num(df.schema, PROBABILITY)).desc_nulls_last(),
            F.col(quoted(cfg.id_column)).asc_nulls_last(),
        )
        .limit(k)
    )


def batch_summary(df: DataFrame, cfg: Config, top_k: int | None = None) -> DataFrame:
    """One row about a batch of probabilities. Needs no ranks: the queue holds min(k, rows)."""
    k = int(cfg.top_k if top_k is None else top_k)
    p = num(df.schema, PROBABILITY)
    one = aggregate(
        label_and_band(df, cfg),
        {
            "row_count": "count(*)",
            "positive_predictions": "count_if(predicted_label = 1)",
            **{f"{b}_count": f"count_if(risk_band = '{b}')" for b in ("high", "medium", "low")},
            "max_probability": f"coalesce(max({p}), 0D)",
            "mean_probability": f"coalesce(avg({p}), 0D)",
            "min_probability": f"min({p})",
            "missing_probabilities": f"count_if(({p}) IS NULL)",
        },
    )
    return one.selectExpr(
        "row_count",
        f"least(row_count, {max(0, k)}L) AS review_queue_size",
        "positive_predictions",
        f"{ratio('positive_predictions', 'row_count')} AS predicted_positive_rate",
        "high_count",
        "medium_count",
        "low_count",
        f"{k} AS top_k",
        "max_probability",
        "mean_probability",
        "min_probability",
        "missing_probabilities",
    )


def scoring_findings(summary: DataFrame) -> DataFrame:
    """Warnings about a batch and which way to use the queue."""
    constant = (
        "row_count = missing_probabilities OR coalesce(min_probability = max_probability, true)"
    )
    small, size, s = "review_queue_size < top_k", "review_queue_size", "scoring"
    lost = "missing_probabilities"
    return to_rows(
        summary,
        [
            finding(s, "empty_batch", "row_count = 0", "row_count", 1),
            finding(s, "top_k_not_positive", "top_k <= 0", "top_k", 1),
            finding(s, lost, f"{lost} > 0", lost, 0),
            finding(s, "scores_nearly_constant", constant),
            finding(s, "queue_below_capacity", small, size, "top_k"),
            finding(s, "queue_at_capacity", f"NOT ({small})", size, "top_k"),
        ],
    )
