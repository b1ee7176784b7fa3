"""Whether a candidate may replace the champion: paired comparison on one test part.

Both scores stand in the same rows, so differences are of the models and not of the rows; rows
without a label or one of the scores take no part. Every condition is a finding that says what was
measured and what the bound is. `fired` means the condition is violated; a candidate passes when
nothing has fired.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import FINDING_FIELDS, aggregate, finding, to_rows, unpivot
from rankwatch.functions.values import double, num, quoted, ratio, text
from rankwatch.operators.metrics import average_precision, predicted_label, slice_values
from rankwatch.sources.staging import stage

SCOPE = "promotion"


@dataclass(frozen=True)
class Bounds:
    """What a candidate may lose against the champion at most."""

    recall: float = 0.0
    precision: float = 0.02
    pr_auc: float = 0.0
    brier: float = 0.01
    slice_recall: float = 0.1
    slice_rows: int = 30
    changed: float = 0.25


def _paired(scored: DataFrame, cfg: Config, champion: str, candidate: str) -> DataFrame:
    """(slice columns, _y, _a, _b, _la, _lb): label, both scores and both predicted labels."""
    t = cfg.decision_threshold
    y, a, b = num(scored.schema, cfg.target_column), num(scored.schema, champion), num(scored.schema, candidate)
    used = [c for c in (*cfg.categorical, cfg.age_column, cfg.ticket_column) if c in scored.columns]
    rows = scored.selectExpr(
        *map(quoted, used), f"{y} AS _y", f"{a} AS _a", f"{b} AS _b",
        f"{predicted_label(champion, t)} AS _la", f"{predicted_label(candidate, t)} AS _lb",
    )
    return rows.where("_y IS NOT NULL AND _a IS NOT NULL AND _b IS NOT NULL")


def _sums(label: str) -> str:
    return f"count_if({label} = 1 AND _y = 1)"


def paired_metrics(scored: DataFrame, cfg: Config, champion: str, candidate: str) -> DataFrame:
    """One row: rows, and recall, precision, average precision and Brier score of both, with the
    share of rows whose label changes. One pass, and one per average precision."""
    rows = stage(_paired(scored, cfg, champion, candidate), "paired")
    return _metrics(rows, cfg)


def _metrics(rows: DataFrame, cfg: Config) -> DataFrame:
    aggs = {"rows": "count(*)", "changed": ratio("count_if(_la <> _lb)", "count(*)")}
    for side, label, score in (("champion", "_la", "_a"), ("candidate", "_lb", "_b")):
        aggs |= {
            f"{side}_recall": ratio(_sums(label), "count_if(_y = 1)"),
            f"{side}_precision": ratio(_sums(label), f"count_if({label} = 1)"),
            f"{side}_brier": f"coalesce(avg(power({score} - _y, 2D)), 0D)",
        }
    own = cfg.with_(target_column="_y")
    one = aggregate(rows, aggs)
    for side, score in (("champion", "_a"), ("candidate", "_b")):
        one = one.withColumn(f"{side}_pr_auc", average_precision(rows, own, score).scalar())
    return one


def slice_recalls(rows: DataFrame, cfg: Config) -> DataFrame:
    """(slice, rows, positives, champion_recall, candidate_recall) of every slice: one shuffle of
    partial counts for both models."""
    long = unpivot(rows, ["_y", "_la", "_lb"], slice_values(rows, cfg), "name", "value")
    return long.groupBy("name", "value").agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr("count_if(_y = 1) AS positives"),
        F.expr(f"{ratio(_sums('_la'), 'count_if(_y = 1)')} AS champion_recall"),
        F.expr(f"{ratio(_sums('_lb'), 'count_if(_y = 1)')} AS candidate_recall"),
    ).withColumn("slice", F.concat_ws("=", "name", "value")).drop("name", "value")


def promotion_gate(
    scored: DataFrame, cfg: Config, champion: str, candidate: str, bounds: Bounds = Bounds()
) -> DataFrame:
    """Findings: one per overall condition and one per slice that has enough rows and positives."""
    rows = stage(_paired(scored, cfg, champion, candidate), "paired")
    fall = lambda m: f"champion_{m} - candidate_{m}"
    worse = [
        finding(SCOPE, f"{m}_lost", f"{fall(m)} > {double(getattr(bounds, m))}", fall(m), getattr(bounds, m))
        for m in ("recall", "precision", "pr_auc")
    ]
    brier = "candidate_brier - champion_brier"
    overall = to_rows(
        _metrics(rows, cfg),
        [
            finding(SCOPE, "nothing_to_compare", "rows = 0", "rows", 1),
            *worse,
            finding(SCOPE, "brier_grew", f"{brier} > {double(bounds.brier)}", brier, bounds.brier),
            finding(SCOPE, "many_labels_changed", f"changed > {double(bounds.changed)}", "changed", bounds.changed),
        ],
        FINDING_FIELDS,
    )
    slices = slice_recalls(rows, cfg).where(f"rows >= {bounds.slice_rows} AND positives > 0")
    lost = fall("recall")
    each = slices.selectExpr(
        f"{text(SCOPE)} AS scope", "'slice_recall_lost' AS code", "slice AS column",
        f"{lost} > {double(bounds.slice_recall)} AS fired", f"{lost} AS value",
        f"{double(bounds.slice_recall)} AS bound", "CAST(NULL AS STRING) AS detail",
    )
    return overall.unionByName(each)


def may_promote(findings: DataFrame) -> bool:
    """Whether no condition is violated."""
    return findings.where("fired").limit(1).count() == 0
