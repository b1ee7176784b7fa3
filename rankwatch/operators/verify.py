"""Checks on written outputs before they are handed over."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, to_rows
from rankwatch.functions.values import double, num, quoted, text
from rankwatch.operators.model import Bundle
from rankwatch.operators.scoring import SCORED_COLUMNS

CHECK_FIELDS = (
    ("name", "string"),
    ("check", "string"),
    ("passed", "boolean"),
    ("value", "double"),
    ("detail", "string"),
)
# Claimed ranks are compared inside ranges of so many, and the edges of ranges inside ranges of so
# many ranges: three levels hold every whole number there is.
RANK_BLOCK = 1 << 21
LEVELS = 3

PREDICTIONS, MODEL = "prediction_artifact", "model_artifact"
# Sections a report table must hold.
EVALUATION_SECTIONS = ("model_metrics", "baseline_metrics")
DRIFT_SECTIONS = ("prediction_drift",)


def check(
    name: str,
    code: str,
    passed: str | bool,
    value: str | float | None = None,
    detail: str | None = None,
) -> dict[str, str]:
    """A check row: `passed` and `value` may be SQL text over an aggregate."""
    return {
        "name": text(name),
        "check": text(code),
        "passed": str(passed).lower() if isinstance(passed, bool) else passed,
        "value": value if isinstance(value, str) else double(value),
        "detail": text(detail),
    }


def _constant(spark: SparkSession, rows: Iterable[dict[str, str]]) -> DataFrame:
    return to_rows(spark.range(1), rows, CHECK_FIELDS)


_BAND = "coalesce(risk_band, '')"
_BAD_BAND = f"{_BAND} NOT IN ('high', 'medium', 'low')"


def invalid_bands(scored: DataFrame) -> DataFrame:
    """Distinct band values outside the allowed three."""
    return scored.where(_BAD_BAND).groupBy(F.expr(f"{_BAND} AS risk_band")).count()


def _per_rank(scored: DataFrame) -> DataFrame:
    """One row per claimed rank: lowest and highest probability, row count. A rank claimed
    by many rows is combined before the shuffle."""
    p, r = num(scored.schema, "churn_probability"), num(scored.schema, "review_rank")
    return (
        scored.selectExpr(f"{p} AS p", f"CAST({r} AS BIGINT) AS r")
        .groupBy("r")
        .agg(F.expr("min(p) AS lo"), F.expr("max(p) AS hi"), F.expr("count(*) AS n"))
    )


def rank_facts(scored: DataFrame, block: int = RANK_BLOCK, levels: int = LEVELS) -> DataFrame:
    """One row: first, last and distinct ranks, the row count, and how often the probability
    rises from one claimed rank to the next, without a sort of all rows.

    Rows are combined per rank before the one shuffle by rank. Ranges of ranks then carry their
    edges (highest probability at their first rank, lowest at their last) upwards: neighbours
    are compared inside a range, the edges of neighbouring ranges inside a range of ranges, and
    so on. A range has at most `block` members on each level, whatever ranks are claimed, so
    sparse ranks do not meet in one task either. Rows without a rank are only counted.
    """
    edges = _per_rank(scored).selectExpr(
        "r", "n", "r AS at", "hi AS first_hi", "lo AS last_lo", "0L AS rises",
        "r AS first_r", "r AS last_r", "IF(r IS NULL, 0L, 1L) AS distinct_r",
    )
    sums = [F.expr(f"coalesce(sum({c}), 0) AS {c}") for c in ("n", "distinct_r")]
    ends = [F.expr("min(first_r) AS first_r"), F.expr("max(last_r) AS last_r")]
    for level in range(levels + 1):
        # What is left at the top is one range.
        top = level == levels
        keys = [] if top else ["part"]
        edges = edges if top else edges.withColumn("part", F.expr(f"at DIV {block}L"))
        inside = Window.partitionBy(*keys).orderBy("at")
        rise = F.col("first_hi") > F.lag("last_lo").over(inside)
        edges = edges.withColumn("rise", rise & F.col("at").isNotNull())
        rises = F.expr("coalesce(sum(rises), 0) + count_if(rise) AS rises")
        carried = [] if top else [
            F.expr("min_by(first_hi, at) AS first_hi"), F.expr("max_by(last_lo, at) AS last_lo")
        ]
        edges = edges.groupBy(*keys).agg(rises, *carried, *sums, *ends)
        edges = edges if top else edges.withColumnRenamed("part", "at")
    return edges


def rank_order(scored: DataFrame, block: int = RANK_BLOCK) -> DataFrame:
    """One row: how often the probability rises from one rank to the next."""
    return rank_facts(scored, block).select("rises")


def verify_scored(scored: DataFrame, cfg: Config, top_k: int | None = None) -> DataFrame:
    """Check rows for a scored table; missing columns stop further checks."""
    needed = (cfg.id_column, *SCORED_COLUMNS)
    absent = [c for c in needed if c not in scored.columns]
    columns = check(PREDICTIONS, "required_columns", not absent, len(absent), ", ".join(absent))
    if absent:
        return _constant(scored.sparkSession, [columns])

    p, rank = num(scored.schema, "churn_probability"), num(scored.schema, "review_rank")
    flag = "coalesce(CAST(review_queue_flag AS BOOLEAN), false)"
    priority = f"CASE WHEN {flag} THEN 'review' ELSE 'monitor' END"
    one = aggregate(
        scored,
        {
            "rows": "count(*)",
            "no_p": f"count_if(({p}) IS NULL)",
            "outside": f"count_if(({p}) < 0D OR ({p}) > 1D)",
            "bands": f"count_if({_BAD_BAND})",
            "queue": f"count_if({flag})",
            "last_flagged": f"max(CASE WHEN {flag} THEN {rank} END)",
            "first_unflagged": f"min(CASE WHEN NOT {flag} THEN {rank} END)",
            "priorities": f"count_if(NOT review_priority <=> {priority})",
        },
    )
    # All flagged ranks are within the queue size and no other rank is.
    flags = "coalesce(last_flagged <= queue, true) AND coalesce(first_unflagged > queue, true)"
    rows = [
        columns,
        check(PREDICTIONS, "not_empty", "rows > 0", "rows"),
        check(PREDICTIONS, "numeric_probabilities", "no_p = 0", "no_p"),
        check(PREDICTIONS, "probabilities_in_range", "outside = 0", "outside"),
        check(PREDICTIONS, "known_bands", "bands = 0", "bands"),
        check(PREDICTIONS, "flags_are_top_ranks", flags, "queue"),
        check(PREDICTIONS, "priority_matches_flag", "priorities = 0", "priorities"),
    ]
    if top_k is not None:
        expected = f"queue = least({int(top_k)}L, rows)"
        rows.append(check(PREDICTIONS, "queue_size", expected, "queue"))
    contiguous = "n = 0 OR (first_r = 1 AND last_r = n AND distinct_r = n)"
    sequence = check(PREDICTIONS, "contiguous_ranks", contiguous, "distinct_r")
    ordered = check(PREDICTIONS, "sorted_by_probability", "rises = 0", "rises")
    return (
        to_rows(one, rows, CHECK_FIELDS)
        .unionByName(to_rows(rank_facts(scored), [sequence, ordered], CHECK_FIELDS))
    )


def scored_details(scored: DataFrame) -> DataFrame:
    """One row: rows, queue size, positives, predicted rate."""
    label = f"coalesce({num(scored.schema, 'predicted_label')}, 0D)"
    return aggregate(
        scored,
        {
            "row_count": "count(*)",
            "queue_size": "count_if(CAST(review_queue_flag AS BOOLEAN))",
            "positive_predictions": f"CAST(coalesce(sum({label}), 0D) AS BIGINT)",
            "predicted_positive_rate": f"coalesce(avg({label}), 0D)",
        },
    )


def verify_bundle(spark: SparkSession, bundle: Bundle | None, error: str = "") -> DataFrame:
    """Check rows for a model bundle; `bundle` is None when it could not be loaded."""
    if bundle is None:
        return _constant(spark, [check(MODEL, "loads", False, None, error)])
    meta = bundle.meta
    sizes = [int(meta.get(f"{p}_rows") or 0) for p in ("train", "validation", "test")]
    last = bundle.model.stages[-1]
    profile = not (bundle.ref_numeric.isEmpty() and bundle.ref_categorical.isEmpty())
    return _constant(
        spark,
        [
            check(MODEL, "loads", True),
            check(MODEL, "named", bool(meta.get("model_name")), None, meta.get("model_name")),
            check(MODEL, "split_sizes_positive", min(sizes) > 0, sum(sizes)),
            check(MODEL, "gives_probabilities", hasattr(last, "getProbabilityCol")),
            check(MODEL, "has_monitoring_profile", profile),
        ],
    )


def verify_report(
    report: DataFrame | None, name: str, sections: Iterable[str], spark: SparkSession
) -> DataFrame:
    """Check rows for a report table: there, not empty, all required sections present."""
    if report is None:
        return _constant(spark, [check(name, "exists", False)])
    sections = list(sections)
    aggs = {"rows": "count(*)"}
    aggs |= {f"s{i}": f"count_if(section = {text(s)})" for i, s in enumerate(sections)}
    rows = [check(name, "exists", True), check(name, "not_empty", "rows > 0", "rows")]
    rows += [
        check(name, "required_section", f"s{i} > 0", f"s{i}", s) for i, s in enumerate(sections)
    ]
    return to_rows(aggregate(report, aggs), rows, CHECK_FIELDS)


def missing_artifact(spark: SparkSession, name: str, detail: str) -> DataFrame:
    return _constant(spark, [check(name, "exists", False, None, detail)])


def skipped(spark: SparkSession, name: str) -> DataFrame:
    return _constant(spark, [check(name, "skipped", True)])


def handoff(checks: Iterable[DataFrame]) -> DataFrame:
    """(name, passed, failed): one row per artifact and one for all of them."""
    every = reduce(DataFrame.unionByName, checks)
    per_name = every.groupBy("name").agg(
        F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )
    total = per_name.agg(
        F.lit("handoff").alias("name"),
        F.bool_and("passed").alias("passed"),
        F.sum("failed").alias("failed"),
    )
    return per_name.unionByName(total)


REPORT_FIELDS = (
    ("section", "string"),
    ("item", "string"),
    ("metric", "string"),
    ("value", "double"),
    ("detail", "string"),
)


def report_rows(section: str, frame: DataFrame, item: str = "NULL") -> DataFrame:
    """A report section: every column of `frame` as (section, item, metric, value, detail)."""
    rows = []
    for f in frame.schema.fields:
        c, kind = quoted(f.name), f.dataType.typeName()
        row = {"section": text(section), "item": item, "metric": text(f.name)}
        if kind in ("string", "date"):
            row["detail"] = c
        else:
            row["value"] = f"CAST({c} AS INT)" if kind == "boolean" else c
        rows.append(row)
    return to_rows(frame, rows, REPORT_FIELDS)


def report(sections: Mapping[str, DataFrame], items: Mapping[str, str] | None = None) -> DataFrame:
    """All sections in one long table; `items` names the SQL that labels a section's rows."""
    items = items or {}
    return reduce(
        DataFrame.unionByName,
        [report_rows(name, frame, items.get(name, "NULL")) for name, frame in sections.items()],
    )
