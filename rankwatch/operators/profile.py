"""Descriptive profile of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, finding, to_rows
from rankwatch.functions.values import day, double, key, num, quoted, ratio, text
from rankwatch.operators.metrics import evaluate_rule
from rankwatch.operators.ordering import DIRECT_ROWS, medians
from rankwatch.operators.quality import category_counts
from rankwatch.sources.staging import stage

# Limits of the profile findings.
ID_UNIQUE = 0.95
BALANCE = (0.2, 0.8)
CATEGORY_UNIQUE = 0.25
TEXT_UNIQUE = 0.9

SCOPE = "profile"


def overview(df: DataFrame, cfg: Config) -> DataFrame:
    """One row: rows, columns, share of positives."""
    rate = double(None)
    if cfg.target_column in df.columns:
        rate = f"avg({num(df.schema, cfg.target_column)})"
    one = aggregate(df, {"row_count": "count(*)", "positive_rate": rate})
    return one.selectExpr("row_count", f"{len(df.columns)} AS column_count", "positive_rate")


def target_distribution(df: DataFrame, cfg: Config) -> DataFrame:
    """(label, n): rows per target value, missing as a row of its own."""
    label = F.expr(f"CAST({quoted(cfg.target_column)} AS STRING) AS label")
    return df.groupBy(label).agg(F.expr("count(*) AS n"))


def numeric_profile(df: DataFrame, cfg: Config, direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """Missing, min, max, mean, exact median and population deviation per numeric column.

    One scan for everything but the medians, which need the counts it finds; the result is
    one row per configured column.
    """
    values = {c: num(df.schema, c) for c in cfg.numeric if c in df.columns}
    aggs = {"rows": "count(*)"}
    for c, v in values.items():
        aggs |= {f"{c}|n": f"count({v})", f"{c}|std": f"stddev_pop({v})"}
        aggs |= {f"{c}|{f}": f"{f}({v})" for f in ("min", "max", "avg")}
    one = aggregate(df, aggs).first()
    counts = {c: one[f"{c}|n"] for c in values}
    mid = medians(df, {c: F.expr(v) for c, v in values.items()}, counts, direct_rows)
    rows = [
        {
            "feature": text(c),
            "missing_count": str(one["rows"] - counts[c]),
            "min": double(one[f"{c}|min"]),
            "max": double(one[f"{c}|max"]),
            "mean": double(one[f"{c}|avg"]),
            "median": double(mid[c]),
            "std": double(one[f"{c}|std"]),
        }
        for c in values
    ]
    stats = ("min", "max", "mean", "median", "std")
    fields = (("feature", "string"), ("missing_count", "bigint"), *((s, "double") for s in stats))
    return to_rows(df.sparkSession.range(1), rows, fields)


def categorical_profile(df: DataFrame, cfg: Config) -> DataFrame:
    """(feature, unique_count, unique_ratio): distinct present values, and per row."""
    counts = category_counts(df, list(cfg.categorical), fill=False)
    distinct = "count_if(value IS NOT NULL)"
    return counts.groupBy("feature").agg(
        F.expr(f"{distinct} AS unique_count"),
        F.expr(f"{ratio(distinct, 'sum(n)')} AS unique_ratio"),
    )


def categorical_top(df: DataFrame, cfg: Config, k: int = 3) -> DataFrame:
    """The k most frequent values per column; missing counts as a value, ties by value.

    Each task keeps its k best per feature before the rows of a feature meet.
    """
    counts = category_counts(df, list(cfg.categorical), fill=False)
    best = Window.partitionBy("feature").orderBy(
        F.col("n").desc(), F.col("value").asc_nulls_last()
    )
    return (
        counts.withColumn("position", F.row_number().over(best))
        .where(F.col("position") <= k)
        .select("feature", "position", "value", "n")
    )


def date_profile(df: DataFrame, cfg: Config) -> DataFrame:
    """Per date column: parseable or not, first and last day, whole days between them."""
    # Dates give whole days at once; for time stamps the last day may be incomplete.
    clock = "'HH:mm:ss.SSSSSS'"
    aggs, rows = {}, []
    for i, c in enumerate(c for c in cfg.dates if c in df.columns):
        value = day(df.schema, c, cfg.date_format)
        lo, hi = f"lo{i}", f"hi{i}"
        aggs |= {lo: f"min({value})", hi: f"max({value})"}
        short = f"CAST(date_format({hi}, {clock}) < date_format({lo}, {clock}) AS INT)"
        rows.append(
            {
                "column": text(c),
                "parseable": f"{lo} IS NOT NULL",
                "min_date": f"to_date({lo})",
                "max_date": f"to_date({hi})",
                "span_days": f"datediff(to_date({hi}), to_date({lo})) - {short}",
            }
        )
    kinds = ("string", "boolean", "date", "date", "int")
    names = ("column", "parseable", "min_date", "max_date", "span_days")
    return to_rows(aggregate(df, {"rows": "count(*)", **aggs}), rows, tuple(zip(names, kinds, strict=True)))


def _text(column: str) -> str:
    return f"coalesce(CAST({quoted(column)} AS STRING), '')"


def _distinct_texts(df: DataFrame, column: str) -> DataFrame:
    """One row: distinct texts, rows. Whole texts are hashed where they are read, so 16
    bytes per text are shuffled; repeated texts collapse before the shuffle."""
    return (
        df.groupBy(F.expr(f"unhex(md5({_text(column)})) AS k"))
        .agg(F.expr("count(*) AS n"))
        .agg(F.expr("count(*) AS distinct_texts"), F.expr("coalesce(sum(n), 0) AS rows"))
    )


def text_profile(df: DataFrame, cfg: Config, direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """Per text column: mean and exact median length, distinct texts per row; missing is the
    empty text.

    Texts are the bulk of a table, so they are read once: a hash and a length per row and
    column are staged, and the passes that follow read those.
    """
    columns = {f"c{i}": c for i, c in enumerate(c for c in cfg.texts if c in df.columns)}
    narrow = stage(
        df.selectExpr(
            *[f"unhex(md5({_text(c)})) AS k_{n}" for n, c in columns.items()],
            *[f"CAST(char_length({_text(c)}) AS DOUBLE) AS {n}" for n, c in columns.items()],
        ),
        "texts",
    )
    row = aggregate(narrow, {"rows": "count(*)", **{n: f"avg({n})" for n in columns}}).first()
    mid = medians(
        narrow, {n: F.col(n) for n in columns}, {n: row["rows"] for n in columns}, direct_rows
    )
    rows = [
        {
            "column": text(c),
            "average_length": double(row[n] or 0.0),
            "median_length": double(mid[n] or 0.0),
            "unique_ratio": ratio(f"u_{n}", str(row["rows"])),
        }
        for n, c in columns.items()
    ]
    stats = ("average_length", "median_length", "unique_ratio")
    fields = (("column", "string"), *((s, "double") for s in stats))
    distinct = [
        narrow.select(f"k_{n}").distinct().agg(F.count(F.lit(1)).alias(f"u_{n}")) for n in columns
    ]
    # One-row tables side by side.
    one = reduce(lambda a, b: a.withColumn(b.columns[0], b.scalar()), distinct) if distinct else df.sparkSession.range(1)
    return to_rows(one, rows, fields)


def profile_findings(df: DataFrame, cfg: Config) -> DataFrame:
    """Everything about a table worth a look before modelling.

    Needs no medians: one scan for the column checks, one grouped count each for the id, the
    categories and the texts.
    """
    parts = []
    idc, t = cfg.id_column, cfg.target_column
    if idc in df.columns:
        share = ratio(f"count(DISTINCT {key(df.schema, idc)})", "count(*)")
        row = finding(SCOPE, "id_unique", f"r >= {double(ID_UNIQUE)}", "r", ID_UNIQUE, idc)
        parts.append(to_rows(aggregate(df, {"r": share}), [row]))

    aggs, rows = {"rows": "count(*)"}, []
    if t in df.columns:
        aggs["rate"] = f"avg({num(df.schema, t)})"
        skewed = f"rate < {double(BALANCE[0])} OR rate > {double(BALANCE[1])}"
        rows.append(finding(SCOPE, "target_skewed", skewed, "rate", None, t))
    for i, c in enumerate(c for c in cfg.dates if c in df.columns):
        aggs[f"latest{i}"] = f"max({day(df.schema, c, cfg.date_format)})"
        rows.append(finding(SCOPE, "date_parseable", f"latest{i} IS NOT NULL", column=c))
    for i, c in enumerate(c for c in cfg.numeric if c in df.columns):
        aggs[f"min{i}"] = f"min({num(df.schema, c)})"
        rows.append(finding(SCOPE, "negative_values", f"min{i} < 0", f"min{i}", 0, c))
    parts.append(to_rows(aggregate(df, aggs), rows))

    high = finding(
        SCOPE,
        "high_cardinality",
        f"unique_ratio >= {double(CATEGORY_UNIQUE)}",
        "unique_ratio",
        CATEGORY_UNIQUE,
    )
    parts.append(to_rows(categorical_profile(df, cfg), [high | {"column": "feature"}]))
    for c in (c for c in cfg.texts if c in df.columns):
        share = ratio("distinct_texts", "rows")
        row = finding(SCOPE, "text_unique", f"r >= {double(TEXT_UNIQUE)}", "r", TEXT_UNIQUE, c)
        parts.append(to_rows(_distinct_texts(df, c).selectExpr(f"{share} AS r"), [row]))
    return reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """All profile tables; the rule appears when its two columns exist."""
    out = {
        "overview": overview(df, cfg),
        "numeric": numeric_profile(df, cfg),
        "categorical": categorical_profile(df, cfg),
        "categorical_top": categorical_top(df, cfg),
        "date": date_profile(df, cfg),
        "text": text_profile(df, cfg),
        "findings": profile_findings(df, cfg),
    }
    if cfg.target_column in df.columns:
        out["target"] = target_distribution(df, cfg)
        if cfg.ticket_column in df.columns:
            out["rule"] = evaluate_rule(df, cfg)
    return out
