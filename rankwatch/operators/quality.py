"""Data-quality checks: one scan for all column checks, one for duplicate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, finding, to_rows, unpivot
from rankwatch.functions.values import double, filled, key, missing, num, quoted, text

SCOPE = "validation"


class DataValidationError(ValueError):
    """A table failed validation and the caller asked to stop."""


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing) for every column of the table that has missing values."""
    counts = {f"m{i}": f"count_if({missing(df.schema, c)})" for i, c in enumerate(df.columns)}
    rows = [{"column": text(c), "missing": f"m{i}"} for i, c in enumerate(df.columns)]
    fields = (("column", "string"), ("missing", "bigint"))
    return to_rows(aggregate(df, counts), rows, fields).where("missing > 0")


def _rows_per_key(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.expr(f"{key(df.schema, column)} AS id")).count()


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """One row: rows beyond the first of each key, missing keys counted as equal."""
    return _rows_per_key(df, column).agg(F.expr("coalesce(sum(count - 1), 0) AS duplicates"))


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """The repeated keys with their row counts."""
    return _rows_per_key(df, column).where("count > 1")


def _target_errors(df: DataFrame, cfg: Config) -> dict[str, str]:
    """Aggregates: target values that are no number, and numbers other than 0 and 1."""
    t = cfg.target_column
    n = num(df.schema, t)
    return {
        "non_numeric": f"count_if(NOT {missing(df.schema, t)} AND ({n}) IS NULL)",
        "outside": f"count_if(({n}) NOT IN (0D, 1D))",
    }


def target_domain(df: DataFrame, cfg: Config) -> DataFrame:
    """One row: target values that are no number, that are no 0 or 1, and missing ones."""
    t = cfg.target_column
    absent = f"count_if({missing(df.schema, t)})"
    one = aggregate(df, {**_target_errors(df, cfg), "missing": absent})
    return one.selectExpr(f"{text(t)} AS `column`", "non_numeric", "outside", "missing")


def target_invalid_values(df: DataFrame, cfg: Config) -> DataFrame:
    """Distinct target values that are present but not 0 or 1, with counts."""
    t = cfg.target_column
    n = num(df.schema, t)
    return (
        df.selectExpr(
            f"CAST({quoted(t)} AS STRING) AS target_value",
            f"({n}) IS NOT NULL AS is_numeric",
            f"NOT {missing(df.schema, t)} AND coalesce(({n}) NOT IN (0D, 1D), true) AS bad",
        )
        .where("bad")
        .groupBy("target_value", "is_numeric")
        .agg(F.expr("count(*) AS n"))
    )


def _range_aggs(df: DataFrame, column: str, cfg: Config) -> dict[str, str]:
    v, (lo, hi) = num(df.schema, column), cfg.ranges[column]
    out = {"non_numeric": f"count_if(NOT {missing(df.schema, column)} AND ({v}) IS NULL)"}
    if lo is not None:
        out["below_min"] = f"count_if(({v}) < {double(lo)})"
    if hi is not None:
        out["above_max"] = f"count_if(({v}) > {double(hi)})"
    return out


def numeric_ranges(df: DataFrame, cfg: Config) -> DataFrame:
    """(column, non_numeric, below_min, above_max); bounds are only judged on clean columns."""
    aggs, rows = {}, []
    for i, c in enumerate(c for c in cfg.ranges if c in df.columns):
        found = _range_aggs(df, c, cfg)
        aggs |= {f"{code}{i}": e for code, e in found.items()}
        row = {"column": text(c), "non_numeric": f"non_numeric{i}"}
        for code in ("below_min", "above_max"):
            if code in found:
                row[code] = f"CASE WHEN non_numeric{i} = 0 THEN {code}{i} END"
        rows.append(row)
    fields = (
        ("column", "string"),
        ("non_numeric", "bigint"),
        ("below_min", "bigint"),
        ("above_max", "bigint"),
    )
    return to_rows(aggregate(df, aggs or {"n": "count(*)"}), rows, fields)


def validate(
    df: DataFrame, cfg: Config, require_target: bool = True, fail_fast: bool = False
) -> DataFrame:
    """All checks as findings; with `fail_fast` a fired finding raises (one small job)."""
    t = cfg.target_column
    rows = [
        finding(SCOPE, "required_column", c not in df.columns, column=c)
        for c in cfg.required_columns(require_target)
    ]
    aggs = {"rows": "count(*)"}
    if not cfg.allow_missing:
        for i, c in enumerate(df.columns):
            aggs[f"m{i}"] = f"count_if({missing(df.schema, c)})"
            rows.append(finding(SCOPE, "missing_values", f"m{i} > 0", f"m{i}", 0, c))
    if require_target and t in df.columns:
        aggs |= _target_errors(df, cfg)
        outside = "non_numeric = 0 AND outside > 0"
        rows.append(finding(SCOPE, "target_non_numeric", "non_numeric > 0", "non_numeric", 0, t))
        rows.append(finding(SCOPE, "target_domain", outside, "outside", 0, t))
    for i, c in enumerate(c for c in cfg.ranges if c in df.columns):
        found = _range_aggs(df, c, cfg)
        aggs |= {f"{code}{i}": e for code, e in found.items()}
        bounds = dict(zip(("below_min", "above_max"), cfg.ranges[c], strict=True))
        for code in found:
            # A column with unreadable values is not judged against its bounds.
            n, bound = f"{code}{i}", 0
            if code in bounds:
                n, bound = f"CASE WHEN non_numeric{i} = 0 THEN {n} END", bounds[code]
            rows.append(finding(SCOPE, code, f"{n} > 0", n, bound, c))
    out = to_rows(aggregate(df, aggs), rows)
    if cfg.id_column in df.columns:
        out = out.unionByName(_duplicates(df, cfg, SCOPE, cfg.max_duplicates))
    if fail_fast:
        raise_on(out, DataValidationError)
    return out


def _duplicates(df: DataFrame, cfg: Config, scope: str, allowed: int) -> DataFrame:
    row = finding(
        scope, "duplicate_ids", f"duplicates > {allowed}", "duplicates", allowed, cfg.id_column
    )
    return to_rows(duplicate_count(df, cfg.id_column), [row])


# Order in which the checks are listed in an error.
_ORDER = (
    "required_column",
    "missing_values",
    "duplicate_ids",
    "target_non_numeric",
    "target_domain",
    "non_numeric",
    "below_min",
    "above_max",
)


def raise_on(findings: DataFrame, error: type[Exception]) -> None:
    """Raise when anything fired. The table has a few rows per configured column."""
    fired = findings.where("fired").collect()
    if not fired:
        return
    rank = {c: i for i, c in enumerate(_ORDER)}
    fired.sort(key=lambda r: rank.get(r["code"], len(rank)))
    parts = []
    for r in fired:
        count = "" if r["value"] is None else f": {r['value']:g} (bound {r['bound']:g})"
        parts.append(f"{r['code']} in {r['column']}{count}")
    raise error("; ".join(parts))


def validation_summary(findings: DataFrame, df: DataFrame) -> DataFrame:
    """One row: passed, error count, row count, column count."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    return findings.agg(
        F.expr("count_if(fired) = 0 AS passed"), F.expr("count_if(fired) AS errors")
    ).select(
        "passed", "errors", rows.alias("row_count"), F.lit(len(df.columns)).alias("column_count")
    )


def upload_profile(df: DataFrame, cfg: Config, require_target: bool = False) -> DataFrame:
    """Light checks for an uploaded table: columns, emptiness, duplicates, target."""
    t, scope = cfg.target_column, "upload"
    rows = [
        finding(scope, "required_column", c not in df.columns, column=c)
        for c in cfg.required_columns(require_target)
    ]
    aggs = {"rows": "count(*)"}
    rows.append(finding(scope, "empty", "rows = 0", "rows", 1))
    if require_target and t in df.columns:
        aggs["bad"] = f"count_if(({num(df.schema, t)}) IS NULL)"
        rows.append(finding(scope, "target_non_numeric", "bad > 0", "bad", 0, t))
    out = to_rows(aggregate(df, aggs), rows)
    if cfg.id_column in df.columns:
        out = out.unionByName(_duplicates(df, cfg, scope, 0))
    return out


def category_counts(df: DataFrame, columns: list[str], fill: bool = True) -> DataFrame:
    """(feature, value, n): rows per value of several columns in one shuffle.

    Counts are combined before the shuffle, so a value held by a third of the rows sends
    one row per task. With `fill` missing counts as UNKNOWN, otherwise as null.
    """
    values = {
        c: filled(c) if fill else f"CAST({quoted(c)} AS STRING)"
        for c in columns
        if c in df.columns
    }
    if not values:
        return df.sparkSession.createDataFrame([], "feature string, value string, n long")
    long = unpivot(df, [], values, "feature", "value")
    return long.groupBy("feature", "value").agg(F.expr("count(*) AS n"))
