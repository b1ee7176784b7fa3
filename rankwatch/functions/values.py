"""Null, number, date and band expressions shared by every operator.

Expressions are SQL text. The same text serves DataFrame operators (`F.expr`) and persisted
`SQLTransformer` stages, and building a plan of hundreds of checks stays cheap.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import types as T

# Strings a CSV reader treats as missing.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# Fixed value: what counts as a number. A bare cast would also take '1d' and '1f'.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
UNKNOWN = "UNKNOWN"
# Band edges and labels.
AGE_EDGES = (0, 24, 34, 44, 54, 120)
AGE_LABELS = ("18-24", "25-34", "35-44", "45-54", "55+")
TICKET_EDGES = (-1, 0, 1, 2, 100)
TICKET_LABELS = ("0", "1", "2", "3+")
# Drift limits.
SIGNIFICANT_SHIFT, SIGNIFICANT_MISSING = 0.5, 0.1
MODERATE_SHIFT, MODERATE_MISSING = 0.2, 0.05

_FRACTIONAL = (T.FloatType, T.DoubleType)


# ---- literals and names -----------------------------------------------------------


def quoted(name: str) -> str:
    """Column reference that survives dots and blanks in names."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float | None) -> str:
    """A DOUBLE literal; a bare 0.1 would be a DECIMAL in Spark SQL."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if not math.isfinite(value):
        return f"CAST('{float(value)}' AS DOUBLE)"
    return f"{float(value)!r}D"


# ---- coercion ---------------------------------------------------------------------


def missing(schema: T.StructType, name: str) -> str:
    """True for null and, on fractional columns, NaN."""
    c = quoted(name)
    if isinstance(schema[name].dataType, _FRACTIONAL):
        return f"({c} IS NULL OR isnan({c}))"
    return f"({c} IS NULL)"


def num(schema: T.StructType, name: str) -> str:
    """The column as double; anything that is not a number becomes null."""
    c, kind = quoted(name), schema[name].dataType
    if isinstance(kind, _FRACTIONAL):
        return f"CASE WHEN NOT isnan({c}) THEN CAST({c} AS DOUBLE) END"
    if isinstance(kind, T.StringType):
        return f"CASE WHEN {c} RLIKE r'{NUMBER}' THEN TRY_CAST({c} AS DOUBLE) END"
    if isinstance(kind, T.BooleanType):
        return f"CAST(CAST({c} AS INT) AS DOUBLE)"
    if isinstance(kind, T.NumericType):
        return f"CAST({c} AS DOUBLE)"
    return double(None)


def key(schema: T.StructType, name: str) -> str:
    """An id for comparison: missing is null, and '01' in a text column is the number 1."""
    c = quoted(name)
    if isinstance(schema[name].dataType, T.StringType):
        return f"coalesce(CAST(TRY_CAST({c} AS BIGINT) AS STRING), {c})"
    return f"CASE WHEN NOT {missing(schema, name)} THEN {c} END"


def day(schema: T.StructType, name: str, fmt: str) -> str:
    """The column as a date or time stamp; strings that do not parse become null."""
    c = quoted(name)
    if isinstance(schema[name].dataType, T.StringType):
        return f"to_date(try_to_timestamp({c}, {text(fmt)}))"
    return c


def tokens_to_null(name: str) -> str:
    c = quoted(name)
    listed = ", ".join(text(t) for t in NULL_TOKENS)
    return f"CASE WHEN {c} NOT IN ({listed}) THEN {c} END AS {c}"


def filled(name: str) -> str:
    return f"coalesce(CAST({quoted(name)} AS STRING), '{UNKNOWN}')"


# ---- arithmetic and bands ---------------------------------------------------------


def ratio(part: str, whole: str) -> str:
    """part / whole as double, 0 when the denominator is zero or missing."""
    return f"coalesce(try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE)), 0D)"


def at_least(value: str, threshold: float) -> str:
    """value >= threshold with missing (or NaN) as false."""
    return f"coalesce(NOT isnan({value}) AND {value} >= {double(threshold)}, false)"


def band(value: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    """Right-closed intervals, the lowest edge included; outside or missing is UNKNOWN."""
    steps = "".join(
        f" WHEN {value} <= {double(edge)} THEN {text(label)}"
        for edge, label in zip(edges[1:], labels, strict=True)
    )
    return (
        f"CASE WHEN {value} IS NULL OR {value} < {double(edges[0])} THEN '{UNKNOWN}'"
        f"{steps} ELSE '{UNKNOWN}' END"
    )


def age_band(value: str) -> str:
    return band(value, AGE_EDGES, AGE_LABELS)


def ticket_band(value: str) -> str:
    return band(value, TICKET_EDGES, TICKET_LABELS)


def risk_band(probability: str, high: float, medium: float) -> str:
    return (
        f"CASE WHEN {at_least(probability, high)} THEN 'high'"
        f" WHEN {at_least(probability, medium)} THEN 'medium' ELSE 'low' END"
    )


def drift_status(shift: str, missing_shift: str) -> str:
    a, b = f"coalesce(abs({shift}), 0D)", f"coalesce(abs({missing_shift}), 0D)"
    return (
        f"CASE WHEN {shift} IS NULL AND {missing_shift} IS NULL THEN 'unknown'"
        f" WHEN {a} > {double(SIGNIFICANT_SHIFT)} OR {b} > {double(SIGNIFICANT_MISSING)}"
        " THEN 'significant'"
        f" WHEN {a} > {double(MODERATE_SHIFT)} OR {b} > {double(MODERATE_MISSING)}"
        " THEN 'moderate' ELSE 'stable' END"
    )
