"""Turning one-row aggregates into long report tables. All values are SQL text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.functions.values import double, quoted, text

Fields = Sequence[tuple[str, str]]
FINDING_FIELDS: Fields = (
    ("scope", "string"),
    ("code", "string"),
    ("column", "string"),
    ("fired", "boolean"),
    ("value", "double"),
    ("bound", "double"),
    ("detail", "string"),
)


def aggregate(df: DataFrame, named: Mapping[str, str]) -> DataFrame:
    """One row with the given SQL aggregates."""
    return df.agg(*[F.expr(f"{e} AS {quoted(n)}") for n, e in named.items()])


def inline(rows: Iterable[Mapping[str, str]], fields: Fields) -> str:
    """`inline(array(struct...))` with the fields cast; a missing entry is null."""
    structs = [
        "named_struct("
        + ", ".join(f"{text(n)}, CAST({r.get(n, 'NULL')} AS {t})" for n, t in fields)
        + ")"
        for r in rows
    ]
    return f"inline(array({', '.join(structs)}))"


def to_rows(
    one_row: DataFrame, rows: Iterable[Mapping[str, str]], fields: Fields = FINDING_FIELDS
) -> DataFrame:
    """Expand each row of an aggregate into the given rows."""
    rows = list(rows)
    if not rows:
        schema = ", ".join(f"{quoted(n)} {t}" for n, t in fields)
        return one_row.sparkSession.createDataFrame([], schema)
    return one_row.selectExpr(inline(rows, fields))


def finding(
    scope: str,
    code: str,
    fired: str | bool,
    value: str | None = None,
    bound: str | float | None = None,
    column: str | None = None,
) -> dict[str, str]:
    """A finding row: `fired`, `value` and `bound` may be SQL text over the aggregate."""
    return {
        "scope": text(scope),
        "code": text(code),
        "column": text(column),
        "fired": str(fired).lower() if isinstance(fired, bool) else f"coalesce({fired}, false)",
        "value": "NULL" if value is None else value,
        "bound": bound if isinstance(bound, str) else double(bound),
    }


def unpivot(
    df: DataFrame, keep: Iterable[str], values: Mapping[str, str], name: str, value: str
) -> DataFrame:
    """Long form (keep..., name, value) with one output row per entry of `values`.

    A narrow projection below the generator, so only the named columns are read.
    """
    rows = [{name: text(k), value: v} for k, v in values.items()]
    return df.selectExpr(*keep, inline(rows, ((name, "string"), (value, "string"))))
