"""Fitted preprocessing: median / mode imputation, population scaling, one-hot."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwatch.config import Config
from rankwatch.functions.features import derived
from rankwatch.functions.rows import aggregate
from rankwatch.functions.values import day, double, num, quoted, text
from rankwatch.operators.levels import (
    LEVEL, MOST_LABELS, ONE_HOT, fit_encoder, fit_indexers, labels_of, level_counts, modes_and_sizes,
)
from rankwatch.operators.ordering import DIRECT_ROWS, medians
from rankwatch.sources.staging import stage

SCALED = "__z"
FEATURES = "features"


@dataclass(frozen=True)
class NumericFit:
    """What one numeric column learned: fill value, then mean and spread of filled values."""

    median: float
    mean: float
    std: float


def fit_numeric(
    df: DataFrame, cfg: Config, direct_rows: int = DIRECT_ROWS
) -> dict[str, NumericFit]:
    """One pass for counts and moments, one or more narrow passes for exact medians.

    Scaling is learned on the filled column; its moments follow from the moments of the
    present values and the number of fills, so the table is not read again.
    """
    values = {c: num(df.schema, c) for c in cfg.model_numeric}
    aggs = {"rows": "count(*)"}
    for c, v in values.items():
        aggs |= {f"{c}|n": f"count({v})", f"{c}|mean": f"avg({v})", f"{c}|var": f"var_pop({v})"}
    row = aggregate(df, aggs).first()
    mid = medians(
        df,
        {c: F.expr(v) for c, v in values.items()},
        {c: row[f"{c}|n"] for c in values},
        direct_rows,
    )
    out = {}
    for c in values:
        n, total = row[f"{c}|n"], row["rows"]
        if n == 0:
            out[c] = NumericFit(0.0, 0.0, 0.0)
            continue
        fills, m = total - n, mid[c]
        mean = (n * row[f"{c}|mean"] + fills * m) / total
        square = n * (row[f"{c}|var"] + (row[f"{c}|mean"] - mean) ** 2) + fills * (m - mean) ** 2
        out[c] = NumericFit(m, mean, math.sqrt(square / total))
    return out


def learn_categories(
    df: DataFrame, cfg: Config
) -> tuple[dict[str, list[str]], dict[str, str]]:
    """(sorted levels, most frequent level) per column as Python lists, for a caller who wants to
    look at them; fitting does not come here."""
    counts = level_counts(df, cfg.categorical)
    learned = modes_and_sizes(counts)
    return {c: [] for c in cfg.categorical} | labels_of(counts), {c: mode for c, (mode, _) in learned.items()}


def derive_stage(
    schema: T.StructType, cfg: Config, reference_date: str | None = None
) -> SQLTransformer:
    """Derived columns as a persistable stage; without a date each batch uses its own latest."""
    value = day(schema, cfg.date_column, cfg.date_format)
    reference = (
        f"(SELECT to_date(max({value})) FROM __THIS__)"
        if reference_date is None
        else f"DATE {text(str(reference_date)[:10])}"
    )
    cols = [f"{e} AS {quoted(c)}" for c, e in derived(schema, cfg, reference).items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def scale_sql(schema: T.StructType, name: str, fit: NumericFit) -> str:
    if fit.std == 0:
        return "0D"
    v = f"coalesce({num(schema, name)}, {double(fit.median)})"
    return f"({v} - {double(fit.mean)}) / {double(fit.std)}"


def fill_stage(
    schema: T.StructType, cfg: Config, numeric: Mapping[str, NumericFit], modes: Mapping[str, str]
) -> SQLTransformer:
    """Impute and scale the fitted columns by learned literals; scoring needs no other state."""
    cols = [
        f"{scale_sql(schema, c, numeric[c])} AS {quoted(c + SCALED)}" for c in cfg.model_numeric if c in numeric
    ]
    for c in cfg.categorical:
        value = f"CAST({quoted(c)} AS STRING)"
        if c in modes:
            value = f"coalesce({value}, {text(modes[c])})"
        cols.append(f"{value} AS {quoted(c + LEVEL)}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def derived_frame(df: DataFrame, cfg: Config, derive: SQLTransformer) -> DataFrame:
    """`df` with derived columns and without the raw text and date they came from, staged.

    Fitting passes over its input many times; this way the text is read once.
    """
    out = derive.transform(df).drop(cfg.text_column, cfg.date_column)
    return stage(out, "derived")


def fit_levels(
    base: DataFrame, cfg: Config, numeric: Mapping[str, NumericFit], most_labels: int = MOST_LABELS
) -> tuple[list[Transformer], list[str]]:
    """Stages that fill, scale and encode, and the columns encoded (those with a level)."""
    counts = level_counts(base, cfg.categorical)
    learned = modes_and_sizes(counts)
    fill = fill_stage(base.schema, cfg, numeric, {c: mode for c, (mode, _) in learned.items()})
    kept = [c for c in cfg.categorical if c in learned]
    if not kept:
        return [fill], kept
    indexers = fit_indexers(counts, {c: learned[c][1] for c in kept}, most_labels)
    return [fill, *indexers, fit_encoder(indexers, fill.transform(base), kept)], kept


def fit_prep(
    train: DataFrame,
    cfg: Config,
    reference_date: str | None = None,
    direct_rows: int = DIRECT_ROWS,
    most_labels: int = MOST_LABELS,
) -> tuple[PipelineModel, DataFrame]:
    """Learn imputation, scaling and levels on the given rows.

    Returns the stages and the given rows already prepared. Unknown and missing levels fall
    in the index slot the encoder drops: all zeros. More than `most_labels` levels are joined
    from a stored table.
    """
    derive = derive_stage(train.schema, cfg, reference_date)
    base = derived_frame(train, cfg, derive)
    stages, kept = fit_levels(base, cfg, fit_numeric(base, cfg, direct_rows), most_labels)
    assemble = VectorAssembler(
        inputCols=[c + SCALED for c in cfg.model_numeric] + [c + ONE_HOT for c in kept], outputCol=FEATURES
    )
    return PipelineModel([derive, *stages, assemble]), PipelineModel([*stages, assemble]).transform(base)
