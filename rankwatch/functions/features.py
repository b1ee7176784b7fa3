"""Derived-feature expressions as SQL text."""

from __future__ import annotations

from pyspark.sql import types as T

from rankwatch.config import Config
from rankwatch.functions.values import at_least, day, num, quoted, text


def tenure(schema: T.StructType, cfg: Config, reference: str) -> str:
    """Whole days from the column to midnight of `reference`, rounded down."""
    value = day(schema, cfg.date_column, cfg.date_format)
    kind = schema[cfg.date_column].dataType
    days = f"datediff({reference}, to_date({value}))"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        part_day = f"CAST({value} > CAST(to_date({value}) AS {kind.simpleString()}) AS INT)"
        days = f"{days} - {part_day}"
    return f"CAST({days} AS BIGINT)"


def ticket_flag(schema: T.StructType, cfg: Config) -> str:
    return f"CAST({at_least(num(schema, cfg.ticket_column), cfg.ticket_threshold)} AS INT)"


def text_features(cfg: Config) -> dict[str, str]:
    """Length in characters and one case-insensitive literal match per keyword."""
    value = f"coalesce({quoted(cfg.text_column)}, '')"
    out = {cfg.length_column: f"char_length({value})"}
    for word, column in zip(cfg.keywords, cfg.keyword_columns, strict=True):
        out[column] = f"CAST(contains(lower({value}), {text(word.lower())}) AS INT)"
    return out


def derived(schema: T.StructType, cfg: Config, reference: str) -> dict[str, str]:
    """All derived columns in model order: tenure, ticket flag, length, keyword flags."""
    return {
        cfg.tenure_column: tenure(schema, cfg, reference),
        cfg.ticket_flag_column: ticket_flag(schema, cfg),
        **text_features(cfg),
    }
