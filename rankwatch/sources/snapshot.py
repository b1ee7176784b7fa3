"""Reading customer snapshots: raw strings in, checked and typed table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwatch.config import Config
from rankwatch.functions.values import day, num, quoted, tokens_to_null
from rankwatch.operators.quality import validate


def read_csv(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """Every column as text, null tokens as null.

    Types are not inferred: inference reads the data twice and would turn a bad number into
    a text column before it can be counted. A byte-order mark is dropped by the reader.
    With `line_breaks` quoted fields may hold line breaks, which makes a file one task; without,
    large files are split. Columns are matched by the header of each file, which fails when
    the files of a folder disagree.
    """
    reader = spark.read.options(
        header=True, quote='"', escape='"', multiLine=line_breaks, enforceSchema=False
    )
    names = spark.read.options(header=True, quote='"', escape='"').csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = reader.schema(schema).csv(path)
    return raw.selectExpr(*[tokens_to_null(c) for c in raw.columns])


def read_table(spark: SparkSession, path: str, cfg: Config, fmt: str = "csv") -> DataFrame:
    """A snapshot in any format the session can read; only CSV needs the text treatment."""
    if fmt == "csv":
        return read_csv(spark, path, cfg.csv_line_breaks)
    return spark.read.format(fmt).load(path)


def typed(df: DataFrame, cfg: Config) -> DataFrame:
    """Cast the configured roles; everything else keeps its type."""
    casts = {c: num(df.schema, c) for c in cfg.numeric if c in df.columns}
    idc, t, d = cfg.id_column, cfg.target_column, cfg.date_column
    if t in df.columns:
        casts[t] = f"CAST({num(df.schema, t)} AS INT)"
    if d in df.columns:
        casts[d] = day(df.schema, d, cfg.date_format)
    if idc in df.columns and isinstance(df.schema[idc].dataType, T.StringType):
        # An id that is not of the configured type is an error, not a missing id.
        casts[idc] = f"CAST({quoted(idc)} AS {cfg.id_type})"
    return df.withColumns({c: F.expr(e) for c, e in casts.items()})


def load_snapshot(
    spark: SparkSession,
    path: str,
    cfg: Config,
    require_target: bool = True,
    fmt: str = "csv",
) -> DataFrame:
    """Read, validate (raises on the first failing table) and type a snapshot."""
    raw = read_table(spark, path, cfg, fmt)
    validate(raw, cfg, require_target=require_target, fail_fast=True)
    return typed(raw, cfg)


def read_upload(spark: SparkSession, path: str | None) -> DataFrame:
    """An uploaded CSV file; no file is an error."""
    if not path:
        raise ValueError("no CSV file was uploaded")
    return read_csv(spark, path)
