"""Where scored rows come from: content hashes, model versions and run records.

A content hash says whether two tables hold the same rows, in whatever order, files or
partitions: every row is hashed on its own and the hashes are summed. It costs one scan and one
aggregate row.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwatch.functions.values import quoted
from rankwatch.operators.model import Bundle

SOURCE_FILE = "source_file"
# What every scored row carries of its run.
STAMP = ("run_id", "model_version", "input_hash", "scored_at")


def _field(name: str) -> str:
    """A value with its length in front, so neighbouring fields can not be mixed up; null is `-`."""
    value = f"CAST({quoted(name)} AS STRING)"
    return f"coalesce(concat(octet_length({value}), ':', {value}), '-')"


def row_hash(columns: Iterable[str]) -> str:
    """60 bits of the MD5 of a row's fields, as a decimal whose sums do not overflow."""
    fields = ", ".join(_field(c) for c in columns)
    return f"CAST(conv(substr(md5(concat('', {fields})), 1, 15), 16, 10) AS DECIMAL(28, 0))"


def content_hash(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(rows, columns, content_hash) of a table; columns are taken by name, in order of the name."""
    names = sorted(columns if columns is not None else df.columns)
    total = f"CAST(coalesce(sum({row_hash(names)}), 0) AS STRING)"
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(",".join(names)).alias("columns"), F.expr(total).alias("content_hash")
    )


def model_version(bundle: Bundle) -> str:
    """A digest of what the model computes and was fitted on: its facts, learned statements,
    coefficients and reference profile; the same after saving and loading, wherever it lies."""
    parts = [json.dumps({k: v for k, v in bundle.meta.items() if k != "model_version"}, sort_keys=True)]
    for stage in _stages(bundle.model):
        parts.append(type(stage).__name__)
        if isinstance(stage, SQLTransformer):
            parts.append(stage.getStatement().split("FROM parquet.")[0])
        if hasattr(stage, "labels"):
            parts.append(json.dumps(list(stage.labels)))
        if hasattr(stage, "coefficients"):
            parts.append(json.dumps([float(x) for x in stage.coefficients] + [float(stage.intercept)]))
        if hasattr(stage, "toDebugString"):
            parts.append(stage.toDebugString.split("\n", 1)[1])
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]


def _stages(model: PipelineModel):
    for stage in model.stages:
        yield from _stages(stage) if isinstance(stage, PipelineModel) else (stage,)


@dataclass(frozen=True)
class Run:
    """One scoring run: what was read, with which model, when."""

    run_id: str
    input_path: str
    input_rows: int
    input_hash: str
    model_name: str
    model_version: str
    scored_at: str

    def table(self, spark: SparkSession) -> DataFrame:
        own = asdict(self)
        schema = ", ".join(f"{c} {'long' if c == 'input_rows' else 'string'}" for c in own)
        return spark.createDataFrame([tuple(own.values())], schema)


def describe_run(
    batch: DataFrame, bundle: Bundle, input_path: str, run_id: str | None = None, scored_at: str | None = None
) -> Run:
    """The record of scoring `batch`, hashed as it is (without the file each row came from)."""
    found = content_hash(batch, [c for c in batch.columns if c != SOURCE_FILE]).first()
    now = scored_at or dt.datetime.now(dt.UTC).isoformat(timespec="seconds")
    return Run(
        run_id or uuid.uuid4().hex, input_path, found["rows"], found["content_hash"],
        bundle.meta["model_name"], model_version(bundle), now,
    )


def stamp(scored: DataFrame, run: Run) -> DataFrame:
    """Scored rows with the columns of `STAMP`: literals, no join."""
    return scored.withColumns({c: F.lit(getattr(run, c)) for c in STAMP})


def unlike(scored: DataFrame, run: Run) -> DataFrame:
    """(column, rows): how many scored rows do not carry what the run's record says."""
    odd = [
        F.struct(F.lit(c).alias("column"), F.count_if(~F.col(c).eqNullSafe(F.lit(getattr(run, c)))).alias("rows"))
        for c in STAMP
    ]
    return scored.agg(F.array(*odd).alias("found")).select(F.inline("found"))
