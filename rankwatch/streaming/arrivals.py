"""Scoring and monitoring report files as they arrive.

Each arriving file is a batch of its own, as with a scheduled run: ranking and drift are
statements about a batch, not about the whole stream. The file source remembers what it has
seen in its checkpoint; a batch that is repeated after a failure overwrites its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rankwatch.config import Config
from rankwatch.functions.values import tokens_to_null
from rankwatch.operators.model import Bundle
from rankwatch.operators.quality import DataValidationError, raise_on, validate
from rankwatch.plans.runs import drift_report, monitor, score_batch
from rankwatch.sources.outputs import load_bundle, write_report, write_scored
from rankwatch.sources.snapshot import typed
from rankwatch.sources.staging import stage, staging


def arriving(
    spark: SparkSession, folder: str, cfg: Config, files_per_batch: int = 1
) -> DataFrame:
    """A stream of raw text rows from CSV files with a header in the configured order."""
    columns = cfg.required_columns(require_target=False)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (
        spark.readStream.schema(schema)
        .options(header=True, quote='"', escape='"', enforceSchema=False)
        .option("multiLine", cfg.csv_line_breaks)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return raw.selectExpr(*[tokens_to_null(c) for c in columns])


def handle_batch(
    raw: DataFrame, batch_id: int, bundle: Bundle, cfg: Config, out: str, reject: bool
) -> None:
    """Validate, score, rank and compare one batch; write everything under its number."""
    with staging(raw.sparkSession):
        # The raw rows are read by several jobs; a staged copy can not change between them.
        _handle(stage(raw, "arrived"), batch_id, bundle, cfg, out, reject)


def _handle(
    raw: DataFrame, batch_id: int, bundle: Bundle, cfg: Config, out: str, reject: bool
) -> None:
    folder = f"batch={batch_id:09d}"
    findings = validate(raw, cfg, require_target=False)
    try:
        raise_on(findings, DataValidationError)
    except DataValidationError:
        if not reject:
            raise
        findings.where("fired").write.mode("overwrite").parquet(f"{out}/rejected/{folder}")
        return
    batch = typed(raw, cfg)
    scored, summary = score_batch(batch, bundle, cfg)
    summary = stage(summary, "summary")
    write_scored(scored, summary, f"{out}/scored/{folder}", f"{out}/summary/{folder}")
    tables = monitor(batch, bundle, summary, cfg)
    write_report(drift_report(tables), f"{out}/drift/{folder}")


def score_arrivals(
    spark: SparkSession,
    folder: str,
    bundle_path: str,
    cfg: Config,
    out: str,
    checkpoint: str,
    reject: bool = False,
    files_per_batch: int = 1,
) -> StreamingQuery:
    """Handle every file present and stop; run it again (or on a schedule) for new ones.

    With `reject` an invalid batch is set aside with its findings instead of stopping the run.
    """
    bundle = load_bundle(spark, bundle_path)

    def each(raw: DataFrame, batch_id: int) -> None:
        handle_batch(raw, batch_id, bundle, cfg, out, reject)

    return (
        arriving(spark, folder, cfg, files_per_batch)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
