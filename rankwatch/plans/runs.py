"""The five runs a user starts: train, evaluate, score, monitor, profile; and handoff."""

from __future__ import annotations

from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.operators import drift as dr
from rankwatch.operators import lineage as ln
from rankwatch.operators import metrics as mt
from rankwatch.operators import profile as pf
from rankwatch.operators import scoring as sc
from rankwatch.operators import verify as vf
from rankwatch.operators.features import check_features
from rankwatch.operators.model import Bundle, train
from rankwatch.operators.quality import (
    DataValidationError,
    raise_on,
    upload_profile,
    validate,
)
from rankwatch.operators.split import stratified_split
from rankwatch.sources.outputs import (
    load_bundle,
    read_report,
    read_scored,
    save_bundle,
    write_report,
    write_scored,
    write_tables,
)
from rankwatch.sources.snapshot import read_table, read_upload, typed
from rankwatch.sources.staging import stage, staging


def evaluate(scored_test: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """Report tables for test rows that carry labels and `churn_probability`."""
    p = sc.PROBABILITY
    mt.check_rule(scored_test, cfg)
    comparison = stage(mt.metric_comparison(scored_test, cfg, p), "comparison")
    slices = stage(mt.slice_metrics(scored_test, cfg, p), "slices")
    overall = mt.model_metrics(scored_test, cfg, p).withColumn(
        "pr_auc", mt.average_precision(scored_test, cfg, p).scalar()
    )
    return {
        "model_metrics": overall,
        "baseline_metrics": mt.evaluate_rule(scored_test, cfg, strict=False),
        "metric_comparison": comparison,
        "slice_metrics": slices,
        "findings": mt.evaluation_findings(comparison, slices),
    }


def evaluation_report(tables: dict[str, DataFrame]) -> DataFrame:
    items = {
        "slice_metrics": "concat_ws('=', slice_name, slice_value)",
        "findings": "code",
    }
    return vf.report(tables, items)


def score_batch(
    df: DataFrame, bundle: Bundle, cfg: Config, top_k: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(ranked rows, one-row summary). The probability is computed once and staged: ranking
    and summary read it from storage."""
    check_features(df, cfg)
    probable = stage(bundle.predict_proba(df), "probabilities")
    return sc.review_queue(probable, cfg, top_k), sc.batch_summary(probable, cfg, top_k)


def monitor(
    batch: DataFrame, bundle: Bundle, summary: DataFrame, cfg: Config
) -> dict[str, DataFrame]:
    """Drift tables of a scored batch against the bundle's training profile."""
    # The findings are read off the drift tables, so those are computed once.
    facts = stage(dr.batch_facts(batch, cfg), "batch-facts")
    numeric = stage(dr.numeric_drift(batch, bundle.ref_numeric, cfg, facts), "numeric-drift")
    categorical = stage(
        dr.categorical_drift(batch, bundle.ref_categorical, cfg, facts), "categorical-drift"
    )
    prediction = stage(dr.prediction_drift(summary, bundle.meta), "prediction-drift")
    status = dr.drift_status_rows(numeric, categorical)
    return {
        "numeric_drift": numeric,
        "categorical_drift": categorical,
        "prediction_drift": prediction,
        "findings": dr.drift_findings(status, prediction),
    }


def drift_report(tables: dict[str, DataFrame]) -> DataFrame:
    items = {
        "numeric_drift": "feature",
        "categorical_drift": "feature",
        "findings": "code",
    }
    return vf.report(tables, items)


def _snapshot(
    spark: SparkSession, path: str, cfg: Config, target: bool, fmt: str, with_files: bool = False
) -> DataFrame:
    """The checked and typed table, written once: every pass of a run reads that copy. The name
    of each row's file is added on request, and is no column of the table for the checks."""
    raw = read_table(spark, path, cfg, fmt)
    if with_files:
        raw = raw.withColumn(ln.SOURCE_FILE, F.input_file_name())
    table = stage(raw, "snapshot") if fmt == "csv" or with_files else raw
    validate(table.drop(ln.SOURCE_FILE) if with_files else table, cfg, require_target=target, fail_fast=True)
    return typed(table, cfg)


def run_training(spark: SparkSession, path: str, cfg: Config, out: str, fmt: str = "csv") -> Bundle:
    """Load, validate, fit, save the bundle under `out`; returns the saved one."""
    with staging(spark):
        save_bundle(train(_snapshot(spark, path, cfg, True, fmt), cfg), out)
    return load_bundle(spark, out)


def run_evaluation(
    spark: SparkSession, path: str, cfg: Config, out: str, bundle: Bundle | None = None,
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Fit (unless a bundle is given), score the held-out rows, write the report table at `out`
    and the tables it is made of beside it."""
    with staging(spark):
        df = _snapshot(spark, path, cfg, True, fmt)
        bundle = bundle or train(df, cfg)
        held = stratified_split(df, cfg).where(F.col("split") == "test").drop("split")
        scored = stage(bundle.predict_proba(held), "evaluation")
        tables = write_tables(evaluate(scored, cfg), f"{out}.tables")
    write_report(evaluation_report(tables), out)
    return tables


def run_scoring(
    spark: SparkSession, path: str, cfg: Config, bundle_path: str, out: str, summary_out: str,
    top_k: int | None = None, fmt: str = "csv", out_fmt: str = "parquet", run_id: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Score a batch with a saved bundle; writes queue and summary and returns both as written.

    With a `run_id` every row also says which file it came from, which run and model scored it
    when, and the hash of that run's input; the run's record is written at `<summary_out>.run`."""
    bundle = load_bundle(spark, bundle_path)
    with staging(spark):
        batch = _snapshot(spark, path, cfg, False, fmt, run_id is not None)
        scored, summary = score_batch(batch, bundle, cfg, top_k)
        if run_id is not None:
            run = ln.describe_run(batch, bundle, path, run_id)
            scored = ln.stamp(scored, run)
            run.table(spark).write.mode("overwrite").parquet(f"{summary_out}.run")
        return _written((scored, summary), cfg, out, summary_out, out_fmt)


def _written(
    tables: tuple[DataFrame, DataFrame], cfg: Config, out: str, summary_out: str, fmt: str
) -> tuple[DataFrame, DataFrame]:
    scored, summary = tables
    write_scored(scored, summary, out, summary_out, fmt)
    spark = scored.sparkSession
    back = read_scored(spark, out, fmt, cfg.csv_line_breaks)
    one = spark.read.schema(summary.schema).format(fmt).options(header=True).load(summary_out)
    return back, one


def run_upload(
    spark: SparkSession, path: str | None, cfg: Config, bundle_path: str, out: str,
    summary_out: str, top_k: int | None = None, out_fmt: str = "csv",
) -> tuple[DataFrame, DataFrame]:
    """Score an uploaded CSV file after the light upload checks."""
    with staging(spark):
        raw = stage(read_upload(spark, path), "upload")
        raise_on(upload_profile(raw, cfg), DataValidationError)
        bundle = load_bundle(spark, bundle_path)
        tables = score_batch(typed(raw, cfg), bundle, cfg, top_k)
        return _written(tables, cfg, out, summary_out, out_fmt)


def run_monitoring(
    spark: SparkSession, path: str, cfg: Config, bundle_path: str, out: str,
    top_k: int | None = None, fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Score a batch and compare it with the training profile; writes the drift report."""
    bundle = load_bundle(spark, bundle_path)
    with staging(spark):
        batch = _snapshot(spark, path, cfg, False, fmt)
        check_features(batch, cfg)
        summary = stage(sc.batch_summary(bundle.predict_proba(batch), cfg, top_k), "summary")
        tables = write_tables(monitor(batch, bundle, summary, cfg), f"{out}.tables")
    write_report(drift_report(tables), out)
    return tables


def run_profile(
    spark: SparkSession, path: str, cfg: Config, out: str, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Descriptive tables of a labelled snapshot, each written under `out`."""
    with staging(spark):
        return write_tables(pf.profile(_snapshot(spark, path, cfg, True, fmt), cfg), out)


def run_handoff(
    spark: SparkSession,
    bundle_path: str,
    scored_path: str,
    cfg: Config,
    evaluation_path: str | None = None,
    drift_path: str | None = None,
    top_k: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """All check rows on written artifacts; a report that is not given is skipped."""
    checks = []
    try:
        checks.append(vf.verify_bundle(spark, load_bundle(spark, bundle_path)))
    except (FileNotFoundError, ValueError, KeyError, PySparkException, Py4JJavaError) as error:
        # A bundle that is missing or can not be read fails the check.
        checks.append(vf.verify_bundle(spark, None, str(error).split("\n")[0]))
    try:
        checks.append(vf.verify_scored(read_scored(spark, scored_path, fmt, cfg.csv_line_breaks), cfg, top_k))
    except FileNotFoundError as error:
        checks.append(vf.missing_artifact(spark, vf.PREDICTIONS, str(error)))
    wanted: tuple[tuple[str, str | None, tuple[str, ...]], ...] = (
        ("evaluation_report", evaluation_path, vf.EVALUATION_SECTIONS),
        ("drift_report", drift_path, vf.DRIFT_SECTIONS),
    )
    for name, path, sections in wanted:
        if path is None:
            checks.append(vf.skipped(spark, name))
        else:
            checks.append(vf.verify_report(read_report(spark, path), name, sections, spark))
    out: Any = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
