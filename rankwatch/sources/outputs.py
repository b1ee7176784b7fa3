"""Writing and re-reading scored batches, report tables and model bundles."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwatch.operators.levels import moved, tables_of
from rankwatch.operators.model import Bundle


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_scored(
    scored: DataFrame, summary: DataFrame, path: str, summary_path: str, fmt: str = "parquet"
) -> None:
    """Scored rows and their one-row summary. Files carry no order; `review_rank` does."""
    _write(scored, path, fmt)
    _write(summary, summary_path, fmt)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    writer.format(fmt).save(path)


def read_scored(
    spark: SparkSession, path: str, fmt: str = "parquet", line_breaks: bool = False
) -> DataFrame:
    """A scored batch; CSV columns come back with the types they were written with."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    raw = spark.read.options(header=True, quote='"', escape='"', multiLine=line_breaks).csv(path)
    kinds = {
        "churn_probability": "double",
        "predicted_label": "int",
        "review_rank": "long",
        "review_queue_flag": "boolean",
    }
    return raw.withColumns({c: F.col(c).try_cast(t) for c, t in kinds.items() if c in raw.columns})


def write_report(report: DataFrame, path: str) -> None:
    """A long report table (section, item, metric, value, detail)."""
    report.write.mode("overwrite").parquet(path)


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


def write_tables(tables: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """Write each table under `path` and return what was written."""
    out = {}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
        out[name] = table.sparkSession.read.parquet(f"{path}/{name}")
    return out


def save_bundle(bundle: Bundle, path: str) -> None:
    """Fitted stages, one metadata row and the two reference tables under one folder."""
    spark = bundle.ref_numeric.sparkSession
    model = bundle.model
    for table in tables_of(model):
        spark.read.parquet(table).write.mode("overwrite").parquet(f"{path}/levels")
        model = moved(model, f"{path}/levels")
    model.write().overwrite().save(f"{path}/model")
    meta = spark.createDataFrame([(json.dumps(bundle.meta),)], "meta string")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    bundle.ref_numeric.write.mode("overwrite").parquet(f"{path}/ref_numeric")
    bundle.ref_categorical.write.mode("overwrite").parquet(f"{path}/ref_categorical")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    if not exists(spark, path):
        raise FileNotFoundError(f"model bundle does not exist: {path}")
    return Bundle(
        # The folder may have been moved since.
        moved(PipelineModel.load(f"{path}/model"), f"{path}/levels"),
        json.loads(spark.read.parquet(f"{path}/meta").first()["meta"]),
        spark.read.parquet(f"{path}/ref_numeric"),
        spark.read.parquet(f"{path}/ref_categorical"),
    )
