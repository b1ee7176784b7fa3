"""Materialising an expensive input once, in storage every executor can reach."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_RUN = uuid.uuid4().hex[:12]
_scopes = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data; where it names none, a folder
    beside the session's tables, which all executors reach as well."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under this process's folder in the shared one."""
    return f"{shared_dir(spark)}/rankwatch-{_RUN}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back.

    Used where an operator needs several passes over a costly input: later passes read
    only their own columns from Parquet, a lost executor costs a re-read instead of the
    whole lineage, and values can not change between passes.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stage_path(df, label))


def stage_path(df: DataFrame, label: str) -> str:
    """Write `df` like `stage` and return where it lies."""
    path = fresh_path(df.sparkSession, label)
    for paths in getattr(_scopes, "open", ()):
        paths.append(path)
    df.write.parquet(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is dropped at the end, also after an error. Results must have been
    written by then."""
    paths: list[str] = []
    _scopes.open = [*getattr(_scopes, "open", ()), paths]
    try:
        yield
    finally:
        _scopes.open = _scopes.open[:-1]
        for path in paths:
            _delete(spark, path)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this process staged; call when its result tables are written."""
    _delete(spark, f"{shared_dir(spark)}/rankwatch-{_RUN}")
