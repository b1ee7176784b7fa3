"""Reading tables and writing intermediate tables where every executor finds them."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Staged tables belong to the process and to the scopes that are open (`staging`), which drop them.
from rankwatch.sources.staging import drop_staged, shared_dir, stage, staging

__all__ = [
    "byte_batches", "connected", "drop_finished", "drop_staged", "give_back", "lookup", "numbered", "row_key", "rows_in_parts", "shared_dir",
    "small_batches", "stage", "staging", "table", "tidy",
]

# A key with more than this share of the rows is looked up in a broadcast; there are at most as many.
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """A 64-bit key of some columns, never null. xxhash64 passes over nulls, so which columns
    are null is hashed beside the values."""
    return F.xxhash64(*[c for name in columns for c in (F.col(name).isNull(), F.col(name))])


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Whole texts travel to Python in batches of few rows and few bytes: a batch stands in the
    memory of the JVM and of the worker at the same time, beside what either has kept."""
    byte_batches(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= rows:
        spark.conf.set(name, str(rows))


def rows_in_parts(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partitions for `rows` of about equal cost, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))


def byte_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Arrow batches of at most `most` bytes (or one row): a batch stands in the memory of the
    JVM and of the worker at once, however long its texts or vectors are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now > most:
        spark.conf.set(name, f"{most}b")


def give_back() -> None:
    """Return to the system what this worker has freed: workers live on, idle, beside the next
    stage's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A `mapInArrow` function that gives back what its task has freed when it ends."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def drop_finished(spark: SparkSession) -> None:
    """Let Spark drop what finished phases left: shuffle files, broadcasts and plans go when the
    driver collects its garbage, which it otherwise puts off while its heap can still grow."""
    spark.sparkContext._jvm.System.gc()


def numbered(
    rows: DataFrame, part: str, cells: int, order: list[Column], out: str, most: int
) -> DataFrame:
    """Add to every row a number in its `part`, gapless from 0; the same on every run.

    Rows go to cells by a hash of their values, are numbered inside cells, and cells follow one
    another. Rows equal in everything are counted before they move and written out again
    afterwards, in stretches of `most` rows that are tasks of their own where there are more: so
    copies of one row, however many, do not meet in one task."""
    kept = [F.col(f"`{c}`") for c in rows.columns]
    cell = F.pmod(F.xxhash64(*kept), F.lit(cells)).alias("_cell")
    distinct = rows.groupBy(*kept, cell).agg(F.count(F.lit(1)).alias("_n"))
    sizes = rows.select(F.col(f"`{part}`"), cell).groupBy(part, "_cell").agg(F.count(F.lit(1)).alias("_m"))
    earlier = Window.partitionBy(part).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, "_cell", F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_before"))
    inside = (
        Window.partitionBy(part, "_cell").orderBy(*order, *kept).rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    begun = distinct.join(offsets, [part, "_cell"]).withColumn("_first", first).select(*kept, "_n", "_first")
    few = begun.where(F.col("_n") <= most).withColumn("_from", F.lit(0).cast("long"))
    many = begun.where(F.col("_n") > most).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(most).cast("long")))
    )
    # A stated number: a few stretches look too small to be worth tasks of their own.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = few.unionByName(many.repartition(tasks, "_first", "_from"))
    last = F.least(F.col("_from") + most, F.col("_n")) - 1
    copies = both.withColumn("_copy", F.explode(F.sequence("_from", last)))
    return copies.select(*kept, (F.col("_first") + F.col("_copy")).cast("long").alias(out))


def lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of staged `rows` with `table`, which has one row per key.

    A key that holds a large part of the rows would send them all to one task. Keys with more
    than one in HOT_KEYS of the rows, so fewer than HOT_KEYS of them, are joined by a broadcast
    of their rows of `table`; all others by a shuffle."""
    total = rows.count()
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") * HOT_KEYS > total).select(*keys)
    hot = stage(hot, "hot-keys")
    if not hot.limit(1).count():
        return rows.join(table, keys)
    few = F.broadcast(stage(table.join(F.broadcast(hot), keys, "left_semi"), "hot-rows"))
    rest = rows.join(F.broadcast(hot), keys, "left_anti").join(table, keys)
    return rows.join(few, keys).unionByName(rest)


def connected(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from every node of `links` (a, b).

    A round takes the smallest label next door and then that label's label, so the rounds grow
    with the logarithm of a component's diameter; each is written out. Nodes with very many
    links and labels of very large components are looked up in broadcasts of bounded size."""
    both = links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
        links.select(F.col("b").alias("x"), F.col("a").alias("y"))
    )
    both = stage(both.where("x != y").distinct(), "links")
    nearest = both.groupBy("x").agg(F.min("y").alias("m"))
    labels = stage(nearest.select(F.col("x").alias("node"), F.least("x", "m").alias("label")), "labels")
    while True:
        known = labels.select(F.col("node").alias("y"), F.col("label").alias("l"))
        near = lookup(both, known, ["y"]).groupBy("x").agg(F.min("l").alias("l")).withColumnRenamed("x", "node")
        hooked = labels.join(near, "node").select("node", F.least("label", "l").alias("label"), F.col("label").alias("old"))
        hooked = stage(hooked, "hooked")
        over = hooked.select(F.col("node").alias("label"), F.col("label").alias("over"))
        jumped = lookup(hooked, over, ["label"]).select(
            "node", F.col("over").alias("label"), (F.col("over") != F.col("old")).alias("moved")
        )
        jumped = stage(jumped, "labels")
        labels = jumped.select("node", "label")
        if not jumped.where("moved").limit(1).count():
            return labels
