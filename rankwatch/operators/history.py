"""Scores of successive batches: a mergeable sketch per batch, shifts and collapse.

A batch's scores are kept as exact counts of `BINS` bins of equal width with sums beside them. Two
sketches add up to that of both batches, so a history table of sketches answers questions about
any batch, or any run of batches, without their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwatch.functions.rows import FINDING_FIELDS, finding, to_rows
from rankwatch.functions.values import double, num, quoted
from rankwatch.sources.outputs import exists

BINS = 1000
PARTS = 10
SHIFT, SPREAD = 0.2, 0.01


def score_sketch(scored: DataFrame, batch: str, score: str) -> DataFrame:
    """(batch, bin, rows, total, square) of the rows that have a score; scores outside 0 to 1 count
    in the outer bins. One grouped count, combined before the shuffle."""
    p = num(scored.schema, score)
    rows = scored.selectExpr(f"CAST({quoted(batch)} AS STRING) AS batch", f"{p} AS p").where("p IS NOT NULL")
    bin_ = F.expr(f"CAST(least({BINS - 1}, greatest(0, floor(p * {BINS}))) AS INT) AS bin")
    return rows.groupBy("batch", bin_).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("p").alias("total"), F.sum(F.col("p") * F.col("p")).alias("square")
    )


def merged(sketches: DataFrame, batch: str) -> DataFrame:
    """The sketch of all rows of several batches under one name."""
    return sketches.groupBy(F.lit(batch).alias("batch"), "bin").agg(
        *[F.sum(c).alias(c) for c in ("rows", "total", "square")]
    )


def append_history(sketch: DataFrame, path: str) -> None:
    """Add a batch to the history; one that is there already is replaced."""
    sketch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    if not exists(spark, path):
        return None
    return spark.read.parquet(path).withColumn("batch", F.col("batch").cast("string"))


def _shares(sketch: DataFrame, parts: DataFrame, share: str) -> DataFrame:
    """(part, share) of a batch in given parts of the bins; at most BINS rows come in."""
    counted = sketch.join(F.broadcast(parts), "bin").groupBy("part").agg(F.sum("rows").alias("n"))
    # One row per part.
    return counted.select("part", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))).alias(share))


def score_shift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(part, previous_share, current_share): both batches in the tenths of the previous one.

    A bin belongs to the tenth in which its first row lies, so tenths are as even as bins allow;
    one the previous batch does not reach belongs to the tenth of the next bin that it does.
    Without previous rows there are no tenths and the result is empty."""
    spark = previous.sparkSession
    every = spark.range(BINS).select(F.col("id").cast("int").alias("bin"))
    # A batch's sketch has at most BINS rows: that is what meets in one task.
    upto = Window.partitionBy(F.lit(1)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    counted = every.join(previous.groupBy("bin").agg(F.sum("rows").alias("rows")), "bin", "left").fillna(0, ["rows"])
    before = F.coalesce(F.sum("rows").over(upto), F.lit(0))
    part = F.expr(f"CASE WHEN n > 0 THEN CAST(least({PARTS - 1}, floor({PARTS} * before / n)) AS INT) END")
    parts = counted.select("bin", before.alias("before"), F.sum("rows").over(whole).alias("n")).select("bin", part.alias("part"))
    one, two = _shares(previous, parts, "previous_share"), _shares(current, parts, "current_share")
    return one.join(two, "part", "full").where("part IS NOT NULL").select(
        "part", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("previous_share", "current_share")]
    )


def shift_findings(previous: DataFrame, current: DataFrame, shift: float = SHIFT, spread: float = SPREAD) -> DataFrame:
    """Findings about a batch's scores: their distance from the previous batch, and whether they
    have collapsed to nearly one value."""
    moved = score_shift(previous, current).agg(
        F.expr("coalesce(sum(abs(previous_share - current_share)) / 2, 0D) AS distance")
    )
    own = current.agg(
        F.sum("rows").alias("n"), F.sum("total").alias("t"), F.sum("square").alias("s"), F.max("rows").alias("most")
    )
    variance = "CASE WHEN n > 0 THEN greatest(0D, s / n - power(t / n, 2)) END"
    one = moved.join(own).selectExpr("distance", "n", f"sqrt({variance}) AS spread", "most / n AS share")
    rows = [
        finding("history", "score_distribution_shifted", f"n > 0 AND distance > {double(shift)}", "distance", shift),
        finding("history", "scores_collapsed", f"spread < {double(spread)}", "spread", spread),
        finding("history", "one_bin_holds_most", "share > 0.5", "share", 0.5),
        finding("history", "no_scores", "coalesce(n, 0) = 0", "coalesce(n, 0)", 1),
    ]
    return to_rows(one, rows, FINDING_FIELDS)


def batch_spread(sketches: DataFrame, spread: float = SPREAD) -> DataFrame:
    """(batch, rows, mean_score, score_spread, collapsed) of every batch in a history."""
    sums = sketches.groupBy("batch").agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("t"), F.sum("square").alias("s")
    )
    return sums.selectExpr(
        "batch", "rows", "t / rows AS mean_score",
        "sqrt(greatest(0D, s / rows - power(t / rows, 2))) AS score_spread",
    ).withColumn("collapsed", F.col("score_spread") < F.lit(spread))


def latest_before(sketches: DataFrame, batch: str) -> DataFrame:
    """The sketch of the batch just before `batch`, by name; names ascend with time."""
    names = sketches.where(F.col("batch") < F.lit(batch)).agg(F.max("batch").alias("batch"))
    return sketches.join(F.broadcast(names), "batch")

