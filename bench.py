"""Time the headline queries and print one JSON line.

Each query runs once to warm the session and the page cache, then `BENCH_RUNS` times; the
median counts. A run builds the plan and writes the whole result to a null sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rankwatch.plans import catalog  # noqa: E402
from rankwatch.sources.staging import drop_staged, stage  # noqa: E402
from rankwatch.sources.tables import scored_snapshot  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "validation_findings",
    "upload_profile",
    "duplicate_ids",
    "features_all",
    "text_features_documents",
    "impute_scale",
    "one_hot",
    "stratified_split",
    "baseline_metrics",
    "model_metrics",
    "average_precision",
    "slice_metrics",
    "evaluation_overall",
    "review_queue",
    "top_k_queue",
    "batch_summary",
    "drift_status",
    "drift_prediction",
    "drift_events",
    "numeric_profile",
    "categorical_top3",
    "text_profile_documents",
    "verify_predictions",
    "train_lr",
    "train_then_score",
)


def review_queue_window(spark: SparkSession, d: str) -> DataFrame:
    """The plain global window, for comparison with the sliced rank; one task sorts all."""
    df = stage(scored_snapshot(spark, d).select("customer_id", "churn_probability"), "queue")
    order = Window.orderBy(F.col("churn_probability").desc_nulls_last(), "customer_id")
    return df.withColumn("review_rank", F.row_number().over(order))


def seconds(fn, spark: SparkSession) -> float:
    start = time.perf_counter()
    fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.registered()
    timed = {}
    for name in HEADLINE:
        seconds(known[name], spark)
        timed[name] = statistics.median(seconds(known[name], spark) for _ in range(RUNS))
    seconds(review_queue_window, spark)
    plain = statistics.median(seconds(review_queue_window, spark) for _ in range(RUNS))
    drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, median per query, total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timed.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "comparison": {"review_queue_window": round(plain, 3)},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
