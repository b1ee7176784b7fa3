"""Bindings of the role names to the warehouse tables used by the registered queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwatch.config import REQUIRED, Config

# Customers silent for longer than this before the last order count as lost.
SILENT_DAYS = 240
# The reference batch ends here; later sign-ups are the current batch.
REFERENCE_END = "1995-07-01"
# Same idea on the event table.
EVENTS_REFERENCE_END = "2024-01-16"

SNAPSHOT_COLUMNS = REQUIRED

# Words that do occur in the document table.
DOCUMENT_KEYWORDS = ("license", "data", "the ")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A warehouse table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snapshot(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """One row per customer with all roles, or only `columns`.

    Every join is a left join on a unique key, so every customer is kept. One without orders
    signed up on the day of the last order, has no urgent one and nothing else to average.
    Line items, documents, nations and regions are left out when none of their columns is asked
    for.
    Line items collapse to one row per order before they meet the orders, which keeps a
    heavy order or customer from moving its rows through the join.
    """
    wanted = list(columns or SNAPSHOT_COLUMNS)
    orders = table(spark, sf_dir, "orders")
    last_order = orders.agg(F.max("o_orderdate")).scalar()

    per_order = orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    sums = [
        F.min("o_orderdate").alias("first_o"),
        F.max("o_orderdate").alias("last_o"),
        F.avg("o_totalprice").alias("avg_bill"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("urgent"),
    ]
    if {"internet_usage_gb", "call_minutes"} & set(wanted):
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines"))
        )
        per_order = per_order.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        sums += [F.sum("qty").alias("qty"), F.sum("n_lines").alias("n_lines")]
    else:
        sums += [F.lit(None).cast("double").alias("qty"), F.lit(None).cast("long").alias("n_lines")]
    per_customer = per_order.groupBy("o_custkey").agg(*sums)

    out = table(spark, sf_dir, "customer").join(
        per_customer, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    none = F.lit(None).cast("string")
    if {"city", "education_level"} & set(wanted):
        nation = table(spark, sf_dir, "nation")
        out = out.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    else:
        out = out.withColumn("n_name", none)
    if "education_level" in wanted:
        region = table(spark, sf_dir, "region")
        out = out.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    else:
        out = out.withColumn("r_name", none)
    if "customer_feedback" in wanted:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        out = out.join(docs, F.col("doc_id") == F.col("c_custkey"), "left")
    else:
        out = out.withColumn("text", none)

    balance = F.col("c_acctbal")
    silent = F.col("last_o") < last_order - F.expr(f"INTERVAL {SILENT_DAYS} DAYS")
    roles: dict[str, Column] = {
        "customer_id": F.col("c_custkey"),
        "signup_date": F.coalesce(F.col("first_o"), last_order).cast("date"),
        "age": (18 + F.col("c_custkey") % 90).cast("int"),
        "gender": F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male"),
        "city": F.col("n_name"),
        "education_level": F.col("r_name"),
        "employment_status": F.when(balance < 0, "debit")
        .when(balance < 5000, "low")
        .otherwise("high"),
        "monthly_income": balance,
        "monthly_bill": F.col("avg_bill"),
        "internet_usage_gb": F.col("qty") / F.col("n_lines"),
        "call_minutes": F.col("n_lines").cast("double"),
        "contract_type": F.col("c_mktsegment"),
        "support_tickets": F.coalesce(F.col("urgent"), F.lit(0)).cast("int"),
        "customer_feedback": F.col("text"),
        "churn": F.when(silent, 1).otherwise(0),
    }
    return out.select(*[roles[c].alias(c) for c in wanted])


SCORE_COLUMNS = ("customer_id", "age", "monthly_income", "support_tickets")


def scorecard_probability() -> Column:
    """Fixed linear score on the snapshot, squashed to a probability."""
    z = (
        F.lit(-1.6)
        + F.lit(0.55) * F.col("support_tickets")
        + F.lit(8e-5) * F.col("monthly_income")
        + F.lit(0.01) * (F.col("age") - F.lit(60))
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def candidate_probability() -> Column:
    """Another fixed linear score, which does without the income."""
    z = F.lit(-1.3) + F.lit(0.55) * F.col("support_tickets") + F.lit(0.012) * (F.col("age") - F.lit(60))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def scored_snapshot(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] = SCORE_COLUMNS
) -> DataFrame:
    """Snapshot columns plus `churn_probability` of the fixed scorecard."""
    wanted = tuple(dict.fromkeys((*SCORE_COLUMNS, *columns)))
    return snapshot(spark, sf_dir, wanted).withColumn(
        "churn_probability", scorecard_probability()
    )


def documents_config() -> Config:
    """Roles of the document table joined with its labels."""
    return Config(
        id_column="doc_id",
        target_column="quality",
        text_column="text",
        numeric=("n_chars",),
        categorical=("lang", "source"),
        length_column="text_length",
        keyword_prefix="text_keyword",
        keywords=DOCUMENT_KEYWORDS,
        required=("doc_id", "text", "lang", "source", "n_chars", "quality"),
        ranges={"n_chars": (1, None)},
    )


def events_config() -> Config:
    """Roles of the event table."""
    return Config(
        id_column="user_id",
        date_column="ts",
        numeric=("value",),
        categorical=("event_type",),
        monitor_numeric=("value",),
        monitor_categorical=("event_type",),
    )


def arriving_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """(events after the reference with `arrives`, the number of the last arrival): two days
    arrive together, every fiftieth event four arrivals later where there are as many."""
    start = F.lit(EVENTS_REFERENCE_END).cast("date")
    late = table(spark, sf_dir, "events").where(F.col("ts") >= F.lit(EVENTS_REFERENCE_END).cast("timestamp_ntz"))
    late = late.withColumn("arrives", F.floor(F.date_diff(F.to_date("ts"), start) / 2).cast("int"))
    last = late.agg(F.max("arrives")).first()[0]
    delayed = (F.col("event_id") % 50 == 0) & (F.col("arrives") + 4 <= last)
    return late.withColumn("arrives", F.col("arrives") + F.when(delayed, 4).otherwise(0)), last
