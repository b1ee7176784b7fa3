"""Drift of arriving events per window of their own time.

Events arrive late and out of order, so a window is judged once, when the watermark says that
no more of it is expected; rows that come later still are dropped. The state holds one row of
sums per open window and feature (per value, for categories): it grows with the windows the
delay keeps open, not with the events. `window_sums` and `windowed_drift` are plain DataFrame
functions, so a table and a stream of the same rows give the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankwatch.config import Config
from rankwatch.functions.rows import inline
from rankwatch.functions.values import day, drift_status, filled, num, ratio, text
from rankwatch.sources.staging import stage, staging

_FIELDS = (("kind", "string"), ("feature", "string"), ("value", "string"), ("x", "double"))


def event_time(events: DataFrame, cfg: Config) -> DataFrame:
    """The monitored columns in long form beside `event_ts`; rows without a time belong to no
    window and are left out."""
    entries = [
        {"kind": "'numeric'", "feature": text(c), "x": num(events.schema, c)}
        for c in cfg.monitor_numeric
        if c in events.columns
    ] + [
        {"kind": "'categorical'", "feature": text(c), "value": filled(c)}
        for c in cfg.monitor_categorical
        if c in events.columns
    ]
    value = day(events.schema, cfg.date_column, cfg.date_format)
    return (
        events.withColumn("event_ts", F.expr(f"CAST({value} AS TIMESTAMP)"))
        .where("event_ts IS NOT NULL")
        .selectExpr("event_ts", inline(entries, _FIELDS))
    )


def window_sums(long: DataFrame, width: str) -> DataFrame:
    """(window_start, kind, feature, value, rows, present, total): sums that add up, combined
    before the shuffle."""
    grouped = long.groupBy(F.window("event_ts", width), "kind", "feature", "value")
    sums = grouped.agg(
        F.count(F.lit(1)).alias("rows"), F.count("x").alias("present"), F.sum("x").alias("total")
    )
    return sums.select(
        F.col("window.start").alias("window_start"), "kind", "feature", "value", "rows", "present", "total"
    )


def windowed_drift(sums: DataFrame, ref_numeric: DataFrame, ref_categorical: DataFrame) -> DataFrame:
    """(window_start, kind, feature, rows, shift, missing_rate_shift, status) per window.

    Numeric: mean and missing rate against the reference. Categorical: total variation distance;
    reference values that a window lacks count with their share, so the reference is only
    looked up and never multiplied by the windows."""
    ref = ref_numeric.select("feature", F.col("mean").alias("ref_mean"), F.col("missing_rate").alias("ref_missing"))
    mean, missing = "try_divide(total, present)", ratio("rows - present", "rows")
    numeric = sums.where("kind = 'numeric'").join(ref, "feature", "left").selectExpr(
        "window_start", "kind", "feature", "rows", f"{mean} - ref_mean AS shift",
        f"{missing} - ref_missing AS missing_rate_shift",
    )
    named = sums.where("kind = 'categorical'")
    whole = named.groupBy("window_start", "feature").agg(F.sum("rows").alias("all_rows"))
    held = ref_categorical.groupBy("feature").agg(F.sum("share").alias("ref_total"))
    values = named.join(whole, ["window_start", "feature"]).join(ref_categorical, ["feature", "value"], "left")
    apart = values.groupBy("window_start", "feature").agg(
        F.max("all_rows").alias("rows"),
        F.expr("sum(abs(rows / all_rows - coalesce(share, 0D))) AS apart"),
        F.expr("sum(coalesce(share, 0D)) AS seen"),
    )
    categorical = apart.join(held, "feature", "left").selectExpr(
        "window_start", "'categorical' AS kind", "feature", "rows",
        "(apart + coalesce(ref_total, 0D) - seen) / 2 AS shift", "0D AS missing_rate_shift",
    )
    status = F.expr(drift_status("shift", "missing_rate_shift"))
    return numeric.unionByName(categorical).withColumn("status", status)


def drift_by_window(
    events: DataFrame, ref_numeric: DataFrame, ref_categorical: DataFrame, cfg: Config, width: str = "1 day"
) -> DataFrame:
    """Drift of a table's windows, all of them."""
    sums = stage(window_sums(event_time(events, cfg), width), "window-sums")
    return windowed_drift(sums, ref_numeric, ref_categorical)


def monitor_windows(
    events: DataFrame, ref_numeric: DataFrame, ref_categorical: DataFrame, cfg: Config, out: str,
    checkpoint: str, width: str = "1 day", delay: str = "1 day",
) -> StreamingQuery:
    """Handle what has arrived and stop: windows that are closed by then are written under `out`,
    one folder per micro-batch that closed any; the others stay in the checkpoint's state.

    A micro-batch repeated after a failure overwrites its own folder. `delay` is how much later
    than the latest event a row may come."""

    def each(sums: DataFrame, batch_id: int) -> None:
        with staging(sums.sparkSession):
            closed = stage(sums, "closed-windows")
            if closed.limit(1).count():
                found = windowed_drift(closed, ref_numeric, ref_categorical)
                found.write.mode("overwrite").parquet(f"{out}/batch={batch_id:09d}")

    late = event_time(events, cfg).withWatermark("event_ts", delay)
    return (
        window_sums(late, width)
        .writeStream.outputMode("append")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
