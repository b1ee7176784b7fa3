import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rankwatch.operators import drift as dr
from rankwatch.sources.tables import events_config
from rankwatch.streaming import windows as win

COLUMNS = "event_id long, ts timestamp, event_type string, value double, rows int"
CFG = events_config()
DAY = dt.datetime(2024, 3, 1)


def event(i, day, kind, value, hour=12):
    return (i, DAY + dt.timedelta(days=day, hours=hour), kind, value, 0)


@pytest.fixture()
def ref(spark):
    rows = [event(i, -9, "view" if i % 2 else "click", float(i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, COLUMNS)
    return dr.reference_numeric(df, CFG), dr.reference_categorical(df, CFG)


def files(spark, folder, batches):
    for rows in batches:
        spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(folder)


def table(df):
    return sorted(tuple(r) for r in df.select("window_start", "kind", "feature", "rows", "shift", "missing_rate_shift", "status").collect())


def run(spark, tmp_path, ref, batches, name="out", folder="in"):
    stream = files(spark, f"{tmp_path}/{folder}", batches)
    win.monitor_windows(stream, *ref, CFG, f"{tmp_path}/{name}", f"{tmp_path}/{name}.checkpoint").awaitTermination()
    path = f"{tmp_path}/{name}"
    return spark.read.parquet(path) if os.path.exists(path) else None


def day_rows(day, n=30, shift=0.0):
    return [event(100 * day + i, day, ["view", "click", "new"][i % 3], None if i % 5 == 0 else i + shift) for i in range(n)]


def test_closed_windows_equal_the_table(spark, tmp_path, ref):
    batches = [day_rows(0), day_rows(1, 20, 5.0) + day_rows(0, 4), day_rows(2), day_rows(3), day_rows(4, 3)]
    got = run(spark, tmp_path, ref, batches)
    every = spark.createDataFrame([r for b in batches for r in b], COLUMNS)
    whole = win.drift_by_window(every, *ref, CFG)
    # Day 4 has events at noon, so a day's delay leaves days 3 and 4 open.
    assert table(got) == table(whole.where(F.col("window_start") < DAY + dt.timedelta(days=3)))
    assert {r["rows"] for r in got.where(F.col("window_start") == DAY).collect()} == {34}


def test_late_rows_are_dropped_and_state_survives(spark, tmp_path, ref):
    first = run(spark, tmp_path, ref, [day_rows(0), day_rows(1), day_rows(4)])
    assert {r[0] for r in first.select("window_start").distinct().collect()} == {DAY, DAY + dt.timedelta(days=1)}
    # The next run goes on from the checkpoint: day 0 is over, day 4 still counts.
    second = run(spark, tmp_path, ref, [day_rows(0, 7) + day_rows(4, 5), day_rows(9, 1)])
    rows = {(r["window_start"], r["kind"]): r["rows"] for r in second.collect()}
    assert rows[DAY, "numeric"] == 30 and rows[DAY + dt.timedelta(days=4), "categorical"] == 35
    assert second.count() == 6


def test_odd_events(spark, tmp_path, ref):
    rows = [(1, None, "view", 1.0, 0), event(2, 0, None, float("nan")), event(3, 0, None, None)]
    got = {r["kind"]: r for r in win.drift_by_window(spark.createDataFrame(rows, COLUMNS), *ref, CFG).collect()}
    assert got["numeric"]["rows"] == 2 and got["numeric"]["shift"] is None and got["numeric"]["missing_rate_shift"] == 1
    assert got["categorical"]["shift"] == 1 and got["categorical"]["status"] == "significant"
    empty = spark.createDataFrame([], COLUMNS)
    assert win.drift_by_window(empty, *ref, CFG).collect() == []
    none = tuple(t.limit(0) for t in ref)
    assert {r["shift"] for r in win.drift_by_window(spark.createDataFrame(day_rows(0), COLUMNS), *none, CFG).collect()} == {None, 0.5}
    assert run(spark, tmp_path, ref, [day_rows(0)]) is None  # nothing is closed yet


def test_distance_is_that_of_whole_batches(spark, ref):
    df = spark.createDataFrame(day_rows(0), COLUMNS)
    want = dr.drift_status_rows(dr.numeric_drift(df, ref[0], CFG), dr.categorical_drift(df, ref[1], CFG))
    got = win.drift_by_window(df, *ref, CFG).select("kind", "feature", "shift", "missing_rate_shift", "status")
    close = lambda rows: sorted((r[0], r[1], round(r[2], 9), round(r[3], 9), r[4]) for r in rows.collect())
    assert close(got) == close(want)
