"""What became of queued rows: as-of join of queue entries with the next review event.

An entry is (batch, id, time of queueing); repeated rows are one entry. Its outcome is the first
event of its id at or after that time and within the horizon, ties by the name of the outcome.
The events of an id meet its entries in the join and fall to one row per entry before the
shuffle that follows, so an id with very many events costs no more than reading them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.functions.values import quoted, ratio

REVIEWED, CONTACTED, OVERRIDDEN = "reviewed", "contacted", "overridden"


def next_events(
    queue: DataFrame, events: DataFrame, outcomes: Mapping[str, str], horizon: str,
    id_column: str, queued_at: str, batch: str, event_time: str, event_kind: str,
) -> DataFrame:
    """(batch, id, queued_at, outcome, hours): one row per entry, null where nothing followed.

    `outcomes` names the outcome of each kind of event; other kinds say nothing."""
    entries = queue.select(
        F.col(quoted(batch)).cast("string").alias("batch"), F.col(quoted(id_column)).alias("id"),
        F.col(quoted(queued_at)).cast("timestamp").alias("queued_at"),
    ).distinct()
    kind = F.col(quoted(event_kind))
    outcome = F.lit(None).cast("string")
    for name, value in outcomes.items():
        outcome = F.when(kind == name, value).otherwise(outcome)
    said = events.where(kind.isin(*outcomes)).select(
        F.col(quoted(id_column)).alias("id"), F.col(quoted(event_time)).cast("timestamp").alias("at"), outcome.alias("outcome")
    )
    after = F.col("at").between(F.col("queued_at"), F.col("queued_at") + F.expr(f"INTERVAL {horizon}"))
    first = (
        entries.join(said, "id").where(after)
        .groupBy("batch", "id", "queued_at").agg(F.min(F.struct("at", "outcome")).alias("f"))
        .select("batch", "id", "queued_at", F.col("f.at").alias("at"), F.col("f.outcome").alias("outcome"))
    )
    # Entries without an id or a time stay, with nothing to follow.
    found = entries.join(first, ["batch", "id", "queued_at"], "left")
    seconds = (F.unix_micros("at") - F.unix_micros("queued_at")) / 3.6e9
    return found.select("batch", "id", "queued_at", "outcome", seconds.alias("hours"))


def review_metrics(found: DataFrame) -> DataFrame:
    """(batch, queued, reviewed, reviewed_rate, contacted_rate, overridden_rate, mean_hours): an
    entry with any outcome has been reviewed; the other rates are of the reviewed ones."""
    any_ = "count(outcome)"
    of = lambda kind: f"count_if(outcome = '{kind}')"
    return found.groupBy("batch").agg(
        F.expr("count(*) AS queued"),
        F.expr(f"{any_} AS reviewed"),
        F.expr(f"{ratio(any_, 'count(*)')} AS reviewed_rate"),
        F.expr(f"{ratio(of(CONTACTED), any_)} AS contacted_rate"),
        F.expr(f"{ratio(of(OVERRIDDEN), any_)} AS overridden_rate"),
        F.expr("avg(hours) AS mean_hours"),
    )
