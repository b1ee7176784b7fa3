"""Sharding by minimax contiguous partition of ordered atomic groups.

Rows with equal texts are one group and stay together. Groups are ordered by a hash of the
text; a shard is a contiguous stretch of that order. Binary search finds the smallest capacity
for which cutting greedily (fill a shard while the next group still fits) needs no more than the
wanted shards; the cuts are made there.

The driver never sees all groups. It holds byte totals of hash ranges, which bound where a
greedy cut can fall for a given capacity from both sides; only ranges in which the answer can
still lie are split further, until the capacity and every cut are exact. The number of totals
follows the shard count and the fan-out, not the rows.

A group that is larger than an even share gets a shard to itself first (no partition can
do better for it), so the others stay near equal beside it. Slots number the rows of a shard
without gaps, by cells of (shard, hash of the id) with summed offsets.

Size: UTF-8 bytes of the text plus `overhead`; a null text has no bytes and its rows are one
group. Two texts with one 64-bit hash would share a group, which only keeps more together.
Repeated rows each have a slot. Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwatch.llm.common import numbered, stage

SHARDS = 40
FIRST_BITS = 13
MORE_BITS = 7
CELLS = 64
ROWS_PER_CELL = 1_000_000


@dataclass(frozen=True)
class Stretch:
    """Hashes [low, high] with so many bytes; one group only when low is high."""

    low: int
    high: int
    size: int


class Order:
    """What is known of the ordered groups: stretches with their byte totals."""

    def __init__(self, stretches: list[Stretch]):
        self.stretches = sorted(stretches, key=lambda s: s.low)
        self.edges = [0]
        for s in self.stretches:
            self.edges.append(self.edges[-1] + s.size)
        self.total = self.edges[-1]

    def reach(self, start: tuple[int, int], capacity: int) -> tuple[int, int]:
        """Lowest and highest place where greedy filling from within `start` can end."""
        low = self.edges[bisect_right(self.edges, start[0] + capacity) - 1]
        at = start[1] + capacity
        if at >= self.total:
            return low, self.total
        i = bisect_right(self.edges, at) - 1
        whole = self.stretches[i].low == self.stretches[i].high
        return low, self.edges[i] if whole else at

    def cuts(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        out, at = [], (0, 0)
        for _ in range(shards):
            at = self.reach(at, capacity)
            out.append(at)
        return out

    def smallest(self, shards: int, sure: bool) -> int:
        """The least capacity that surely (or possibly) is enough."""
        low, high = 0, self.total
        while low < high:
            middle = (low + high) // 2
            last = self.cuts(middle, shards)[-1]
            if last[0 if sure else 1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def open_stretches(self, shards: int, least: int, most: int) -> list[Stretch]:
        """Stretches of several groups in which a cut can fall between both capacities."""
        found: dict[int, Stretch] = {}
        for (a, _), (_, b) in zip(self.cuts(least, shards), self.cuts(most, shards), strict=True):
            i = max(0, bisect_right(self.edges, a) - 1)
            while i < len(self.stretches) and self.edges[i] <= b:
                s = self.stretches[i]
                if s.low != s.high and self.edges[i] < self.total:
                    found[i] = s
                i += 1
        return [found[i] for i in sorted(found)]


def _totals(sized: DataFrame, shift: int) -> list[Stretch]:
    """Byte totals by the upper bits of the hash; at most 2 ** (64 - shift) rows."""
    rows = (
        sized.groupBy(F.shiftright("_h", shift).alias("c"))
        .agg(F.min("_h").alias("low"), F.max("_h").alias("high"), F.sum("size").alias("size"))
        .collect()
    )
    return [Stretch(r["low"], r["high"], r["size"]) for r in rows]


def partition(sized: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, first hash of every shard but the first) for rows of (_h, size)."""
    shift = 64 - FIRST_BITS
    known = _totals(sized, shift)
    while True:
        order = Order(known)
        if not order.total:
            return 0, []
        least, most = order.smallest(shards, sure=False), order.smallest(shards, sure=True)
        open_ = order.open_stretches(shards, least, most)
        exact = least == most and all(a == b for a, b in order.cuts(most, shards))
        if exact:
            break
        shift = max(0, shift - MORE_BITS)
        wanted = sized.sparkSession.createDataFrame([(s.low, s.high) for s in open_], "lo long, hi long")
        # Bounded by shards x fan-out; a row meets the one stretch that shares its upper bits.
        upper = min(64, shift + MORE_BITS)
        finer = _totals(
            sized.join(
                F.broadcast(wanted.withColumn("_c", F.shiftright("lo", upper)).select("_c").distinct()),
                F.shiftright("_h", upper) == F.col("_c"),
                "left_semi",
            ),
            shift,
        )
        ranges = [(s.low, s.high) for s in open_]
        kept = [s for s in known if (s.low, s.high) not in set(ranges)]
        inside = [f for f in finer if any_range(ranges, f.low)]
        known = kept + inside
    starts = []
    for place, _ in order.cuts(most, shards)[:-1]:
        i = bisect_right(order.edges, place) - 1
        starts.append(order.stretches[i].low if place < order.total else None)
    return most, starts


def any_range(ranges: list[tuple[int, int]], value: int) -> bool:
    i = bisect_right(ranges, (value, 2**63)) - 1
    return i >= 0 and ranges[i][0] <= value <= ranges[i][1]


def oversized(sized: DataFrame, total: int, shards: int) -> list[int]:
    """Hashes of groups larger than an even share of what larger groups leave."""
    # At most 4 x shards groups can be that large.
    large = (
        sized.groupBy("_h").agg(F.sum("size").alias("size"))
        .where(F.col("size") * F.lit(4 * shards) >= F.lit(total))
        .collect()
    )
    out, rest = [], total
    for r in sorted(large, key=lambda r: (-r["size"], r["_h"])):
        left = shards - len(out)
        if left <= 1 or r["size"] * left <= rest:
            break
        out.append(r["_h"])
        rest -= r["size"]
    return out


def shard_of(hash_: Column, alone: list[int], starts: list[int | None]) -> Column:
    """Shards 0 to len(alone) - 1 hold one large group each, the others follow the order."""
    # A start that is missing belongs to a shard without rows.
    place = F.lit(len(alone))
    for s in starts:
        if s is not None:
            place = place + F.when(hash_ >= F.lit(s), 1).otherwise(0)
    for i, h in enumerate(alone):
        place = F.when(hash_ == F.lit(h), i).otherwise(place)
    return place.cast("int")


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    overhead: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row."""
    text = F.col(text_column).cast("string")
    sized = stage(
        docs.select(
            F.col(id_column).alias("_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_h"),
        ),
        "shard-sizes",
    )
    sums = sized.agg(F.sum("size").alias("size"), F.count("*").alias("n")).first()
    total, rows = sums["size"] or 0, sums["n"]
    alone = oversized(sized, total, shards)
    rest = sized.where(~F.col("_h").isin(alone)) if alone else sized
    _, starts = partition(rest.select("_h", "size"), shards - len(alone))

    cells = max(CELLS, -(-rows // ROWS_PER_CELL))
    placed = sized.withColumn("shard", shard_of(F.col("_h"), alone, starts))
    slots = numbered(placed, "shard", cells, [F.col("_id"), F.col("_h")], "slot", ROWS_PER_CELL)
    return slots.select(F.col("_id").alias(id_column), "size", "text_crc32", "shard", "slot")
