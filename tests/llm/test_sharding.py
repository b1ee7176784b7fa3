import random
import zlib

import pytest

from rankwatch.llm import sharding as sh


def smallest_capacity(sizes, shards):
    """Binary search over the plain list of ordered group sizes."""

    def fits(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > capacity:
                return False
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def greedy(sizes, capacity):
    out, room, shard = [], capacity, 0
    for s in sizes:
        if s > room:
            shard, room = shard + 1, capacity
        room -= s
        out.append(shard)
    return out


@pytest.mark.parametrize(("groups", "shards", "seed"), [(3000, 40, 1), (200, 7, 2), (5, 40, 3), (1, 4, 4), (400, 1, 5)])
def test_partition_equals_the_search_over_the_whole_list(spark, groups, shards, seed, monkeypatch):
    # Few first stretches, so several rounds of splitting are needed.
    monkeypatch.setattr(sh, "FIRST_BITS", 4)
    monkeypatch.setattr(sh, "MORE_BITS", 3)
    g = random.Random(seed)
    data = [(g.randrange(-(2**63), 2**63), g.randrange(16, 5000)) for _ in range(groups)]
    data += [data[0]] * 5
    sums = {}
    for h, s in data:
        sums[h] = sums.get(h, 0) + s
    ordered = [sums[h] for h in sorted(sums)]
    capacity, starts = sh.partition(spark.createDataFrame(data, "_h long, size long"), shards)
    assert capacity == smallest_capacity(ordered, shards)
    place = [sum(h >= s for s in starts if s is not None) for h in sorted(sums)]
    assert place == greedy(ordered, capacity)


def table(spark):
    g = random.Random(9)
    rows = [(i, "w" * g.randrange(1, 400) + str(i), "x") for i in range(1500)]
    rows += [(5000 + i, "the same text " * 9, "x") for i in range(800)]
    rows += [(9000, None, "x"), (9001, None, "x"), (9002, "", "x"), (9003, "žluť", "x"), (9003, "žluť", "x"), (None, "no id", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(6)


def test_groups_stay_together_slots_are_gapless_sizes_near_equal(spark):
    rows, df = table(spark)
    got = sh.assign(df, shards=10).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    homes, sizes, slots = {}, {}, {}
    for r in got:
        t = text[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 16 and r["text_crc32"] == zlib.crc32((t or "").encode())
        homes.setdefault(t, set()).add(r["shard"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    large = max(sizes.values())
    rest = sorted(v for v in sizes.values() if v != large)
    assert len(sizes) == 10 and rest[-1] - rest[0] < 0.05 * rest[-1] + 2000


def test_nothing_to_shard(spark):
    _, df = table(spark)
    assert sh.assign(df.limit(0)).count() == 0
