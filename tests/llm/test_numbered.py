"""Gapless numbers whatever the number of equal rows."""

from pyspark.sql import functions as F

from rankwatch.llm import sharding as sh
from rankwatch.llm.common import numbered


def test_numbers_are_gapless_and_those_of_equal_rows_spread(spark):
    rows = [(i % 3, i if i % 2 else None, "b") for i in range(500)] + [(1, None, None)] * 20_000
    df = spark.createDataFrame(rows, "part int, id long, text string").repartition(5)
    got = numbered(df, "part", 16, [F.col("id")], "number", 1000)
    assert got.columns == ["part", "id", "text", "number"]
    found = got.collect()
    assert sorted((r[0], r[1] or -1, r[2] or "") for r in found) == sorted((a, b or -1, c or "") for a, b, c in rows)
    for part in range(3):
        own = [r["number"] for r in found if r["part"] == part]
        assert sorted(own) == list(range(len(own)))
    # The copies of one row leave in stretches of at most 1,000.
    tasks = got.where("text IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1
    again = numbered(df.repartition(3), "part", 16, [F.col("id")], "number", 1000).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert numbered(df.limit(0), "part", 16, [F.col("id")], "number", 1000).count() == 0


def test_shards_of_a_table_of_copies(spark, monkeypatch):
    monkeypatch.setattr(sh, "ROWS_PER_CELL", 1000)
    df = spark.range(30_000).selectExpr(
        "IF(id % 3 < 2, NULL, id) AS doc_id", "IF(id % 3 < 2, '', concat('text ', id)) AS text"
    )
    got = sh.assign(df, shards=4).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m"))
    rows = got.collect()
    assert sum(r["n"] for r in rows) == 30_000 and all(r["n"] == r["d"] == r["m"] + 1 for r in rows)
