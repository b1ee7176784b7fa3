from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from rankwatch.operators import split as sp
from rankwatch.operators.model import class_weight


def people(spark, n, positives):
    return spark.range(n).select(
        F.col("id").alias("customer_id"), (F.col("id") < positives).cast("int").alias("churn")
    )


def sizes(df):
    return dict(Counter(r["split"] for r in df.collect()))


def test_sizes_and_shares_of_1200(spark, cfg):
    out = sp.stratified_split(people(spark, 1200, 420), cfg)
    assert sizes(out) == {"train": 720, "validation": 240, "test": 240}
    per = Counter((r["split"], r["churn"]) for r in out.collect())
    assert (per["train", 1], per["validation", 1], per["test", 1]) == (252, 84, 84)
    rates = {r["split"]: r["positive_rate"] for r in sp.split_counts(out, cfg).collect()}
    assert rates == {"train": 0.35, "validation": 0.35, "test": 0.35}


@pytest.mark.parametrize(("n", "want"), [(12, (6, 3, 3)), (8, (4, 2, 2))])
def test_small_sizes(spark, small_cfg, n, want):
    got = sizes(sp.stratified_split(people(spark, n, n // 2), small_cfg))
    assert (got["train"], got["validation"], got["test"]) == want


@pytest.mark.parametrize("direct", [20, 1_000_000])
def test_membership_is_the_hash_order(spark, cfg, direct):
    out = sp.stratified_split(people(spark, 1200, 420), cfg, direct).collect()
    for y in (0, 1):
        ids = [r["customer_id"] for r in out if r["churn"] == y]
        ids.sort(key=lambda i: md5(f"42|{i}".encode()).hexdigest()[:13])
        parts = {r["customer_id"]: r["split"] for r in out}
        k = {0: 156, 1: 84}[y]
        want = ["test"] * k + ["validation"] * k + ["train"] * (len(ids) - 2 * k)
        assert [parts[i] for i in ids] == want


def test_same_rows_same_parts(spark, cfg):
    a = sp.stratified_split(people(spark, 300, 100), cfg)
    b = sp.stratified_split(people(spark, 300, 100).repartition(7), cfg)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    c = sp.stratified_split(people(spark, 300, 100), cfg.with_(seed=7))
    assert {tuple(r) for r in a.collect()} != {tuple(r) for r in c.collect()}


def test_unstratified_fallback(spark, cfg):
    assert not sp.can_stratify({0.0: 99, 1.0: 1})
    assert sizes(sp.stratified_split(people(spark, 100, 1), cfg)) == {
        "train": 60, "validation": 20, "test": 20,
    }
    assert sizes(sp.stratified_split(people(spark, 100, 0), cfg)) == {
        "train": 60, "validation": 20, "test": 20,
    }


def test_second_stage_falls_back_alone(spark, cfg):
    """Two positives: one goes to the test part, the one left can not be stratified."""
    out = sp.stratified_split(people(spark, 4, 2), cfg.with_(test_size=0.5, validation_size=0.25))
    assert sizes(out) == {"test": 2, "validation": 1, "train": 1}


def test_equal_hashes_are_settled_by_content(spark, cfg, monkeypatch):
    monkeypatch.setattr(sp, "split_key", lambda cfg: F.lit(1.0))
    out = sp.stratified_split(people(spark, 20, 10), cfg)
    assert sizes(out) == {"train": 12, "validation": 4, "test": 4}
    again = sp.stratified_split(people(spark, 20, 10).repartition(3), cfg)
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in again.collect()}


def test_empty_and_bad_targets(spark, cfg):
    assert sp.stratified_split(people(spark, 0, 0), cfg).count() == 0
    with pytest.raises(ValueError, match="only 0 and 1"):
        sp.stratified_split(people(spark, 9, 3).withColumn("churn", F.col("churn") * 2), cfg)


def test_class_weights(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,)], "y double")
    got = {r["y"]: r["w"] for r in rows.select("y", class_weight(F.col("y"), 4, 10).alias("w")).collect()}
    assert got == {0.0: 10 / 12, 1.0: 10 / 8}


@pytest.mark.parametrize("nulls", [150, 190, 200])
def test_missing_ids_keep_the_sizes(spark, cfg, nulls):
    df = people(spark, 200, 100).withColumn("note", F.col("customer_id")).withColumn(
        "customer_id", F.when(F.col("customer_id") % 200 >= nulls, F.col("customer_id"))
    )
    assert sizes(sp.stratified_split(df, cfg)) == {"test": 40, "validation": 40, "train": 120}


def test_repeated_ids_and_equal_rows_keep_the_sizes(spark, cfg):
    df = people(spark, 200, 100).withColumn("note", F.col("customer_id")).withColumn("customer_id", F.col("note") % 3)
    want = {"test": 40, "validation": 40, "train": 120}
    assert sizes(sp.stratified_split(df, cfg)) == want
    assert sizes(sp.stratified_split(df.drop("note"), cfg)) == want


def test_equal_rows_when_the_rest_is_cut(spark, cfg):
    df = spark.createDataFrame([(1, 1)] * 2 + [(2, 0)] * 2, "customer_id long, churn int")
    out = sp.stratified_split(df, cfg.with_(test_size=0.5, validation_size=0.25))
    assert sizes(out) == {"test": 2, "validation": 1, "train": 1}
