"""From raw documents to packed training sequences, stage by stage.

Every stage works on what its predecessor kept, written as Parquet and read again. All but the
last return the columns they were given. What each does with odd input:

- null and empty texts are kept by the filters (nothing speaks against them), are left as they
  are by the secret scan and packed as the end id alone;
- rows equal in id and text are copies, one stays; where there is neither an id nor a word,
  nothing says so and all stay;
- different texts under one id, and texts without an id, are documents of their own: near
  duplicates and contamination are decided and dropped by a key of id and text (64 bits), and of
  near duplicates those without an id go first;
- extra columns go through the first four stages untouched, whatever their names;
- an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwatch.llm import decontam, neardup, packing, secrets, toxicity
from rankwatch.llm.common import row_key, stage, table
from rankwatch.sources.staging import fresh_path, staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model fitted on labelled rows of `docs`."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with their key of id and text, and the key's name, which no other column has."""
    name, taken = "_row_key", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return docs.withColumn(name, row_key("doc_id", "text")), name


def _like(docs: DataFrame, keyed: DataFrame, name: str, keys: DataFrame, how: str) -> DataFrame:
    """The columns of `docs` of rows whose key is (`left_semi`) or is not (`left_anti`) listed;
    the list is broadcast or shuffled by its size."""
    return keyed.join(keys.toDF(name), name, how).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the one with the smallest id."""
    keyed, name = _keyed(docs)
    found = neardup.near_duplicates(keyed.select(F.col(name).alias("doc_id"), "text"))
    keys = found.groupBy(F.col("doc_id").alias("key")).agg(
        F.max("component_id").alias("component"), F.max("n_shingles").alias("n_shingles"), F.count("*").alias("n")
    )
    ids = keyed.select(F.col(name).alias("key"), "doc_id").distinct()
    rows = stage(keys.join(ids, "key"), "row-keys")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key"))["key"]
    best = stage(rows.groupBy("component").agg(first.alias("key")).select("key"), "kept-keys")
    dropped = stage(rows.join(best, "key", "left_anti").select("key"), "dropped")
    repeated = stage(
        rows.where("n > 1 AND (doc_id IS NOT NULL OR n_shingles > 0)").join(best, "key", "left_semi").select("key"),
        "repeated",
    )
    once = _like(docs, keyed, name, dropped.unionByName(repeated), "left_anti")
    again, name = _keyed(_like(docs, keyed, name, repeated, "left_semi"))
    return once.unionByName(again.dropDuplicates([name]).drop(name))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window (or whole short item) with the benchmark."""
    keyed, name = _keyed(docs)
    found = decontam.report(keyed.select(F.col(name).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    dropped = stage(found.where("contaminated").select("doc_id").distinct(), "dropped")
    return _like(docs, keyed, name, dropped, "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and its length brought up to date."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with the sequence and the offset each goes to."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

# Scores of a fitted model and token ids are beyond SQL; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        with staging(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
