"""Registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwatch.llm import (
    chat, collocations, covertree, decontam, knn, langid, merkle, neardup, packing, secrets, sharding, tokencount,
    toxicity,
)
from rankwatch.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    kinds = "conv_id long, turn long, role string, text string"
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], kinds)
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.expand(rows.unionByName(extra)))


@query
def op2_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels")))


@query
def op3_secret_scans(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan(table(spark, d, "documents"))


@query
def op4_sharding(spark: SparkSession, d: str) -> DataFrame:
    placed = sharding.assign(table(spark, d, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op6_minhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "documents"), size=2)


@query
def op7_topk_search(spark: SparkSession, d: str) -> DataFrame:
    return knn.search(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op8_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return langid.predict(docs, langid.fit(docs))


@query
def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return tokencount.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_phrase_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return merkle.prove(merkle.build(table(spark, d, "documents")))


@query
def op13_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, d, "embeddings"))
