"""Levels of categorical columns: counted, numbered and joined, without a list on the driver.

Levels are numbered by the distributed rank of (column, level), so a column may have as many as
it likes. Up to a checked number of all levels they travel inside the model as labels; beyond it
the model joins a table that is stored beside it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwatch.functions.values import quoted, text
from rankwatch.operators.ordering import global_rank
from rankwatch.operators.quality import category_counts
from rankwatch.sources.staging import stage, stage_path

LEVEL, INDEX, ONE_HOT = "__level", "__index", "__onehot"
# So many levels of all columns together are kept as labels in the model.
MOST_LABELS = 10_000
_TABLE = re.compile(r"parquet\.`([^`]*)`")


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) of the present values, staged."""
    return stage(category_counts(df, list(columns), fill=False).where("value IS NOT NULL"), "level-counts")


def modes_and_sizes(counts: DataFrame) -> dict[str, tuple[str, int]]:
    """Most frequent level (ties: the smaller) and number of levels, one row per column."""
    rows = counts.groupBy("feature").agg(
        F.expr("min(struct(-n, value)).value AS mode"), F.count(F.lit(1)).alias("levels")
    )
    return {r["feature"]: (r["mode"], r["levels"]) for r in rows.collect()}


def numbered_levels(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, level, index): levels of each column numbered from 0 in their order."""
    place = F.lit(None).cast("int")
    for i, c in enumerate(columns):
        place = F.when(F.col("feature") == c, -i).otherwise(place)
    rows = stage(counts.select("feature", F.col("value").alias("level"), place.alias("place")), "levels")
    ranked = stage(global_rank(rows, "place", "level", "number"), "ranked-levels")
    # One row per column.
    first = ranked.groupBy("feature").agg(F.min("number").alias("first"))
    return ranked.join(F.broadcast(first), "feature").select(
        "feature", "level", (F.col("number") - F.col("first")).alias("index")
    )


def labels_of(counts: DataFrame) -> dict[str, list[str]]:
    """Sorted levels per column as lists; callers check the number of levels first."""
    out: dict[str, list[str]] = {}
    for r in counts.select("feature", "value").collect():
        out.setdefault(r["feature"], []).append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def _joined(column: str, size: int, path: str) -> SQLTransformer:
    """The index of a column's level from the stored table; `size` for unknown ones."""
    own = quoted(column + LEVEL)
    return SQLTransformer(
        statement=f"SELECT t.*, CAST(coalesce(l.index, {size}) AS DOUBLE) AS {quoted(column + INDEX)} FROM __THIS__ t"
        f" LEFT JOIN (SELECT level, index FROM parquet.`{path}` WHERE feature = {text(column)}) l ON t.{own} = l.level"
    )


def fit_indexers(
    counts: DataFrame, sizes: dict[str, int], most_labels: int = MOST_LABELS
) -> list[Transformer]:
    """One stage per column that adds the index of its level; an unknown or missing one gets the
    number of levels, the slot the encoder leaves out."""
    columns = [c for c, n in sizes.items() if n]
    # The encoder refuses labels without a name; a joined number needs none.
    named = not counts.where("value = ''").limit(1).count()
    if named and sum(sizes.values()) <= most_labels:
        labels = labels_of(counts)
        return [
            StringIndexerModel.from_labels(
                labels[c], inputCol=c + LEVEL, outputCol=c + INDEX, handleInvalid="keep"
            )
            for c in columns
        ]
    path = stage_path(numbered_levels(counts, columns), "level-table")
    return [_joined(c, sizes[c], path) for c in columns]


def fit_encoder(indexers: list[Transformer], frame: DataFrame, columns: Sequence[str]) -> Transformer:
    """Index to a sparse vector; the model holds the number of levels and no level."""
    return OneHotEncoder(
        inputCols=[c + INDEX for c in columns], outputCols=[c + ONE_HOT for c in columns],
        # Labels bring their number along; a joined index is counted by its greatest value.
        dropLast=True, handleInvalid="error" if isinstance(indexers[0], StringIndexerModel) else "keep",
    ).fit(PipelineModel(indexers).transform(frame))


def tables_of(model: PipelineModel) -> set[str]:
    """Stored level tables that the stages join."""
    found = (_TABLE.search(s.getStatement()) for s in model.stages if isinstance(s, SQLTransformer))
    return {m[1] for m in found if m}


def moved(model: PipelineModel, path: str) -> PipelineModel:
    """The model with its level table at `path`."""
    out = []
    for s in model.stages:
        if isinstance(s, SQLTransformer) and _TABLE.search(s.getStatement()):
            s = SQLTransformer(statement=_TABLE.sub(lambda _: f"parquet.`{path}`", s.getStatement()))
        out.append(s)
    return PipelineModel(out)


def set_position(column: str) -> Column:
    """The position of an encoded vector's only entry, null where it has none. Reads the sparse
    vector as it is stored, whatever its size."""
    return F.unwrap_udt(F.col(column + ONE_HOT))["indices"][0]


def level_names(spark: SparkSession, stages: Sequence[Transformer]) -> DataFrame:
    """(feature, position, level) of fitted indexers, for reading encoded vectors."""
    labels = [
        (s.getInputCol().removesuffix(LEVEL), i, v)
        for s in stages if isinstance(s, StringIndexerModel) for i, v in enumerate(s.labels)
    ]
    names = spark.createDataFrame(labels, "feature string, position int, level string")
    for path in tables_of(PipelineModel(list(stages))):
        stored = spark.read.parquet(path)
        names = names.unionByName(stored.select("feature", F.col("index").cast("int").alias("position"), "level"))
    return names
