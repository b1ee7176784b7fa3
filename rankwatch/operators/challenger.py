"""A tree ensemble on the features of the linear model, and both in one report.

The challenger sees what the champion sees: the same split, fills, levels and class weights. It is
fitted on the train part and compared on the test part, where every row has both probabilities.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.values import num
from rankwatch.operators.features import check_features
from rankwatch.operators.metrics import average_precision, model_metrics
from rankwatch.operators.model import class_weight, fit_classifier
from rankwatch.operators.ordering import DIRECT_ROWS
from rankwatch.operators.prep import FEATURES, fit_prep
from rankwatch.operators.split import stratified_split
from rankwatch.sources.staging import stage

CHAMPION, CHALLENGER = "logistic_regression", "gradient_boosted_trees"
TREES, DEPTH, SHARE = 20, 4, 0.1


def fit_trees(features: DataFrame, label: str, positives: int, rows: int, trees: int, depth: int, seed: int):
    """Boosted trees, balanced classes; bins of a column are found on Spark's own sample."""
    weight = class_weight(F.col(label), positives, rows).alias("_weight")
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol="_weight", maxIter=trees, maxDepth=depth,
        stepSize=SHARE, seed=seed, cacheNodeIds=False,
    ).fit(features.select(FEATURES, F.col(label), weight))


def challenge(
    df: DataFrame, cfg: Config, trees: int = TREES, depth: int = DEPTH, direct_rows: int = DIRECT_ROWS
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """(models by name, scored test rows): id, label and a probability per model.

    The split is computed once and staged; both models share the fitted preprocessing."""
    check_features(df, cfg)
    y = F.expr(num(df.schema, cfg.target_column)).cast("double")
    split = stage(stratified_split(df, cfg, direct_rows).withColumn("_label", y).drop(cfg.target_column), "challenge-split")
    train = split.where("split = 'train'").drop("split")
    size = train.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").cast("long").alias("p")).first()
    if not size["n"] or size["p"] in (0, size["n"]):
        raise ValueError("training rows must hold both classes")
    prep, prepared = fit_prep(train, cfg, direct_rows=direct_rows)
    prepared = stage(prepared.select(FEATURES, "_label"), "challenge-features")
    fitted = {
        CHAMPION: fit_classifier(prepared, "_label", size["p"], size["n"]),
        CHALLENGER: fit_trees(prepared, "_label", size["p"], size["n"], trees, depth, cfg.seed),
    }
    rows = prep.transform(split.where("split = 'test'").drop("split"))
    rows = rows.select(cfg.id_column, F.col("_label").cast("int").alias(cfg.target_column), FEATURES)
    for name, model in fitted.items():
        probability = vector_to_array(F.col("probability"))[1].alias(name)
        rows = model.transform(rows).select(*rows.columns, probability)
    scored = stage(rows.drop(FEATURES), "challenge-scored")
    return {n: PipelineModel([*prep.stages, m]) for n, m in fitted.items()}, scored


def compare(scored: DataFrame, cfg: Config, names: tuple[str, ...] = (CHAMPION, CHALLENGER)) -> DataFrame:
    """One row of metrics per model, with its average precision and Brier score."""
    parts = []
    for name in names:
        one = model_metrics(scored, cfg, name).withColumn("pr_auc", average_precision(scored, cfg, name).scalar())
        parts.append(one.select(F.lit(name).alias("model"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
