"""Class-balanced logistic regression on prepared features."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.values import at_least, day, num, quoted
from rankwatch.operators.drift import reference_categorical, reference_numeric
from rankwatch.operators.features import check_features
from rankwatch.operators.metrics import METRICS, confusion
from rankwatch.operators.ordering import DIRECT_ROWS
from rankwatch.operators.prep import FEATURES, fit_prep
from rankwatch.operators.scoring import PROBABILITY
from rankwatch.operators.split import stratified_split
from rankwatch.sources.staging import stage

MODEL_NAME = "logistic_regression"
_ML_COLUMNS = ("rawPrediction", "probability", "prediction")


@dataclass
class Bundle:
    """A fitted model with the facts and reference tables later runs need."""

    model: PipelineModel
    meta: dict[str, Any]
    ref_numeric: DataFrame
    ref_categorical: DataFrame

    def predict_proba(self, df: DataFrame, column: str = PROBABILITY) -> DataFrame:
        """Append the probability of the positive class."""
        p = vector_to_array(F.col("probability"))[1]
        return self.model.transform(df).select(
            *[quoted(c) for c in df.columns if c != column], p.alias(column)
        )

    def predict(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """Append the 0/1 label: probability >= threshold."""
        label = f"CAST({at_least('_p', threshold)} AS INT)"
        return self.predict_proba(df, "_p").withColumn("predicted_label", F.expr(label)).drop("_p")


def class_weight(y: Column, positives: int, rows: int) -> Column:
    """rows / (classes * rows of the class)"""
    return F.when(y == 1, rows / (2 * positives)).otherwise(rows / (2 * (rows - positives)))


def fit_classifier(features: DataFrame, label: str, positives: int, rows: int):
    """L2 logistic regression, balanced classes, unpenalised intercept.

    Spark averages the loss over the weights, so an inverse penalty of 1 on the summed loss
    is regParam = 1 / sum(weights), and balanced weights sum to the row count. The columns
    are scaled already; scaling again inside the solver would change the penalty.
    """
    weight = class_weight(F.col(label), positives, rows).alias("_weight")
    data = features.select(FEATURES, F.col(label), weight)
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        weightCol="_weight",
        regParam=1.0 / rows,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
        tol=1e-10,
    ).fit(data)


def train(df: DataFrame, cfg: Config, direct_rows: int = DIRECT_ROWS) -> Bundle:
    """Split, fit on the train part, measure on the validation part, profile the train part.

    The rows with their part are staged: each later step reads the columns it needs from there.
    Before, the split reads id and target of `df`; stage that when it is costly to compute.
    """
    check_features(df, cfg)
    split = stage(stratified_split(df, cfg, direct_rows), "parts")
    y = F.expr(num(df.schema, cfg.target_column))
    sizes = {
        r["split"]: (r["n"], r["pos"] or 0, r["latest"])
        for r in split.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(y.cast("long")).alias("pos"),
            F.expr(f"max({day(df.schema, cfg.date_column, cfg.date_format)}) AS latest"),
        )
        .collect()
    }
    rows, positives, _ = sizes.get("train", (0, 0, None))
    if positives == 0 or positives == rows:
        raise ValueError("training rows must hold both classes")
    latest = max(s[2] for s in sizes.values() if s[2] is not None)

    part = {
        name: split.where(F.col("split") == name).drop("split")
        for name in ("train", "validation", "test")
    }
    label = "_label"
    features = {n: part[n].withColumn(label, y.cast("double")).drop(cfg.target_column)
                for n in ("train", "validation")}
    prep, prepared = fit_prep(features["train"], cfg, direct_rows=direct_rows)
    classifier = fit_classifier(prepared, label, positives, rows)
    model = PipelineModel([*prep.stages, classifier])

    checked = confusion(
        model.transform(features["validation"]), label, "prediction"
    ).first()
    n_val, pos_val, _ = sizes.get("validation", (0, 0, None))
    meta = {
        "model_name": MODEL_NAME,
        "target_column": cfg.target_column,
        "reference_date": latest.isoformat(),
        "split_strategy": "stratified",
        "random_seed": cfg.seed,
        "train_rows": rows,
        "validation_rows": n_val,
        "test_rows": sizes.get("test", (0,))[0],
        "train_positive_rate": positives / rows,
        "validation_positive_rate": pos_val / n_val if n_val else 0.0,
        "numeric_features": list(cfg.numeric),
        "categorical_features": list(cfg.categorical),
        "derived_features": list(cfg.derived),
        **{f"validation_{m}": checked[m] for m in METRICS},
    }
    return Bundle(
        model, meta, reference_numeric(part["train"], cfg), reference_categorical(part["train"], cfg)
    )
