"""Registered queries: every operator on the whole warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, to_rows
from rankwatch.functions.values import age_band, num, text, ticket_band
from rankwatch.operators import challenger as ch
from rankwatch.operators import drift as dr
from rankwatch.operators import extended as ext
from rankwatch.operators import features as ft
from rankwatch.operators import gate as gt
from rankwatch.operators import history as hs
from rankwatch.operators import levels as lv
from rankwatch.operators import lineage as ln
from rankwatch.operators import metrics as mt
from rankwatch.operators import model as md
from rankwatch.operators import prep as pr
from rankwatch.operators import profile as pf
from rankwatch.operators import quality as ql
from rankwatch.operators import review as rv
from rankwatch.operators import scoring as sc
from rankwatch.operators import split as sp
from rankwatch.operators import verify as vf
from rankwatch.plans import runs
from rankwatch.sources import outputs
from rankwatch.sources import tables as tb
from rankwatch.sources.staging import fresh_path, stage
from rankwatch.streaming import windows as win

CFG = Config()
P = sc.PROBABILITY
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

LABELLED = (*tb.SCORE_COLUMNS, "churn")
SLICED = (*LABELLED, *CFG.categorical)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to fixed places: sums depend on order. Adding 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def labelled(spark: SparkSession, d: str, columns: Iterable[str] = LABELLED) -> DataFrame:
    return tb.scored_snapshot(spark, d, columns)


def staged_labelled(spark: SparkSession, d: str, columns: Iterable[str] = LABELLED) -> DataFrame:
    """For operators that pass over their input more than once."""
    return stage(labelled(spark, d, columns), "scored")


def documents_labels(spark: SparkSession, d: str) -> DataFrame:
    docs = tb.table(spark, d, "documents")
    return docs.join(tb.table(spark, d, "labels"), "doc_id", "left")


# ---- validation -------------------------------------------------------------------


@query
def missing_counts(spark: SparkSession, d: str) -> DataFrame:
    return ql.missing_counts(tb.snapshot(spark, d))


@query
def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    return ql.duplicate_count(tb.table(spark, d, "events"), "user_id")


@query
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return ql.duplicate_keys(tb.table(spark, d, "events"), "user_id")


_TARGETS = (("labels", "quality"), ("embeddings", "label"), ("documents", "lang"))


@query
def target_domain(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        ql.target_domain(tb.table(spark, d, t), CFG.with_(target_column=c)) for t, c in _TARGETS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def target_invalid_values(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        ql.target_invalid_values(tb.table(spark, d, t), CFG.with_(target_column=c))
        for t, c in _TARGETS
    ]
    return reduce(DataFrame.unionByName, parts)


def raw_ages(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Snapshot whose ages are text; those of debit accounts carry a stray letter."""
    df = tb.snapshot(spark, d, columns or tb.SNAPSHOT_COLUMNS)
    text = F.col("age").cast("string")
    debit = F.col("monthly_income") < 0
    return df.withColumn("age", F.when(debit, F.concat(text, F.lit("d"))).otherwise(text))


@query
def numeric_ranges(spark: SparkSession, d: str) -> DataFrame:
    return ql.numeric_ranges(raw_ages(spark, d, "customer_id", *CFG.numeric), CFG)


@query
def validation_findings(spark: SparkSession, d: str) -> DataFrame:
    return ql.validate(raw_ages(spark, d).drop("gender"), CFG)


@query
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d)
    return ql.validation_summary(ql.validate(df, CFG), df)


@query
def upload_profile(spark: SparkSession, d: str) -> DataFrame:
    return ql.upload_profile(tb.snapshot(spark, d).drop("city"), CFG, require_target=True)


# ---- features ---------------------------------------------------------------------


@query
def tenure_days(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, ["customer_id", "signup_date"])
    return ft.tenure_days(df, CFG).select("customer_id", CFG.tenure_column)


@query
def tenure_days_events(spark: SparkSession, d: str) -> DataFrame:
    """Time stamps: part of a day rounds down, and the last day itself gives -1."""
    df = tb.table(spark, d, "events").select("event_id", "ts")
    return ft.tenure_days(df, tb.events_config()).select("event_id", CFG.tenure_column)


@query
def ticket_flag(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, ["customer_id", "support_tickets"])
    return ft.ticket_flag(df, CFG).select("customer_id", CFG.ticket_flag_column)


@query
def text_features(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, ["customer_id", "customer_feedback"])
    return ft.text_features(df, CFG).drop("customer_feedback")


@query
def text_features_documents(spark: SparkSession, d: str) -> DataFrame:
    df = tb.table(spark, d, "documents").select("doc_id", "text")
    return ft.text_features(df, tb.documents_config()).drop("text")


_FEATURE_INPUT = ("customer_id", "signup_date", "support_tickets", "customer_feedback")


@query
def features_all(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, _FEATURE_INPUT)
    return ft.add_features(df, CFG).select("customer_id", *CFG.derived)


# ---- fitted preprocessing ---------------------------------------------------------


def with_gaps(df: DataFrame) -> DataFrame:
    """Debit accounts have no usable income or status: gaps for the imputers to fill."""
    debit = F.col("monthly_income") < 0
    return df.withColumns(
        {
            "employment_status": F.when(~debit, F.col("employment_status")),
            "monthly_income": F.when(~debit, F.col("monthly_income")),
        }
    )


@query
def impute_scale(spark: SparkSession, d: str) -> DataFrame:
    df = with_gaps(tb.snapshot(spark, d))
    derived = pr.derived_frame(df, CFG, pr.derive_stage(df.schema, CFG))
    fit = pr.fit_numeric(derived, CFG)
    return rounded(
        derived.select(
            "customer_id",
            *[F.expr(pr.scale_sql(derived.schema, c, fit[c])).alias(c) for c in CFG.model_numeric],
        )
    )


@query
def impute_mode(spark: SparkSession, d: str) -> DataFrame:
    df = with_gaps(tb.snapshot(spark, d, ["monthly_income", *CFG.categorical]))
    learned = lv.modes_and_sizes(lv.level_counts(df, CFG.categorical))
    return spark.createDataFrame([(c, mode) for c, (mode, _) in learned.items()], "feature string, mode string")


@query
def one_hot(spark: SparkSession, d: str) -> DataFrame:
    """The set entries of the fitted encoder's vectors, by the label of their position."""
    df = with_gaps(tb.snapshot(spark, d, ["customer_id", "monthly_income", *CFG.categorical]))
    base = stage(df.drop("monthly_income"), "levels")
    return _encoded(spark, base, lv.MOST_LABELS)


@query
def one_hot_joined(spark: SparkSession, d: str) -> DataFrame:
    """The same through the table of levels, with the event's hour and user as levels too."""
    events = tb.table(spark, d, "events")
    base = events.select(
        F.col("event_id").alias("customer_id"), "event_type", F.col("user_id").cast("string").alias("user"),
        F.date_format("ts", "yyyy-MM-dd HH").alias("hour"),
    )
    cfg = CFG.with_(categorical=("event_type", "user", "hour"))
    return _encoded(spark, stage(base, "levels"), 0, cfg)


def _encoded(spark: SparkSession, base: DataFrame, most_labels: int, cfg: Config = CFG) -> DataFrame:
    """The set entries of the encoded vectors by the level of their position."""
    stages, kept = pr.fit_levels(base, cfg, {}, most_labels)
    vectors = PipelineModel(stages).transform(base)
    # Only the set entry of a sparse vector is looked at, however many levels there are.
    entry = lambda c: F.struct(F.lit(c).alias("feature"), lv.set_position(c).alias("position"))
    entries = vectors.select(F.col("customer_id").alias("id"), F.inline(F.array(*[entry(c) for c in kept])))
    names = lv.level_names(spark, stages)
    return entries.where("position IS NOT NULL").join(names, ["feature", "position"]).select("id", "feature", "level")


@query
def design_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Entries of the fitted matrix by position."""
    _, prepared = pr.fit_prep(with_gaps(tb.snapshot(spark, d)), CFG)
    entries = prepared.select("customer_id", F.posexplode(vector_to_array(F.col(pr.FEATURES))))
    return rounded(entries.toDF("customer_id", "position", "value")).where("value <> 0")


# ---- split and model --------------------------------------------------------------


def staged_split(spark: SparkSession, d: str, columns: Iterable[str] = LABELLED) -> DataFrame:
    return sp.stratified_split(staged_labelled(spark, d, columns), CFG)


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    df = stage(tb.snapshot(spark, d, ["customer_id", "churn"]), "split")
    return sp.stratified_split(df, CFG).select("customer_id", "split")


@query
def stratified_split_events(spark: SparkSession, d: str) -> DataFrame:
    """Ids that repeat: rows of one user are told apart by their content."""
    clicked = (F.col("event_type") == "click").cast("int").alias("churn")
    df = stage(tb.table(spark, d, "events").select("event_id", "user_id", clicked), "split")
    return sp.stratified_split(df, CFG.with_(id_column="user_id")).select("event_id", "split")


@query
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    df = stage(tb.snapshot(spark, d, ["customer_id", "churn"]), "split")
    return rounded(sp.split_counts(sp.stratified_split(df, CFG), CFG))


@query
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    df = stage(tb.snapshot(spark, d, ["customer_id", "churn"]), "split")
    train = sp.stratified_split(df, CFG).where("split = 'train'")
    size = train.agg(F.count("*").alias("n"), F.sum("churn").alias("p")).first()
    weight = md.class_weight(F.col("churn"), size["p"], size["n"])
    weighted = train.select(F.col("churn").alias("label"), weight.alias("weight"))
    return rounded(weighted.groupBy("label").agg(F.count("*").alias("n"), F.max("weight").alias("weight")))


@query
def train_lr(spark: SparkSession, d: str) -> DataFrame:
    """Whether the gradient of the weighted penalised loss vanishes at the fitted solution, per
    coefficient; the last position is the intercept."""
    df = stage(tb.snapshot(spark, d), "training")
    bundle = md.train(df, CFG)
    train = sp.stratified_split(df, CFG).where("split = 'train'")
    fitted, size = bundle.model.stages[-1], bundle.meta["train_rows"]
    positives = round(bundle.meta["train_positive_rate"] * size)
    y = F.col("churn")
    error = (vector_to_array(F.col("probability"))[1] - y) * md.class_weight(y, positives, size)
    x = F.concat(vector_to_array(F.col(pr.FEATURES)), F.array(F.lit(1.0)))
    parts = bundle.model.transform(train).select(error.alias("e"), F.posexplode(x))
    sums = parts.groupBy(F.col("pos").alias("position")).agg(F.sum(F.col("e") * F.col("col")).alias("g"))
    pulls = spark.createDataFrame(
        list(enumerate([*map(float, fitted.coefficients), 0.0])), "position int, pull double"
    )
    slope = (F.col("g") + F.col("pull")) / size
    return sums.join(pulls, "position").select("position", (F.abs(slope) < 1e-6).alias("optimal"))


@query
def train_then_score(spark: SparkSession, d: str) -> DataFrame:
    """What must hold for rows scored by a freshly fitted model."""
    df = stage(tb.snapshot(spark, d), "training")
    scored, _ = runs.score_batch(df.drop("churn"), md.train(df, CFG), CFG)
    band = f"CASE WHEN {P} >= {CFG.high_risk} THEN 'high' WHEN {P} >= {CFG.medium_risk} THEN 'medium' ELSE 'low' END"
    checks = {
        "every row is scored": f"count({P}) = {df.count()}",
        "probabilities": f"bool_and({P} BETWEEN 0 AND 1)",
        "ranks": "count(DISTINCT review_rank) = count(*) AND min(review_rank) = 1 AND max(review_rank) = count(*)",
        "labels": f"bool_and(predicted_label = CAST({P} >= {CFG.decision_threshold} AS INT))",
        "bands": f"bool_and(risk_band = {band})",
        "queue": f"count_if(review_queue_flag) = least(count(*), {CFG.top_k})",
    }
    aggs = {f"c{i}": e for i, e in enumerate(checks.values())}
    rows = [{"name": text(n), "passed": f"c{i}"} for i, n in enumerate(checks)]
    return to_rows(aggregate(scored, aggs), rows, (("name", "string"), ("passed", "boolean")))


@query
def challenger(spark: SparkSession, d: str) -> DataFrame:
    """Both models on the test part: its size, what must hold for the scores, and whether the
    report's numbers are those of the scored rows."""
    df = stage(tb.snapshot(spark, d), "training")
    _, scored = ch.challenge(df, CFG, trees=10)
    report = {r["model"]: r for r in ch.compare(scored, CFG).collect()}
    t, y = CFG.decision_threshold, "churn"
    aggs = {"rows": "count(*)", "ids": "count(DISTINCT customer_id)", "positives": f"sum({y})"}
    rows = [{"name": f"'test {c}'", "passed": "true", "value": c} for c in aggs]
    for i, (name, r) in enumerate(report.items()):
        hit = f"count_if({name} >= {t} AND {y} = 1)"
        aggs |= {
            f"range{i}": f"bool_and({name} BETWEEN 0 AND 1)",
            f"counts{i}": f"{hit} = {r['true_positives']} AND count_if({name} >= {t}) = {r['positive_predictions']}",
            f"brier{i}": f"abs(avg(power({name} - {y}, 2)) - {r['brier_score']!r}D) < 1e-9",
            f"recall{i}": f"abs({hit} / count_if({y} = 1) - {r['recall']!r}D) < 1e-9",
            f"better{i}": f"avg({y}) < {r['pr_auc']!r}D",
        }
        rows += [{"name": text(f"{n} of {name}"), "passed": f"{n}{i}"} for n in ("range", "counts", "brier", "recall", "better")]
    return to_rows(aggregate(scored, aggs), rows, (("name", "string"), ("passed", "boolean"), ("value", "long")))


@query
def scorecard(spark: SparkSession, d: str) -> DataFrame:
    df = tb.scored_snapshot(spark, d)
    label = mt.predicted_label(P, CFG.decision_threshold)
    return rounded(df.selectExpr("customer_id", P, f"{label} AS predicted_label"))


# ---- metrics ----------------------------------------------------------------------


@query
def baseline_metrics(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, ["support_tickets", "churn"])
    return rounded(mt.evaluate_rule(df, CFG))


@query
def model_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mt.model_metrics(labelled(spark, d), CFG, P))


@query
def metric_comparison(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mt.metric_comparison(labelled(spark, d), CFG, P))


@query
def average_precision(spark: SparkSession, d: str) -> DataFrame:
    df = staged_labelled(spark, d)
    return rounded(mt.average_precision(df, CFG, P))


@query
def brier(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mt.brier(labelled(spark, d), CFG, P))


@query
def bands(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, ["customer_id", "age", "support_tickets"])
    return df.selectExpr(
        "customer_id",
        f"{age_band(num(df.schema, 'age'))} AS age_band",
        f"{ticket_band(num(df.schema, 'support_tickets'))} AS support_ticket_band",
    )


@query
def slice_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mt.slice_metrics(labelled(spark, d, SLICED), CFG, P))


def test_rows(spark: SparkSession, d: str) -> DataFrame:
    return stage(staged_split(spark, d, SLICED).where("split = 'test'").drop("split"), "test")


@query
def evaluation_overall(spark: SparkSession, d: str) -> DataFrame:
    return rounded(runs.evaluate(test_rows(spark, d), CFG)["model_metrics"])


@query
def evaluation_slices(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mt.slice_metrics(test_rows(spark, d), CFG, P))


@query
def evaluation_findings(spark: SparkSession, d: str) -> DataFrame:
    test = test_rows(spark, d)
    return rounded(
        mt.evaluation_findings(
            mt.metric_comparison(test, CFG, P), mt.slice_metrics(test, CFG, P)
        )
    )


# ---- scoring ----------------------------------------------------------------------


@query
def risk_bands(spark: SparkSession, d: str) -> DataFrame:
    df = sc.label_and_band(tb.scored_snapshot(spark, d), CFG)
    return df.select("customer_id", "predicted_label", "risk_band")


@query
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    df = stage(tb.scored_snapshot(spark, d).select("customer_id", P), "queue")
    return rounded(sc.review_queue(df, CFG))


@query
def review_queue_text_ids(spark: SparkSession, d: str) -> DataFrame:
    """Text ids and many ties: rank, flag and top list follow one order."""
    df = tb.scored_snapshot(spark, d).select(
        F.col("customer_id").cast("string").alias("customer_id"), F.round(P, 1).alias(P)
    )
    df = stage(df, "queue")
    top = sc.top_of_queue(df, CFG).select("customer_id", F.lit(True).alias("listed"))
    ranked = sc.review_queue(df, CFG).join(top, "customer_id", "left")
    return ranked.select("customer_id", "review_rank", "review_queue_flag", F.coalesce("listed", F.lit(False)).alias("listed"))


@query
def top_k_queue(spark: SparkSession, d: str) -> DataFrame:
    df = tb.scored_snapshot(spark, d).select("customer_id", P)
    return rounded(sc.top_of_queue(df, CFG))


@query
def batch_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sc.batch_summary(tb.scored_snapshot(spark, d), CFG))


@query
def scoring_findings(spark: SparkSession, d: str) -> DataFrame:
    return sc.scoring_findings(sc.batch_summary(tb.scored_snapshot(spark, d), CFG))


# ---- drift ------------------------------------------------------------------------

_WATCHED = (*LABELLED, "signup_date", *CFG.monitor_numeric[:-1], *CFG.monitor_categorical)
_WATCHED = tuple(dict.fromkeys(_WATCHED))
DRIFT_CFG = CFG
_IS_REF = f"signup_date < DATE '{tb.REFERENCE_END}'"
_IS_CUR = f"NOT {_IS_REF}"


def watched(spark: SparkSession, d: str, columns: Iterable[str] = _WATCHED) -> DataFrame:
    """The scored snapshot with tenure, both batches."""
    return stage(ft.tenure_days(labelled(spark, d, columns), CFG), "drift")


def two_batches(spark: SparkSession, d: str, columns: Iterable[str] = _WATCHED):
    """(reference rows, current rows) of the scored snapshot with tenure."""
    df = watched(spark, d, columns)
    return df.where(_IS_REF), df.where(_IS_CUR)


_EVENT_IS_REF = f"ts < TIMESTAMP_NTZ '{tb.EVENTS_REFERENCE_END}'"


def watched_events(spark: SparkSession, d: str) -> DataFrame:
    return tb.table(spark, d, "events").select("ts", "event_type", "value")


def event_batches(spark: SparkSession, d: str):
    df = watched_events(spark, d)
    return df.where(_EVENT_IS_REF), df.where(f"NOT ({_EVENT_IS_REF})")


@query
def ref_numeric(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dr.reference_numeric(two_batches(spark, d)[0], CFG))


@query
def ref_categorical(spark: SparkSession, d: str) -> DataFrame:
    ref, _ = two_batches(spark, d, ["signup_date", *CFG.monitor_categorical])
    return rounded(dr.reference_categorical(ref, CFG))


@query
def drift_numeric(spark: SparkSession, d: str) -> DataFrame:
    ref, cur = two_batches(spark, d)
    return rounded(dr.numeric_drift(cur, dr.reference_numeric(ref, CFG), CFG))


@query
def drift_categorical(spark: SparkSession, d: str) -> DataFrame:
    ref, cur = two_batches(spark, d, ["signup_date", *CFG.monitor_categorical])
    return rounded(dr.categorical_drift(cur, dr.reference_categorical(ref, CFG), CFG))


@query
def drift_status(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dr.tagged_drift(watched(spark, d), _IS_REF, CFG))


@query
def drift_events(spark: SparkSession, d: str) -> DataFrame:
    return rounded(dr.tagged_drift(watched_events(spark, d), _EVENT_IS_REF, tb.events_config()))


def _prediction(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(both batches, prediction drift)"""
    df = watched(spark, d)
    ref, cur = df.where(_IS_REF), df.where(_IS_CUR)
    held = sp.split_counts(sp.stratified_split(ref, CFG), CFG).where("split = 'validation'")
    row = held.first()
    meta = {"validation_positive_rate": row["positive_rate"], "validation_rows": row["rows"]}
    return df, dr.prediction_drift(sc.batch_summary(cur, CFG), meta)


@query
def drift_prediction(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_prediction(spark, d)[1])


@query
def drift_findings(spark: SparkSession, d: str) -> DataFrame:
    df, prediction = _prediction(spark, d)
    return rounded(dr.drift_findings(dr.tagged_drift(df, _IS_REF, CFG), prediction))


def _event_reference(spark: SparkSession, d: str):
    """(reference numbers, reference shares, later events)"""
    ref, cur = event_batches(spark, d)
    cfg = tb.events_config()
    numeric = stage(dr.reference_numeric(ref, cfg), "event-numbers")
    return numeric, stage(dr.reference_categorical(ref, cfg), "event-shares"), cur


def _by_day(found: DataFrame) -> DataFrame:
    return rounded(found.withColumn("window_start", F.to_date("window_start")))


@query
def drift_windows(spark: SparkSession, d: str) -> DataFrame:
    """Drift of every day after the reference events."""
    numeric, shares, cur = _event_reference(spark, d)
    return _by_day(win.drift_by_window(cur, numeric, shares, tb.events_config()))


@query
def drift_windows_streamed(spark: SparkSession, d: str) -> DataFrame:
    """The same from files of two days each that arrive one after the other, a few of their rows
    eight days late: drift of the days that the watermark has closed."""
    numeric, shares, _ = _event_reference(spark, d)
    folder, out = fresh_path(spark, "event-files"), fresh_path(spark, "event-drift")
    events, last = tb.arriving_events(spark, d)
    for i in range(last + 1):
        events.where(F.col("arrives") == i).drop("arrives").write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.drop("arrives").schema).option("maxFilesPerTrigger", 1).parquet(folder)
    win.monitor_windows(
        stream, numeric, shares, tb.events_config(), out, f"{out}.checkpoint", "1 day", "2 days"
    ).awaitTermination()
    return _by_day(spark.read.parquet(out).drop("batch"))


@query
def psi(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ext.stability_index(*two_batches(spark, d), CFG.monitor_numeric))


@query
def ks(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ext.kolmogorov_smirnov(*two_batches(spark, d), CFG.monitor_numeric))


@query
def unknown_rate(spark: SparkSession, d: str) -> DataFrame:
    """The reference is taken from accounts in credit, so the status of the others is unknown."""
    ref, cur = two_batches(spark, d, ["signup_date", "monthly_income", *CFG.monitor_categorical])
    seen = dr.reference_categorical(ref.where("monthly_income >= 0"), CFG)
    return rounded(ext.unknown_rate(cur, seen, CFG))


@query
def calibration(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ext.calibration(labelled(spark, d), CFG, P))


@query
def calibration_deciles(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ext.calibration_deciles(staged_labelled(spark, d), CFG, P))


@query
def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, ["customer_id", "signup_date"])
    return ext.calendar_features(df, CFG).drop("signup_date")


@query
def keyword_rates(spark: SparkSession, d: str) -> DataFrame:
    df = tb.table(spark, d, "documents").select("source", "text")
    return rounded(ext.keyword_rates(df, tb.documents_config(), ("poor", "issue", *tb.DOCUMENT_KEYWORDS), "source"))


def _sketches(spark: SparkSession, d: str) -> DataFrame:
    """Sketches of the scored snapshot, a batch per quarter of sign-up."""
    scored = tb.scored_snapshot(spark, d, [*tb.SCORE_COLUMNS, "signup_date"])
    quarter = F.concat_ws("-Q", F.year("signup_date"), F.quarter("signup_date"))
    return stage(hs.score_sketch(scored.withColumn("quarter", quarter), "quarter", P), "sketches")


@query
def score_shift(spark: SparkSession, d: str) -> DataFrame:
    """The sign-ups of a quarter against those of the one before, both from a stored history."""
    path = fresh_path(spark, "history")
    hs.append_history(_sketches(spark, d), path)
    history = hs.read_history(spark, path)
    return rounded(hs.score_shift(hs.latest_before(history, "1995-Q2"), history.where("batch = '1995-Q2'")))


@query
def score_collapse(spark: SparkSession, d: str) -> DataFrame:
    return rounded(hs.batch_spread(_sketches(spark, d), 0.26))


@query
def score_findings(spark: SparkSession, d: str) -> DataFrame:
    sketches = _sketches(spark, d)
    return rounded(hs.shift_findings(sketches.where("batch = '1995-Q1'"), sketches.where("batch = '1995-Q2'"), 0.01, 0.26))


@query
def promotion_gate(spark: SparkSession, d: str) -> DataFrame:
    """A scorecard without the income against the fixed one, on the test part."""
    test = test_rows(spark, d).withColumn("candidate", tb.candidate_probability())
    return rounded(gt.promotion_gate(test, CFG, P, "candidate"))


@query
def review_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Sign-ups wait in the queue of their day; the next click, purchase or error of the user
    within three days is what came of it."""
    events = tb.table(spark, d, "events").select("user_id", "ts", "event_type")
    queue = events.where("event_type = 'signup'").withColumn("day", F.to_date("ts"))
    outcomes = {"click": rv.REVIEWED, "purchase": rv.CONTACTED, "error": rv.OVERRIDDEN}
    found = rv.next_events(queue, events, outcomes, "3 DAYS", "user_id", "ts", "day", "ts", "event_type")
    return rounded(rv.review_metrics(found))


@query
def time_split(spark: SparkSession, d: str) -> DataFrame:
    df = stage(tb.snapshot(spark, d, ["customer_id", "signup_date"]), "split")
    return ext.time_split(df, CFG).select("customer_id", "split")


@query
def delayed_labels(spark: SparkSession, d: str) -> DataFrame:
    """Documents scored by length, with the quality labels that have arrived, per source."""
    cfg = tb.documents_config()
    score = F.least(F.lit(1.0), F.col("n_chars") / F.lit(4000.0))
    scored = tb.table(spark, d, "documents").select("doc_id", "source", score.alias(P))
    return rounded(ext.delayed_metrics(scored, tb.table(spark, d, "labels"), cfg, P, "source"))


@query
def top_reasons(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, tb.SCORE_COLUMNS)
    terms = {
        "support_tickets": "0.55D * support_tickets",
        "monthly_income": "8e-5D * monthly_income",
        "age": "0.01D * (age - 60)",
    }
    return ext.top_reasons(df, terms, 2).select("customer_id", "top_reasons")


@query
def batch_checks(spark: SparkSession, d: str) -> DataFrame:
    df = tb.snapshot(spark, d, ["customer_id", "signup_date", "age"])
    types = {"customer_id": "bigint", "age": "bigint", "signup_date": "date"}
    return ext.batch_checks(df, CFG, 1, 10**12, "2002-01-01", 365, types)


# ---- profile ----------------------------------------------------------------------


@query
def profile_overview(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pf.overview(tb.snapshot(spark, d), CFG))


@query
def target_distribution(spark: SparkSession, d: str) -> DataFrame:
    return pf.target_distribution(documents_labels(spark, d), tb.documents_config())


@query
def numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pf.numeric_profile(stage(tb.snapshot(spark, d, CFG.numeric), "profile"), CFG))


@query
def categorical_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pf.categorical_profile(tb.snapshot(spark, d, CFG.categorical), CFG))


@query
def categorical_top3(spark: SparkSession, d: str) -> DataFrame:
    return pf.categorical_top(tb.snapshot(spark, d, CFG.categorical), CFG)


@query
def categorical_top3_documents(spark: SparkSession, d: str) -> DataFrame:
    cfg = tb.documents_config().with_(categorical=("lang", "source", "quality"))
    return pf.categorical_top(documents_labels(spark, d), cfg)


@query
def date_profile(spark: SparkSession, d: str) -> DataFrame:
    return pf.date_profile(tb.snapshot(spark, d, ["signup_date"]), CFG)


@query
def date_profile_events(spark: SparkSession, d: str) -> DataFrame:
    """Two date columns: the time stamps, and their days."""
    df = tb.table(spark, d, "events").select("ts", F.to_date("ts").alias("day"))
    return pf.date_profile(df, tb.events_config().with_(date_columns=("ts", "day")))


@query
def text_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pf.text_profile(tb.snapshot(spark, d, ["customer_feedback"]), CFG))


@query
def text_profile_documents(spark: SparkSession, d: str) -> DataFrame:
    """Two text columns."""
    cfg = tb.documents_config().with_(text_columns=("text", "source"))
    return rounded(pf.text_profile(tb.table(spark, d, "documents"), cfg))


@query
def profile_findings(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pf.profile_findings(stage(tb.snapshot(spark, d), "findings"), CFG))


# ---- where rows come from ---------------------------------------------------------

_HASHED = ("documents", "labels", "conversations", "benchmark", "nation")


@query
def run_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Rows and content hash of input tables, whatever files they come in."""
    parts = [
        ln.content_hash(tb.table(spark, d, t)).select(F.lit(t).alias("input"), "*") for t in _HASHED
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def scored_provenance(spark: SparkSession, d: str) -> DataFrame:
    """Scored rows that carry the run they come from."""
    batch = stage(tb.snapshot(spark, d, tb.SCORE_COLUMNS), "batch")
    found = ln.content_hash(batch, ["customer_id", "age", "support_tickets"]).first()
    run = ln.Run("run-1", "snapshot", found["rows"], found["content_hash"], "scorecard", "1", "2024-01-01T00:00:00+00:00")
    scored = ln.stamp(batch.withColumn(P, tb.scorecard_probability()), run)
    return rounded(scored.select("customer_id", P, *ln.STAMP))


# ---- output checks ----------------------------------------------------------------


def staged_queue(spark: SparkSession, d: str) -> DataFrame:
    df = stage(tb.scored_snapshot(spark, d).select("customer_id", P), "queue")
    return stage(sc.review_queue(df, CFG), "ranked")


@query
def verify_predictions(spark: SparkSession, d: str) -> DataFrame:
    return vf.verify_scored(staged_queue(spark, d), CFG, CFG.top_k)


@query
def verify_predictions_broken(spark: SparkSession, d: str) -> DataFrame:
    """A queue with damaged probabilities, ranks, bands, flags and priorities."""
    c = F.col
    broken = staged_queue(spark, d).withColumns(
        {
            P: F.when(c("risk_band") == "high", c(P) + 1).when(c(P) < 0.2, None).otherwise(c(P)),
            "review_rank": F.when(c(P).between(0.5, 0.52), 7).otherwise(c("review_rank")),
            "risk_band": F.when(c(P).between(0.6, 0.65), "severe").otherwise(c("risk_band")),
            "review_queue_flag": F.when(c(P) < 0.25, True).otherwise(c("review_queue_flag")),
        }
    )
    return vf.verify_scored(broken, CFG, CFG.top_k)


@query
def invalid_bands(spark: SparkSession, d: str) -> DataFrame:
    df = sc.label_and_band(tb.scored_snapshot(spark, d), CFG)
    odd = F.when(F.col("monthly_income") < 0, F.concat(F.lit("x-"), "risk_band"))
    return vf.invalid_bands(df.withColumn("risk_band", F.coalesce(odd, "risk_band")))


@query
def scored_details(spark: SparkSession, d: str) -> DataFrame:
    return rounded(vf.scored_details(staged_queue(spark, d)))


def evaluation_report(spark: SparkSession, d: str) -> DataFrame:
    return runs.evaluation_report(runs.evaluate(test_rows(spark, d), CFG))


@query
def report_sections(spark: SparkSession, d: str) -> DataFrame:
    report = stage(evaluation_report(spark, d), "report")
    wanted = (*vf.EVALUATION_SECTIONS, "slice_metrics", "appendix")
    return vf.verify_report(report, "evaluation_report", wanted, spark)


@query
def handoff(spark: SparkSession, d: str) -> DataFrame:
    """Train, score, evaluate, monitor, write everything, then check what was written."""
    df = stage(tb.snapshot(spark, d), "training")
    bundle = md.train(df, CFG)
    out = fresh_path(spark, "handoff")
    outputs.save_bundle(bundle, f"{out}/bundle")
    batch = df.drop("churn")
    scored, summary = runs.score_batch(batch, bundle, CFG)
    outputs.write_scored(scored, summary, f"{out}/scored", f"{out}/summary")
    held = sp.stratified_split(df, CFG).where("split = 'test'").drop("split")
    tables = runs.evaluate(stage(bundle.predict_proba(held), "evaluation"), CFG)
    outputs.write_report(runs.evaluation_report(tables), f"{out}/evaluation")
    tables = runs.monitor(batch, bundle, summary, CFG)
    outputs.write_report(runs.drift_report(tables), f"{out}/drift")
    checks = runs.run_handoff(
        spark, f"{out}/bundle", f"{out}/scored", CFG, f"{out}/evaluation", f"{out}/drift",
        CFG.top_k,
    )
    return vf.handoff([checks])
