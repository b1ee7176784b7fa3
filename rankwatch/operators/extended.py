"""Measures around the model: scale-free drift, calibration, late labels, reasons, time cuts."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.config import Config
from rankwatch.functions.rows import aggregate, to_rows, unpivot
from rankwatch.functions.values import day, double, num, quoted, ratio, text
from rankwatch.operators.metrics import confusion, predicted_label
from rankwatch.operators.ordering import Target, order_statistics, running_totals
from rankwatch.operators.quality import category_counts

BINS = 10
FLOOR = 1e-4  # least share of a bin, so that an empty one has a logarithm


def _present(df: DataFrame, columns: Iterable[str]) -> dict[str, int]:
    aggs = {c: f"count({num(df.schema, c)})" for c in columns}
    return aggregate(df, aggs).first().asDict()


def decile_edges(ref: DataFrame, columns: Iterable[str]) -> dict[str, list[float]]:
    """Exact decile edges of the present values: the value at position ceil(n i / 10)."""
    counts = _present(ref, columns)
    targets = {
        f"{c}|{i}": Target(F.expr(num(ref.schema, c)), *[(n * i + BINS - 1) // BINS - 1] * 2, n)
        for c, n in counts.items()
        for i in range(1, BINS)
        if n
    }
    found = order_statistics(ref, targets)
    return {c: [found[f"{c}|{i}"].low for i in range(1, BINS)] for c, n in counts.items() if n}


def stability_index(ref: DataFrame, cur: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(feature, psi): sum over the reference's deciles of (p - q) ln(p / q).

    Each side is one grouped count of at most ten rows per feature. Missing values take no
    part; a side without values gives null."""
    edges = decile_edges(ref, columns)
    if not edges:
        return ref.sparkSession.createDataFrame([], "feature string, psi double")

    def binned(df: DataFrame, side: str) -> DataFrame:
        values = {
            c: f"CASE WHEN ({num(df.schema, c)}) IS NOT NULL THEN "
            + " + ".join(f"CAST(({num(df.schema, c)}) > {double(x)} AS INT)" for x in e)
            + " END"
            for c, e in edges.items()
        }
        long = unpivot(df, [], values, "feature", "bin").where("bin IS NOT NULL")
        return long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))

    bins = ", ".join(f"'{i}'" for i in range(BINS))
    names = ", ".join(f"({text(c)})" for c in edges)
    grid = ref.sparkSession.sql(f"SELECT feature, explode(array({bins})) AS bin FROM VALUES {names} AS t(feature)")
    counts = (
        binned(ref, "ref").unionByName(binned(cur, "cur"))
        .groupBy("feature", "bin").pivot("side", ["ref", "cur"]).agg(F.sum("n"))
    )
    full = grid.join(counts, ["feature", "bin"], "left")
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("ref_n"), F.sum("cur").alias("cur_n"))
    p = f"greatest(coalesce(ref, 0) / ref_n, {double(FLOOR)})"
    q = f"greatest(coalesce(cur, 0) / cur_n, {double(FLOOR)})"
    return full.join(totals, "feature").groupBy("feature").agg(F.expr(f"sum(({p} - {q}) * ln({p} / {q})) AS psi"))


def kolmogorov_smirnov(ref: DataFrame, cur: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(feature, ks): largest distance of the two distribution functions.

    Rows collapse to one per distinct value; running counts are taken inside slices."""
    parts = []
    for c in columns:
        rows = reduce(
            DataFrame.unionByName,
            [
                df.selectExpr(f"{num(df.schema, c)} AS v", f"{a} AS r", f"{1 - a} AS c").where("v IS NOT NULL")
                for df, a in ((ref, 1), (cur, 0))
            ],
        )
        steps = rows.groupBy("v").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
        run = running_totals(steps, "v", {"cr": "r", "cc": "c"}, rows)
        total = aggregate(run, {"nr": "max(cr)", "nc": "max(cc)"}).first()
        distance = f"max(abs(cr / {total['nr'] or 'NULL'} - cc / {total['nc'] or 'NULL'}))"
        parts.append(aggregate(run, {"ks": distance}).selectExpr(f"{text(c)} AS feature", "CAST(ks AS DOUBLE) AS ks"))
    return reduce(DataFrame.unionByName, parts)


def unknown_rate(batch: DataFrame, ref_categorical: DataFrame, cfg: Config) -> DataFrame:
    """(feature, unknown_values, unknown_rate): values the reference has never seen.

    Joined after counting: one row per distinct value on both sides."""
    counts = category_counts(batch, list(cfg.monitor_categorical))
    known = ref_categorical.select("feature", "value", F.lit(True).alias("known"))
    new = "CASE WHEN known IS NULL THEN n ELSE 0 END"
    return (
        counts.join(known, ["feature", "value"], "left")
        .groupBy("feature")
        .agg(
            F.expr("count_if(known IS NULL) AS unknown_values"),
            F.expr(f"{ratio(f'sum({new})', 'sum(n)')} AS unknown_rate"),
        )
    )


def calibration(df: DataFrame, cfg: Config, score: str) -> DataFrame:
    """(bin, rows, mean_score, positive_rate) by tenths of the score; missing scores or labels
    take no part."""
    y, p = num(df.schema, cfg.target_column), num(df.schema, score)
    return (
        df.selectExpr(f"{p} AS p", f"{y} AS y")
        .where("p IS NOT NULL AND y IS NOT NULL")
        .groupBy(F.expr(f"CAST(least({BINS - 1}, greatest(0, floor(p * {BINS}))) AS INT) AS bin"))
        .agg(
            F.expr("count(*) AS rows"),
            F.expr("avg(p) AS mean_score"),
            F.expr("avg(y) AS positive_rate"),
        )
    )


def calibration_deciles(df: DataFrame, cfg: Config, score: str) -> DataFrame:
    """(decile, rows, lowest, highest, mean_score, positive_rate) by tenths of the rows in order of
    the score; equal scores stay together, in the tenth in which the first of them lies."""
    y, p = num(df.schema, cfg.target_column), num(df.schema, score)
    rows = df.selectExpr(f"{p} AS p", f"{y} AS y").where("p IS NOT NULL AND y IS NOT NULL")
    edges = decile_edges(rows, ["p"]).get("p", [])
    # The last row of tenth i is at edge i, so what is above it belongs to a later tenth.
    decile = " + ".join(["0", *(f"CAST(p > {double(e)} AS INT)" for e in edges)])
    return rows.groupBy(F.expr(f"{decile} AS decile")).agg(
        F.expr("count(*) AS rows"), F.expr("min(p) AS lowest"), F.expr("max(p) AS highest"),
        F.expr("avg(p) AS mean_score"), F.expr("avg(y) AS positive_rate"),
    )


def calendar_features(df: DataFrame, cfg: Config) -> DataFrame:
    """Append `signup_month` (1 to 12) and `signup_year`; null without a date."""
    value = day(df.schema, cfg.date_column, cfg.date_format)
    return df.withColumns({"signup_month": F.expr(f"month({value})"), "signup_year": F.expr(f"year({value})")})


def keyword_rates(df: DataFrame, cfg: Config, words: Iterable[str], by: str) -> DataFrame:
    """(group, rows, word, rate): how many texts of a group hold each word, in any case. Missing
    texts hold none. One scan and one shuffle of partial counts."""
    value = f"lower(coalesce({quoted(cfg.text_column)}, ''))"
    words = list(words)
    sums = [F.expr(f"count_if(contains({value}, {text(w.lower())})) AS w{i}") for i, w in enumerate(words)]
    one = df.groupBy(F.expr(f"CAST({quoted(by)} AS STRING) AS `group`")).agg(F.count(F.lit(1)).alias("rows"), *sums)
    pairs = ", ".join(f"named_struct('word', {text(w)}, 'rate', w{i} / rows)" for i, w in enumerate(words))
    return one.selectExpr("`group`", "rows", f"inline(array({pairs}))")


def time_split(df: DataFrame, cfg: Config) -> DataFrame:
    """Append `split`: the latest share of rows is the test part, the share before it the
    validation part. Rows of one day stay together, on the later side; rows without a date train."""
    value = f"CAST(unix_date(to_date({day(df.schema, cfg.date_column, cfg.date_format)})) AS DOUBLE)"
    n = aggregate(df, {"n": f"count({value})"}).first()["n"]
    if not n:
        return df.withColumn("split", F.lit("train"))
    held = math.ceil(cfg.test_size * n)
    more = min(n, held + math.ceil(cfg.validation_size * n))
    v = F.expr(value)
    targets = {k: Target(v, n - m, n - m, n) for k, m in (("test", held), ("validation", more))}
    found = order_statistics(df, targets)
    return df.withColumn(
        "split",
        F.when(v >= found["test"].low, "test").when(v >= found["validation"].low, "validation").otherwise("train"),
    )


def delayed_metrics(
    history: DataFrame, labels: DataFrame, cfg: Config, score: str, batch: str
) -> DataFrame:
    """Metrics per batch of scored rows whose labels have arrived since, and how many have.

    `labels` has one row per id; every scored row is kept."""
    y = num(labels.schema, cfg.target_column)
    late = labels.select(quoted(cfg.id_column), F.expr(y).alias("_y"))
    rows = history.join(late, cfg.id_column, "left")
    label = predicted_label(score, cfg.decision_threshold)
    seen = rows.selectExpr(f"{quoted(batch)} AS batch", "_y", f"CASE WHEN _y IS NOT NULL THEN {label} END AS _pred")
    arrived = seen.groupBy("batch").agg(
        F.expr("count(*) AS scored_rows"), F.expr("count(_y) AS labelled_rows")
    )
    measured = confusion(seen.where("_y IS NOT NULL"), "_y", "_pred", ["batch"])
    return arrived.join(
        measured.select("batch", "true_positives", "accuracy", "precision", "recall", "f1_score"), "batch", "left"
    )


def top_reasons(df: DataFrame, contributions: Mapping[str, str], k: int = 3, out: str = "top_reasons") -> DataFrame:
    """Append the names of the k largest contributions to a linear score, largest first, ties by
    name; an expression per row, nothing is exploded."""
    entries = ", ".join(
        f"named_struct('c', -coalesce(CAST({e} AS DOUBLE), 0D), 'name', {text(n)})" for n, e in contributions.items()
    )
    return df.withColumn(out, F.expr(f"array_join(transform(slice(array_sort(array({entries})), 1, {k}), x -> x.name), ',')"))


def batch_checks(
    df: DataFrame, cfg: Config, least: int, most: int, as_of: str, max_age_days: int, types: Mapping[str, str]
) -> DataFrame:
    """(name, passed): row count inside its bounds, newest date fresh enough, expected types."""
    value = day(df.schema, cfg.date_column, cfg.date_format)
    kinds = dict(df.dtypes)
    one = aggregate(df, {"n": "count(*)", "newest": f"to_date(max({value}))"})
    age = f"datediff(DATE '{as_of}', newest)"
    rows = [
        {"name": "'row_count'", "passed": f"n BETWEEN {least} AND {most}"},
        {"name": "'freshness'", "passed": f"coalesce({age} <= {max_age_days}, false)"},
        *({"name": text(f"type of {c}"), "passed": str(kinds.get(c) == t).lower()} for c, t in types.items()),
    ]
    return to_rows(one, rows, (("name", "string"), ("passed", "boolean")))
