"""Equivalent SQL of the registered queries, written independently of the operators."""

from __future__ import annotations

from collections.abc import Iterable

from rankwatch.config import Config
from rankwatch.sources.tables import EVENTS_REFERENCE_END, REFERENCE_END, SNAPSHOT_COLUMNS

CFG = Config()
NUMERIC, CATEGORICAL = CFG.numeric, CFG.categorical

# ---- building blocks --------------------------------------------------------------

SNAP = """
WITH o AS (SELECT o_custkey, min(o_orderdate) AS first_o, max(o_orderdate) AS last_o,
                  avg(o_totalprice) AS avg_bill,
                  sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent
           FROM orders GROUP BY o_custkey),
     l AS (SELECT o_custkey, avg(l_quantity) AS avg_qty, count(*) AS n_lines
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
     t AS (SELECT max(o_orderdate) AS obs FROM orders),
     s AS (SELECT c_custkey AS customer_id, CAST(coalesce(first_o, obs) AS DATE) AS signup_date,
                  CAST(18 + c_custkey % 90 AS INT) AS age,
                  CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
                  n_name AS city, r_name AS education_level,
                  CASE WHEN c_acctbal < 0 THEN 'debit' WHEN c_acctbal < 5000 THEN 'low'
                       ELSE 'high' END AS employment_status,
                  c_acctbal AS monthly_income, avg_bill AS monthly_bill,
                  avg_qty AS internet_usage_gb, CAST(n_lines AS DOUBLE) AS call_minutes,
                  c_mktsegment AS contract_type, CAST(coalesce(urgent, 0) AS INT) AS support_tickets,
                  d.text AS customer_feedback,
                  CASE WHEN last_o < obs - INTERVAL 240 DAYS THEN 1 ELSE 0 END AS churn
           FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey
                LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey
                CROSS JOIN t LEFT JOIN documents d ON d.doc_id = c_custkey)"""

SCORED = SNAP + """,
     z AS (SELECT *, -1.6e0 + 5.5e-1 * support_tickets + 8e-5 * monthly_income
                     + 1e-2 * (age - 60) AS z FROM s),
     p AS (SELECT *, 1e0 / (1e0 + exp(-z)) AS churn_probability FROM z),
     sc AS (SELECT *, CAST(churn_probability >= 5e-1 AS INT) AS predicted_label,
                   CASE WHEN churn_probability >= 7.5e-1 THEN 'high'
                        WHEN churn_probability >= 5e-1 THEN 'medium' ELSE 'low' END AS risk_band,
                   CAST(support_tickets >= 3 AS INT) AS rule_label
            FROM p)"""

RANKED = SCORED + """,
     rk AS (SELECT *, row_number() OVER (ORDER BY churn_probability DESC, customer_id)
                   AS review_rank FROM sc),
     q AS (SELECT *, review_rank <= 100 AS review_queue_flag,
                  CASE WHEN review_rank <= 100 THEN 'review' ELSE 'monitor' END
                  AS review_priority FROM rk)"""


_BY_ID = "substr(md5('42|' || customer_id), 1, 13), customer_id"


def split_ctes(source: str, order: str = _BY_ID) -> str:
    """CTEs ending in `sp`: the rows of `source` with their part."""
    return f""",
     sn AS (SELECT count(*) AS n FROM {source}),
     sk AS (SELECT n, n - CAST(ceil(2e-1 * n) AS BIGINT) AS rest FROM sn),
     sv AS (SELECT n, rest,
                   rest - CAST(ceil(2e-1 / (1e0 - 2e-1) * rest) AS BIGINT) AS fit FROM sk),
     c0 AS (SELECT churn, count(*) AS k FROM {source} GROUP BY churn),
     c1 AS (SELECT churn, k, n, rest, fit, CAST(rest AS DOUBLE) * k / n AS x FROM c0, sv),
     c2 AS (SELECT *, floor(x) AS f, sum(floor(x)) OVER () AS tf,
                   row_number() OVER (ORDER BY x - floor(x) DESC, churn) AS pos FROM c1),
     c3 AS (SELECT churn, k, rest, fit,
                   CAST(f + CASE WHEN pos <= rest - tf THEN 1 ELSE 0 END AS BIGINT) AS kept
            FROM c2),
     c4 AS (SELECT *, CAST(fit AS DOUBLE) * kept / rest AS x FROM c3),
     c5 AS (SELECT *, floor(x) AS f, sum(floor(x)) OVER () AS tf,
                   row_number() OVER (ORDER BY x - floor(x) DESC, churn) AS pos FROM c4),
     c6 AS (SELECT churn, k, kept,
                   CAST(f + CASE WHEN pos <= fit - tf THEN 1 ELSE 0 END AS BIGINT) AS trained
            FROM c5),
     sr AS (SELECT {source}.*, row_number() OVER (PARTITION BY churn ORDER BY
                   {order}) AS rn FROM {source}),
     sp AS (SELECT sr.*, CASE WHEN rn <= k - kept THEN 'test'
                              WHEN rn <= k - trained THEN 'validation' ELSE 'train' END AS split
            FROM sr JOIN c6 USING (churn))"""


SPLIT = SCORED + split_ctes("sc")
_TEST = "te"
TESTED = SPLIT + ", te AS (SELECT * FROM sp WHERE split = 'test')"


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0e0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


def counts(label: str, pred: str, prefix: str = "") -> str:
    """Select list of the confusion counts."""
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    items = [
        f"count(*) FILTER (WHERE {label} = {y} AND {pred} = {x}) AS {prefix}{n}"
        for n, (y, x) in cells.items()
    ]
    items.append(f"count(*) AS {prefix}n")
    return ", ".join(items)


def named(prefix: str = "") -> dict[str, str]:
    """Metric name -> expression over the confusion counts."""
    tn, fp, fn, tp = (prefix + c for c in ("tn", "fp", "fn", "tp"))
    precision, recall = ratio(tp, f"{tp} + {fp}"), ratio(tp, f"{tp} + {fn}")
    return {
        "true_negatives": tn,
        "false_positives": fp,
        "false_negatives": fn,
        "true_positives": tp,
        "accuracy": ratio(f"({tp} + {tn})", f"{prefix}n"),
        "precision": precision,
        "recall": recall,
        "f1_score": ratio(f"(2e0 * {precision} * {recall})", f"{precision} + {recall}"),
        "support": f"{tp} + {fn}",
    }


RATIOS = ("accuracy", "precision", "recall", "f1_score")


def metric_list(prefix: str = "") -> str:
    return ", ".join(
        f"{r6(e) if m in RATIOS else e} AS {m}" for m, e in named(prefix).items()
    )


def finding(scope, code, fired, value="NULL", bound="NULL", column=None) -> str:
    col = "NULL" if column is None else f"'{column}'"
    return (
        f"SELECT '{scope}' AS scope, '{code}' AS code, CAST({col} AS VARCHAR) AS \"column\","
        f" coalesce({fired}, false) AS fired, CAST({value} AS DOUBLE) AS value,"
        f" CAST({bound} AS DOUBLE) AS bound, CAST(NULL AS VARCHAR) AS detail"
    )


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def from_(parts, source: str) -> str:
    return union(f"{p} FROM {source}" for p in parts)


NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def num(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    return f"CASE WHEN regexp_matches({text}, '{NUMBER}', 'i') THEN TRY_CAST({text} AS DOUBLE) END"


# ---- validation -------------------------------------------------------------------

_AGES = SNAP + """,
     g AS (SELECT * REPLACE (CASE WHEN monthly_income < 0 THEN CAST(age AS VARCHAR) || 'd'
                                  ELSE CAST(age AS VARCHAR) END AS age) FROM s)"""


def _range_parts() -> str:
    parts = []
    for c in NUMERIC:
        hi = f"count(*) FILTER (WHERE {num(c)} > 120)" if c == "age" else "NULL"
        parts.append(
            f"SELECT '{c}' AS \"column\","
            f" count(*) FILTER (WHERE {c} IS NOT NULL AND ({num(c)}) IS NULL) AS non_numeric,"
            f" count(*) FILTER (WHERE {num(c)} < 0) AS lo, CAST({hi} AS BIGINT) AS hi FROM g"
        )
    return union(parts)


def _validation(source: str, columns, ages_text: bool) -> str:
    s = "validation"
    parts = [
        finding(s, "required_column", str(c not in columns).lower(), column=c)
        for c in SNAPSHOT_COLUMNS
    ]
    for c in columns:
        n = f"(SELECT count(*) FROM {source} WHERE {c} IS NULL)"
        parts.append(finding(s, "missing_values", f"{n} > 0", n, 0, c))
    parts.append(finding(s, "target_non_numeric", "false", 0, 0, "churn"))
    parts.append(finding(s, "target_domain", "false", 0, 0, "churn"))
    for c in NUMERIC:
        bad = f"(SELECT count(*) FROM {source} WHERE {c} IS NOT NULL AND ({num(c)}) IS NULL)"
        parts.append(finding(s, "non_numeric", f"{bad} > 0", bad, 0, c))
        low = f"(SELECT count(*) FROM {source} WHERE {num(c)} < 0)"
        n = f"CASE WHEN {bad} = 0 THEN {low} END"
        parts.append(finding(s, "below_min", f"{n} > 0", n, 0, c))
        if c == "age":
            high = f"(SELECT count(*) FROM {source} WHERE {num(c)} > 120)"
            n = f"CASE WHEN {bad} = 0 THEN {high} END"
            parts.append(finding(s, "above_max", f"{n} > 0", n, 120, c))
    dup = f"(SELECT count(*) - count(DISTINCT customer_id) FROM {source})"
    parts.append(finding(s, "duplicate_ids", f"{dup} > 0", dup, 0, "customer_id"))
    return union(parts)


_NO_GENDER = [c for c in SNAPSHOT_COLUMNS if c != "gender"]
_NO_CITY = [c for c in SNAPSHOT_COLUMNS if c != "city"]


def _upload() -> str:
    parts = [
        finding("upload", "required_column", str(c not in _NO_CITY).lower(), column=c)
        for c in SNAPSHOT_COLUMNS
    ]
    n = "(SELECT count(*) FROM s)"
    parts.append(finding("upload", "empty", f"{n} = 0", n, 1))
    bad = "(SELECT count(*) FROM s WHERE churn IS NULL)"
    parts.append(finding("upload", "target_non_numeric", f"{bad} > 0", bad, 0, "churn"))
    dup = "(SELECT count(*) - count(DISTINCT customer_id) FROM s)"
    parts.append(finding("upload", "duplicate_ids", f"{dup} > 0", dup, 0, "customer_id"))
    return union(parts)


def _target(table: str, column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\","
        f" count(*) FILTER (WHERE {column} IS NOT NULL AND ({num(column)}) IS NULL) AS non_numeric,"
        f" count(*) FILTER (WHERE ({num(column)}) NOT IN (0, 1)) AS outside,"
        f" count(*) FILTER (WHERE {column} IS NULL) AS missing FROM {table}"
    )


def _target_values(table: str, column: str) -> str:
    return (
        f"SELECT CAST({column} AS VARCHAR) AS target_value, ({num(column)}) IS NOT NULL"
        f" AS is_numeric, count(*) AS n FROM {table} WHERE {column} IS NOT NULL"
        f" AND coalesce(({num(column)}) NOT IN (0, 1), true) GROUP BY ALL"
    )


# ---- features ---------------------------------------------------------------------


def _flag(text: str, word: str) -> str:
    return f"CAST(contains(lower(coalesce({text}, '')), '{word}') AS INT)"


_TENURE = "CAST((SELECT max(signup_date) FROM s) - signup_date AS BIGINT)"
_TEXT_FEATURES = (
    "CAST(length(coalesce(customer_feedback, '')) AS INT) AS customer_feedback_length, "
    + ", ".join(
        f"{_flag('customer_feedback', w)} AS customer_feedback_keyword_{w}" for w in CFG.keywords
    )
)
_FEATURES = (
    f"{_TENURE} AS customer_tenure_days,"
    f" CAST(support_tickets >= 3 AS INT) AS many_support_tickets_flag, {_TEXT_FEATURES}"
)
_GAPS = SNAP + f""",
     gp AS (SELECT * REPLACE (
                CASE WHEN monthly_income >= 0 THEN monthly_income END AS monthly_income,
                CASE WHEN monthly_income >= 0 THEN employment_status END AS employment_status)
            FROM s),
     ft AS (SELECT *, {_FEATURES} FROM gp)"""
_MED = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM ft)) AS {c}" for c in CFG.model_numeric)
_IMPUTED = f"{_GAPS}, im AS (SELECT customer_id, {_MED} FROM ft)"


def _z(c: str) -> str:
    sd = f"(SELECT stddev_pop({c}) FROM im)"
    return f"CASE WHEN {sd} = 0 THEN 0e0 ELSE ({c} - (SELECT avg({c}) FROM im)) / {sd} END"


_LONG_CATS = union(
    f"SELECT customer_id AS id, '{c}' AS feature, {c} AS value FROM gp" for c in CATEGORICAL
)
_MODES = f"""{_GAPS}, lc AS ({_LONG_CATS}),
     mc AS (SELECT feature, value, count(*) AS n FROM lc WHERE value IS NOT NULL GROUP BY ALL),
     mo AS (SELECT feature, value AS mode FROM mc
            QUALIFY row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) = 1)"""

# Levels by feature in configured order, numbered as the encoder does.
_LEVELS = f""", lc AS ({_LONG_CATS}),
     mc AS (SELECT feature, value, count(*) AS n FROM lc WHERE value IS NOT NULL GROUP BY ALL),
     mo AS (SELECT feature, value AS mode FROM mc
            QUALIFY row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) = 1),
     fo AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {i})" for i, c in enumerate(CATEGORICAL))})
            t(feature, place)),
     lv AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS rank,
                   (SELECT count(*) FROM mc m JOIN fo f USING (feature) WHERE f.place < fo.place)
                   AS start
            FROM mc JOIN fo USING (feature))"""

# ---- drift ------------------------------------------------------------------------

_WATCHED = SCORED + f""",
     w AS (SELECT *, {_TENURE} AS customer_tenure_days FROM sc),
     ref AS (SELECT * FROM w WHERE signup_date < DATE '{REFERENCE_END}'),
     cur AS (SELECT * FROM w WHERE NOT signup_date < DATE '{REFERENCE_END}')"""


def _numeric_stats(source: str, features) -> str:
    return union(
        f"SELECT '{c}' AS feature, avg({c}) AS mean,"
        f" CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS missing_rate FROM {source}"
        for c in features
    )


def _shares(source: str, features) -> str:
    return union(
        f"SELECT '{c}' AS feature, coalesce({c}, 'UNKNOWN') AS value,"
        f" CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {source}) AS share"
        f" FROM {source} GROUP BY ALL"
        for c in features
    )


def _status(shift: str, miss: str) -> str:
    a, b = f"coalesce(abs({shift}), 0)", f"coalesce(abs({miss}), 0)"
    return (
        f"CASE WHEN {shift} IS NULL AND {miss} IS NULL THEN 'unknown'"
        f" WHEN {a} > 5e-1 OR {b} > 1e-1 THEN 'significant'"
        f" WHEN {a} > 2e-1 OR {b} > 5e-2 THEN 'moderate' ELSE 'stable' END"
    )


def _drift_ctes(numeric, categorical) -> str:
    return f""",
     rn_ AS ({_numeric_stats("ref", numeric)}), cn_ AS ({_numeric_stats("cur", numeric)}),
     dn AS (SELECT cn_.feature, rn_.mean AS reference_mean, cn_.mean AS current_mean,
                   cn_.mean - rn_.mean AS mean_shift,
                   rn_.missing_rate AS reference_missing_rate,
                   cn_.missing_rate AS current_missing_rate,
                   cn_.missing_rate - rn_.missing_rate AS missing_rate_shift
            FROM cn_ LEFT JOIN rn_ USING (feature)),
     rc_ AS ({_shares("ref", categorical)}), cc_ AS ({_shares("cur", categorical)}),
     dc AS (SELECT feature, sum(abs(coalesce(cc_.share, 0) - coalesce(rc_.share, 0))) / 2
                   AS mean_shift, 0e0 AS missing_rate_shift
            FROM cc_ FULL JOIN rc_ USING (feature, value) GROUP BY feature),
     ds AS (SELECT 'numeric' AS kind, feature, mean_shift AS shift, missing_rate_shift FROM dn
            UNION ALL SELECT 'categorical', feature, mean_shift, missing_rate_shift FROM dc)"""


_DRIFT = _WATCHED + _drift_ctes(CFG.monitor_numeric, CFG.monitor_categorical)
_STATUS_SELECT = f"""SELECT kind, feature, {r6("shift")} AS shift,
    {r6("missing_rate_shift")} AS missing_rate_shift,
    {_status("shift", "missing_rate_shift")} AS status FROM ds"""
_EVENTS = f"""WITH ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '{EVENTS_REFERENCE_END}'),
     cur AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENTS_REFERENCE_END}')""" + _drift_ctes(
    ("value",), ("event_type",)
)


def _event_windows(closed: bool) -> str:
    """Drift per day of later events; `closed`: of the days a watermark of two days has closed,
    without the rows that came after that."""
    on_time = (
        "SELECT * FROM a WHERE NOT (event_id % 50 = 0 AND chunk + 4 <= (SELECT max(chunk) FROM a))"
        if closed
        else "SELECT * FROM a"
    )
    shut = (
        "CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM o) - INTERVAL 2 DAY" if closed else "true"
    )
    return f"""WITH ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '{EVENTS_REFERENCE_END}'),
     a AS (SELECT *, datediff('day', DATE '{EVENTS_REFERENCE_END}', CAST(ts AS DATE)) // 2 AS chunk
           FROM events WHERE ts >= TIMESTAMP '{EVENTS_REFERENCE_END}'),
     o AS ({on_time}),
     cur AS (SELECT *, CAST(ts AS DATE) AS window_start FROM o WHERE {shut}),
     r_ AS ({_numeric_stats("ref", ("value",))}), q_ AS ({_shares("ref", ("event_type",))}),
     days AS (SELECT window_start, count(*) AS rows, avg(value) AS mean,
                     CAST(count(*) - count(value) AS DOUBLE) / count(*) AS missing_rate FROM cur GROUP BY 1),
     p_ AS (SELECT window_start, coalesce(event_type, 'UNKNOWN') AS value, count(*) AS n FROM cur GROUP BY ALL),
     grid AS (SELECT window_start, rows, q_.value, q_.share FROM days, q_),
     tv AS (SELECT coalesce(g.window_start, p.window_start) AS window_start,
                   sum(abs(coalesce(CAST(p.n AS DOUBLE) / d.rows, 0) - coalesce(g.share, 0))) / 2 AS shift
            FROM grid g FULL JOIN p_ p ON p.window_start = g.window_start AND p.value = g.value
                 JOIN days d ON d.window_start = coalesce(g.window_start, p.window_start) GROUP BY 1),
     w AS (SELECT window_start, 'numeric' AS kind, r_.feature, rows, days.mean - r_.mean AS shift,
                  days.missing_rate - r_.missing_rate AS missing_rate_shift FROM days, r_
           UNION ALL SELECT window_start, 'categorical', 'event_type', rows, shift, 0e0 FROM tv JOIN days USING (window_start))
     SELECT window_start, kind, feature, rows, {r6("shift")} AS shift, {r6("missing_rate_shift")} AS missing_rate_shift,
            {_status("shift", "missing_rate_shift")} AS status FROM w"""


_PREDICTION = (
    _DRIFT
    + split_ctes("ref")
    + """,
     vr AS (SELECT avg(churn) AS rate, count(*) AS n FROM sp WHERE split = 'validation'),
     cb AS (SELECT avg(churn_probability) AS mp, least(100, count(*)) AS qs FROM cur),
     pd AS (SELECT rate AS reference_mean_probability, mp AS current_mean_probability,
                   mp - rate AS mean_shift, CAST(qs AS BIGINT) AS review_queue_size,
                   CAST(qs - CAST(floor(n * 5e-1) AS BIGINT) AS BIGINT) AS review_queue_shift
            FROM vr, cb)"""
)


def _drift_findings() -> str:
    s, n = "drift", f"(SELECT count(*) FROM ds WHERE {_status('shift', 'missing_rate_shift')}"
    n += " = 'significant')"
    shifted = "abs(mean_shift) > 1.5e-1"
    return from_(
        [
            finding(s, "prediction_mean_shifted", shifted, r6("mean_shift"), "1.5e-1"),
            finding(s, "empty_queue", "review_queue_size = 0", "review_queue_size", 1),
            finding(s, "significant_feature_drift", f"{n} > 0", n, 0),
            finding(s, "review_before_promotion", f"{n} > 0", n, 0),
            finding(s, "compare_recent_batches", shifted, r6("mean_shift"), "1.5e-1"),
        ],
        "pd",
    )


# ---- metrics and profile ----------------------------------------------------------

_AGE_BAND = """CASE WHEN age IS NULL OR age < 0 OR age > 120 THEN 'UNKNOWN'
    WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34' WHEN age <= 44 THEN '35-44'
    WHEN age <= 54 THEN '45-54' ELSE '55+' END"""
_TICKET_BAND = """CASE WHEN support_tickets IS NULL OR support_tickets < -1
    OR support_tickets > 100 THEN 'UNKNOWN' WHEN support_tickets <= 0 THEN '0'
    WHEN support_tickets <= 1 THEN '1' WHEN support_tickets <= 2 THEN '2' ELSE '3+' END"""


def _slices(source: str) -> str:
    values = {c: f"coalesce({c}, 'UNKNOWN')" for c in CATEGORICAL}
    values |= {"age_band": _AGE_BAND, "support_ticket_band": _TICKET_BAND}
    inner = union(
        f"SELECT '{n}' AS slice_name, {v} AS slice_value, {counts('churn', 'predicted_label')}"
        f" FROM {source} GROUP BY ALL"
        for n, v in values.items()
    )
    return (
        f"SELECT slice_name, slice_value, n AS row_count, {r6(ratio('tp + fn', 'n'))}"
        f" AS positive_rate, {metric_list()} FROM ({inner})"
    )


def _model_metrics(source: str, more: str = "") -> str:
    return (
        f"SELECT n AS rows, tp + fp AS positive_predictions,"
        f" {r6(ratio('tp + fp', 'n'))} AS predicted_positive_rate, {r6('b')} AS brier_score,"
        f" {metric_list()}{more} FROM (SELECT {counts('churn', 'predicted_label')},"
        f" avg(power(churn_probability - churn, 2)) AS b FROM {source})"
    )


def _ap(source: str) -> str:
    return f"""(SELECT sum(tp * ctp / cn) / sum(tp) FROM (
        SELECT tp, CAST(sum(tp) OVER (ORDER BY churn_probability DESC) AS DOUBLE) AS ctp,
               sum(n) OVER (ORDER BY churn_probability DESC) AS cn
        FROM (SELECT churn_probability, sum(churn) AS tp, count(*) AS n FROM {source}
              GROUP BY churn_probability)))"""


def _comparison(source: str) -> str:
    return (
        f"SELECT {counts('churn', 'predicted_label', 'm_')},"
        f" {counts('churn', 'rule_label', 'r_')} FROM {source}"
    )


def _comparison_select(source: str) -> str:
    m, r = named("m_"), named("r_")
    items = ["m_n AS rows"]
    for side, d in (("model", m), ("rule", r)):
        items += [f"{r6(d[k])} AS {side}_{k}" for k in ("recall", "precision", "f1_score")]
    items.append(f"{r6(ratio('m_tp + m_fp', 'm_n'))} AS model_predicted_positive_rate")
    for k in ("recall", "precision", "f1_score"):
        items.append(f"{r6(f'{m[k]} - {r[k]}')} AS {k.removesuffix('_score')}_delta")
    return f"SELECT {', '.join(items)} FROM ({_comparison(source)})"


def _evaluation_findings() -> str:
    m, r, s = named("m_"), named("r_"), "evaluation"
    rate = ratio("m_tp + m_fp", "m_n")
    slices = f"(SELECT count(*) FROM ({_slices('te')}))"
    d, dp = f"({m['recall']} - {r['recall']})", f"({m['precision']} - {r['precision']})"
    parts = [
        finding(s, "empty_test", "m_n = 0", "m_n", 1),
        finding(
            s, "recall_not_above_rule", f"{r['recall']} >= {m['recall']}",
            r6(m["recall"]), r6(r["recall"]),
        ),
        finding(s, "flags_over_half", f"{rate} > 5e-1", r6(rate), "5e-1"),
        finding(s, "no_slices", f"{slices} = 0", slices, 1),
        finding(s, "recall_improved", f"{d} > 0", r6(d), 0),
        finding(s, "recall_not_improved", f"{d} <= 0", r6(d), 0),
        finding(s, "precision_fell", f"{dp} < 0", r6(dp), 0),
    ]
    return from_(parts, f"({_comparison('te')})")


_SUMMARY = """SELECT count(*) AS row_count, CAST(least(100, count(*)) AS BIGINT)
        AS review_queue_size,
        count(*) FILTER (WHERE predicted_label = 1) AS positive_predictions,
        round(avg(predicted_label), 6) + 0 AS predicted_positive_rate,
        count(*) FILTER (WHERE risk_band = 'high') AS high_count,
        count(*) FILTER (WHERE risk_band = 'medium') AS medium_count,
        count(*) FILTER (WHERE risk_band = 'low') AS low_count, 100 AS top_k,
        round(max(churn_probability), 6) + 0 AS max_probability,
        round(avg(churn_probability), 6) + 0 AS mean_probability,
        round(min(churn_probability), 6) + 0 AS min_probability,
        count(*) - count(churn_probability) AS missing_probabilities FROM sc"""


def _scoring_findings() -> str:
    s, n = "scoring", "count(*)"
    small = f"least(100, {n}) < 100"
    lost = f"{n} - count(churn_probability)"
    return from_(
        [
            finding(s, "empty_batch", f"{n} = 0", n, 1),
            finding(s, "top_k_not_positive", f"{n} < 0", f"100 + 0 * {n}", 1),
            finding(s, "missing_probabilities", f"{lost} > 0", lost, 0),
            finding(s, "scores_nearly_constant", "count(DISTINCT churn_probability) <= 1"),
            finding(s, "queue_below_capacity", small, f"least(100, {n})", 100),
            finding(s, "queue_at_capacity", f"NOT ({small})", f"least(100, {n})", 100),
        ],
        "sc",
    )


def _numeric_profile() -> str:
    return union(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS missing_count,"
        f" {r6(f'CAST(min({c}) AS DOUBLE)')} AS min, {r6(f'CAST(max({c}) AS DOUBLE)')} AS max,"
        f" {r6(f'avg({c})')} AS mean, {r6(f'median({c})')} AS median,"
        f" {r6(f'stddev_pop({c})')} AS std FROM s"
        for c in NUMERIC
    )


def _top3(source: str, columns) -> str:
    inner = union(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source}"
        " GROUP BY ALL"
        for c in columns
    )
    return (
        "SELECT feature, CAST(position AS INT) AS position, value, n FROM (SELECT *,"
        " row_number() OVER (PARTITION BY feature ORDER BY n DESC, value ASC NULLS LAST)"
        f" AS position FROM ({inner})) WHERE position <= 3"
    )


def _text_profile(source: str, column: str) -> str:
    t = f"coalesce({column}, '')"
    return (
        f"SELECT '{column}' AS \"column\", {r6(f'avg(length({t}))')} AS average_length,"
        f" {r6(f'median(length({t}))')} AS median_length,"
        f" {r6(f'CAST(count(DISTINCT {t}) AS DOUBLE) / count(*)')} AS unique_ratio FROM {source}"
    )


def _profile_findings() -> str:
    s = "profile"
    uniq = "CAST(count(DISTINCT customer_id) AS DOUBLE) / count(*)"
    texts = "CAST(count(DISTINCT coalesce(customer_feedback, '')) AS DOUBLE) / count(*)"
    rate = "avg(churn)"
    parts = [
        finding(s, "id_unique", f"{uniq} >= 9.5e-1", r6(uniq), "9.5e-1", "customer_id"),
        finding(s, "target_skewed", f"{rate} < 2e-1 OR {rate} > 8e-1", r6(rate), column="churn"),
        finding(s, "date_parseable", "max(signup_date) IS NOT NULL", column="signup_date"),
        finding(s, "text_unique", f"{texts} >= 9e-1", r6(texts), "9e-1", "customer_feedback"),
    ]
    for c in NUMERIC:
        parts.append(
            finding(s, "negative_values", f"min({c}) < 0", r6(f"CAST(min({c}) AS DOUBLE)"), 0, c)
        )
    for c in CATEGORICAL:
        u = f"CAST(count(DISTINCT {c}) AS DOUBLE) / count(*)"
        parts.append(finding(s, "high_cardinality", f"{u} >= 2.5e-1", r6(u), "2.5e-1", c))
    return from_(parts, "s")


# ---- output checks ----------------------------------------------------------------


def _check(name, code, passed, value="NULL", detail="NULL") -> str:
    return (
        f"SELECT '{name}' AS name, '{code}' AS \"check\", {passed} AS passed,"
        f" CAST({value} AS DOUBLE) AS value, CAST({detail} AS VARCHAR) AS detail"
    )


def _verify(source: str) -> str:
    """Checks by brute force: flags against ranks, neighbours by a global window."""
    n = f"(SELECT count(*) FROM {source})"
    queue = f"(SELECT count(*) FROM {source} WHERE review_queue_flag)"

    def bad(where: str) -> str:
        return f"(SELECT count(*) FROM {source} WHERE {where})"

    lost, outside = bad("churn_probability IS NULL"), bad("churn_probability NOT BETWEEN 0 AND 1")
    bands = bad("risk_band NOT IN ('high', 'medium', 'low')")
    wrong = bad(f"review_queue_flag <> (review_rank <= {queue})")
    prio = bad(
        "review_priority <> CASE WHEN review_queue_flag THEN 'review' ELSE 'monitor' END"
    )
    rises = f"""(SELECT count(*) FROM (SELECT hi, lag(lo) OVER (ORDER BY review_rank) AS before
        FROM (SELECT review_rank, min(churn_probability) AS lo, max(churn_probability) AS hi
              FROM {source} GROUP BY review_rank)) WHERE hi > before)"""
    ranks = f"(SELECT count(DISTINCT review_rank) FROM {source})"
    whole = f"(SELECT min(review_rank) = 1 AND max(review_rank) = count(*) FROM {source})"
    a = "prediction_artifact"
    return union(
        [
            _check(a, "required_columns", "true", 0, "''"),
            _check(a, "not_empty", f"{n} > 0", n),
            _check(a, "numeric_probabilities", f"{lost} = 0", lost),
            _check(a, "probabilities_in_range", f"{outside} = 0", outside),
            _check(a, "known_bands", f"{bands} = 0", bands),
            _check(a, "flags_are_top_ranks", f"{wrong} = 0", queue),
            _check(a, "priority_matches_flag", f"{prio} = 0", prio),
            _check(a, "queue_size", f"{queue} = least(100, {n})", queue),
            _check(a, "sorted_by_probability", f"{rises} = 0", rises),
            _check(a, "contiguous_ranks", f"{ranks} = {n} AND {whole}", ranks),
        ]
    )


_BROKEN = RANKED + """,
     br AS (SELECT * REPLACE (
        CASE WHEN risk_band = 'high' THEN churn_probability + 1
             WHEN churn_probability < 2e-1 THEN NULL ELSE churn_probability END
            AS churn_probability,
        CASE WHEN churn_probability BETWEEN 5e-1 AND 5.2e-1 THEN 7 ELSE review_rank END
            AS review_rank,
        CASE WHEN churn_probability BETWEEN 6e-1 AND 6.5e-1 THEN 'severe' ELSE risk_band END
            AS risk_band,
        CASE WHEN churn_probability < 2.5e-1 THEN true ELSE review_queue_flag END
            AS review_queue_flag) FROM q)"""


def _report_checks() -> str:
    a = "evaluation_report"
    slices = f"(SELECT count(*) FROM ({_slices('te')}))"
    # Columns of each section's table; the comparison adds 11 and the findings 7 rows of 7.
    rows = f"14 + 12 + 11 + 13 * {slices} + 49"
    return union(
        [
            _check(a, "exists", "true"),
            _check(a, "not_empty", f"{rows} > 0", rows),
            _check(a, "required_section", "true", 14, "'model_metrics'"),
            _check(a, "required_section", "true", 12, "'baseline_metrics'"),
            _check(a, "required_section", f"{slices} > 0", f"13 * {slices}", "'slice_metrics'"),
            _check(a, "required_section", "false", 0, "'appendix'"),
        ]
    )


def _psi(c: str) -> str:
    """Over the deciles of the reference: value at row ceil(n i / 10) of its order."""
    edges = (
        f"(SELECT list(v ORDER BY v) FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS rn,"
        f" count(*) OVER () AS n FROM ref WHERE {c} IS NOT NULL), range(1, 10) r(i)"
        f" WHERE rn = (n * i + 9) // 10)"
    )

    def shares(source: str) -> str:
        return (
            f"(SELECT len(list_filter({edges}, lambda e: e < {c})) AS b, CAST(count(*) AS DOUBLE)"
            f" / (SELECT count({c}) FROM {source}) AS p FROM {source} WHERE {c} IS NOT NULL GROUP BY 1)"
        )

    p, q = "greatest(coalesce(r.p, 0), 1e-4)", "greatest(coalesce(c.p, 0), 1e-4)"
    return (
        f"(SELECT sum(({p} - {q}) * ln({p} / {q})) FROM range(10) g(b)"
        f" LEFT JOIN {shares('ref')} r USING (b) LEFT JOIN {shares('cur')} c USING (b))"
    )


def _ks(c: str) -> str:
    def part(source: str, a: int, b: int) -> str:
        return f"SELECT {c} AS v, {a} AS r, {b} AS c FROM {source} WHERE {c} IS NOT NULL"

    return (
        "(SELECT max(abs(cr / (SELECT count(" + c + ") FROM ref) - cc / (SELECT count(" + c + ") FROM cur)))"
        " FROM (SELECT CAST(sum(sum(r)) OVER (ORDER BY v) AS DOUBLE) AS cr,"
        " CAST(sum(sum(c)) OVER (ORDER BY v) AS DOUBLE) AS cc"
        f" FROM ({part('ref', 1, 0)} UNION ALL {part('cur', 0, 1)}) GROUP BY v))"
    )


def _unknown(c: str) -> str:
    value = f"coalesce({c}, 'UNKNOWN')"
    new = f"{value} NOT IN (SELECT {value} FROM ref WHERE monthly_income >= 0)"
    share = ratio(f"count(*) FILTER (WHERE {new})", "count(*)")
    return (
        f"SELECT '{c}' AS feature, count(DISTINCT {value}) FILTER (WHERE {new}) AS unknown_values,"
        f" {r6(share)} AS unknown_rate FROM cur"
    )


_SKETCHES = """,
            sk AS (SELECT year(signup_date) || '-Q' || quarter(signup_date) AS yr, CAST(least(999, floor(churn_probability * 1000)) AS INT) AS bin,
                   count(*) AS n FROM sc GROUP BY ALL)"""


def _gate() -> str:
    """Two fixed scorecards on the test part."""
    loss = lambda m: f"champion_{m} - candidate_{m}"
    names = [*((c, c) for c in CATEGORICAL), ("age_band", "age_band"), ("support_ticket_band", "ticket_band")]
    base = f"""{SCORED}{split_ctes('sc')},
        tst AS (SELECT *, 1e0 / (1e0 + exp(-(-1.3e0 + 5.5e-1 * support_tickets + 1.2e-2 * (age - 60)))) AS q,
               {_AGE_BAND} AS age_band, {_TICKET_BAND} AS ticket_band FROM sp WHERE split = 'test'),
        lb AS (SELECT *, churn_probability >= 5e-1 AS a, q >= 5e-1 AS b FROM tst),
        mtr AS (SELECT count(*) AS rows, CAST(count(*) FILTER (a <> b) AS DOUBLE) / count(*) AS changed,
               count(*) FILTER (a AND churn = 1) / count(*) FILTER (churn = 1) AS champion_recall,
               count(*) FILTER (b AND churn = 1) / count(*) FILTER (churn = 1) AS candidate_recall,
               coalesce(count(*) FILTER (a AND churn = 1) / nullif(count(*) FILTER (a), 0), 0) AS champion_precision,
               coalesce(count(*) FILTER (b AND churn = 1) / nullif(count(*) FILTER (b), 0), 0) AS candidate_precision,
               avg(power(churn_probability - churn, 2)) AS champion_brier, avg(power(q - churn, 2)) AS candidate_brier FROM lb),
        g1 AS (SELECT churn_probability AS s, count(*) AS n, sum(churn) AS tp FROM lb GROUP BY 1),
        g2 AS (SELECT q AS s, count(*) AS n, sum(churn) AS tp FROM lb GROUP BY 1),
        ap2 AS (SELECT (SELECT sum(tp * ctp / cn) / sum(tp) FROM (SELECT tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn
                       FROM g1 WINDOW w AS (ORDER BY s DESC))) AS champion_pr_auc,
                      (SELECT sum(tp * ctp / cn) / sum(tp) FROM (SELECT tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn
                       FROM g2 WINDOW w AS (ORDER BY s DESC))) AS candidate_pr_auc),
        slv AS ({union(f"SELECT '{name}=' || coalesce({c}, 'UNKNOWN') AS slice, a, b, churn FROM lb" for name, c in names)}),
        slr AS (SELECT slice, count(*) AS rows, count(*) FILTER (churn = 1) AS positives,
               (count(*) FILTER (a AND churn = 1) - count(*) FILTER (b AND churn = 1)) / count(*) FILTER (churn = 1) AS lost
               FROM slv GROUP BY slice HAVING count(*) >= 30 AND count(*) FILTER (churn = 1) > 0)"""
    overall = from_(
        [finding("promotion", "nothing_to_compare", "rows = 0", "rows", "1")]
        + [finding("promotion", f"{m}_lost", f"{loss(m)} > {b}", r6(loss(m)), b) for m, b in (("recall", "0e0"), ("precision", "2e-2"), ("pr_auc", "0e0"))]
        + [finding("promotion", "brier_grew", "candidate_brier - champion_brier > 1e-2", r6("candidate_brier - champion_brier"), "1e-2"),
           finding("promotion", "many_labels_changed", "changed > 2.5e-1", r6("changed"), "2.5e-1")],
        "mtr, ap2",
    )
    return f"""{base} {overall} UNION ALL SELECT 'promotion', 'slice_recall_lost', slice, lost > 1e-1, {r6('lost')}, 1e-1, NULL FROM slr"""


def _hashed(table: str, columns: Iterable[str]) -> str:
    """Rows and content hash: the sum of 60 bits of every row's MD5."""
    fields = " || ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
        for c in columns
    )
    bits = f"CAST(('0x' || substr(md5({fields}), 1, 15)) AS BIGINT)"
    return (
        f"SELECT '{table}' AS input, count(*) AS rows, '{','.join(columns)}' AS columns,"
        f" CAST(coalesce(sum(CAST({bits} AS HUGEINT)), 0) AS VARCHAR) AS content_hash FROM {table}"
    )


def statements() -> dict[str, str]:
    missing = union(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM s"
        for c in SNAPSHOT_COLUMNS
    )
    tick = CFG.ticket_flag_column
    docs_words = {"license": "license", "data": "data", "the ": "the"}
    doc_flags = ", ".join(
        f"{_flag('text', w)} AS text_keyword_{n}" for w, n in docs_words.items()
    )
    zs = ", ".join(f"{r6(_z(c))} AS {c}" for c in CFG.model_numeric)
    width = " + ".join(f"count(DISTINCT {c})" for c in CATEGORICAL)
    n_numeric = len(CFG.model_numeric)
    entries = union(
        [
            *(
                f"SELECT customer_id, CAST({i} AS INT) AS position, {r6(_z(c))} AS value FROM im"
                for i, c in enumerate(CFG.model_numeric)
            ),
            f"SELECT id AS customer_id, CAST({n_numeric} + start + rank - 1 AS INT) AS position,"
            " 1e0 AS value FROM lc LEFT JOIN mo USING (feature)"
            " JOIN lv ON lv.feature = lc.feature AND lv.value = coalesce(lc.value, mode)",
        ]
    )
    queue = (
        f"customer_id, {r6('churn_probability')} AS churn_probability, predicted_label, risk_band"
    )
    events_days = "floor((epoch_us(m) - epoch_us(ts)) / 86400000000.0)"
    return {
        "missing_counts": f"{SNAP} SELECT * FROM ({missing}) WHERE missing > 0",
        "duplicate_ids": "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM"
        " (SELECT count(*) AS n FROM events GROUP BY user_id)",
        "duplicate_keys": "SELECT user_id AS id, count(*) AS count FROM events GROUP BY user_id"
        " HAVING count(*) > 1",
        "target_domain": union(
            [
                _target("labels", "quality"),
                _target("embeddings", "label"),
                _target("documents", "lang"),
            ]
        ),
        "target_invalid_values": union(
            [
                _target_values("labels", "quality"),
                _target_values("embeddings", "label"),
                _target_values("documents", "lang"),
            ]
        ),
        "numeric_ranges": f"{_AGES} SELECT \"column\", non_numeric,"
        " CASE WHEN non_numeric = 0 THEN lo END AS below_min,"
        f" CASE WHEN non_numeric = 0 THEN hi END AS above_max FROM ({_range_parts()})",
        "validation_findings": f"{_AGES} {_validation('g', _NO_GENDER, True)}",
        "validation_summary": f"{SNAP} SELECT count(*) FILTER (WHERE fired) = 0 AS passed,"
        " count(*) FILTER (WHERE fired) AS errors, (SELECT count(*) FROM s) AS row_count,"
        f" 15 AS column_count FROM ({_validation('s', SNAPSHOT_COLUMNS, False)})",
        "upload_profile": f"{SNAP} {_upload()}",
        "tenure_days": f"{SNAP} SELECT customer_id, {_TENURE} AS customer_tenure_days FROM s",
        "tenure_days_events": "SELECT event_id, CAST(" + events_days + " AS BIGINT)"
        " AS customer_tenure_days FROM events,"
        " (SELECT date_trunc('day', max(ts))::TIMESTAMP AS m FROM events)",
        "ticket_flag": f"{SNAP} SELECT customer_id, CAST(support_tickets >= 3 AS INT) AS {tick}"
        " FROM s",
        "text_features": f"{SNAP} SELECT customer_id, {_TEXT_FEATURES} FROM s",
        "text_features_documents": "SELECT doc_id, CAST(length(coalesce(text, '')) AS INT)"
        f" AS text_length, {doc_flags} FROM documents",
        "features_all": f"{SNAP} SELECT customer_id, {_FEATURES} FROM s",
        "impute_scale": f"{_IMPUTED} SELECT customer_id, {zs} FROM im",
        "impute_mode": f"{_MODES} SELECT feature, mode FROM mo",
        "one_hot": f"{_MODES} SELECT id, feature, coalesce(value, mode) AS level"
        " FROM lc LEFT JOIN mo USING (feature)",
        "one_hot_joined": """SELECT event_id AS id, 'event_type' AS feature, event_type AS level FROM events
            UNION ALL SELECT event_id, 'user', CAST(user_id AS VARCHAR) FROM events
            UNION ALL SELECT event_id, 'hour', strftime(ts, '%Y-%m-%d %H') FROM events""",
        "design_matrix": f"{_IMPUTED}{_LEVELS} SELECT * FROM ({entries}) WHERE value <> 0",
        "stratified_split": f"{SPLIT} SELECT customer_id, split FROM sp",
        "stratified_split_events": "WITH ev AS (SELECT event_id, user_id AS customer_id,"
        " CAST(event_type = 'click' AS INT) AS churn FROM events)"
        + split_ctes(
            "ev",
            "substr(md5('42|' || coalesce(CAST(customer_id AS VARCHAR), '')), 1, 13),"
            " substr(md5(concat_ws('|', event_id, coalesce(CAST(customer_id AS VARCHAR), ''), churn)), 1, 13)",
        )
        + " SELECT event_id, split FROM sp",
        "split_counts": f"{SPLIT} SELECT split, count(*) AS rows, {r6('avg(churn)')}"
        " AS positive_rate FROM sp GROUP BY split",
        "class_weights": f"{SPLIT} SELECT churn AS label, count(*) AS n,"
        f" {r6('(sum(count(*)) OVER () / count(*) OVER ()) / count(*)')} AS weight"
        " FROM sp WHERE split = 'train' GROUP BY churn",
        "challenger": f"{SNAP}{split_ctes('s')}, te AS (SELECT * FROM sp WHERE split = 'test')"
        " SELECT 'test rows' AS name, true AS passed, count(*) AS value FROM te"
        " UNION ALL SELECT 'test ids', true, count(DISTINCT customer_id) FROM te"
        " UNION ALL SELECT 'test positives', true, CAST(sum(churn) AS BIGINT) FROM te"
        " UNION ALL SELECT n || ' of ' || m, true, NULL FROM"
        " (SELECT unnest(['range', 'counts', 'brier', 'recall', 'better']) AS n),"
        " (SELECT unnest(['logistic_regression', 'gradient_boosted_trees']) AS m)",
        "run_metadata": union(
            _hashed(t, c)
            for t, c in (
                ("documents", ("doc_id", "lang", "n_chars", "source", "text")),
                ("labels", ("doc_id", "quality", "toxic")),
                ("conversations", ("conv_id", "role", "text", "turn")),
                ("benchmark", ("item_id", "text")),
                ("nation", ("n_name", "n_nationkey", "n_regionkey")),
            )
        ),
        "scored_provenance": f"{SCORED}, h AS ({_hashed('s', ('age', 'customer_id', 'support_tickets'))})"
        f" SELECT customer_id, {r6('churn_probability')} AS churn_probability, 'run-1' AS run_id,"
        " '1' AS model_version, content_hash AS input_hash, '2024-01-01T00:00:00+00:00' AS scored_at FROM sc, h",
        "scorecard": f"{SCORED} SELECT customer_id, {r6('churn_probability')}"
        " AS churn_probability, predicted_label FROM sc",
        "baseline_metrics": f"{SCORED} SELECT 3e0 AS threshold, tp + fp AS positive_predictions,"
        f" {r6(ratio('tp + fp', 'n'))} AS predicted_positive_rate, {metric_list()}"
        f" FROM (SELECT {counts('churn', 'rule_label')} FROM sc)",
        "model_metrics": f"{SCORED} {_model_metrics('sc')}",
        "metric_comparison": f"{SCORED} {_comparison_select('sc')}",
        "average_precision": f"{SCORED} SELECT {r6(_ap('sc'))} AS average_precision",
        "brier": f"{SCORED} SELECT {r6('avg(power(churn_probability - churn, 2))')}"
        " AS brier_score FROM sc",
        "bands": f"{SNAP} SELECT customer_id, {_AGE_BAND} AS age_band,"
        f" {_TICKET_BAND} AS support_ticket_band FROM s",
        "slice_metrics": f"{SCORED} {_slices('sc')}",
        "evaluation_overall": f"{TESTED} {_model_metrics('te', f', {r6(_ap(_TEST))} AS pr_auc')}",
        "evaluation_slices": f"{TESTED} {_slices('te')}",
        "evaluation_findings": f"{TESTED} {_evaluation_findings()}",
        "risk_bands": f"{SCORED} SELECT customer_id, predicted_label, risk_band FROM sc",
        "review_queue": f"{RANKED} SELECT {queue}, review_rank, review_queue_flag,"
        " review_priority FROM q",
        "review_queue_text_ids": f"{SCORED}, ti AS (SELECT CAST(customer_id AS VARCHAR)"
        " AS customer_id, row_number() OVER (ORDER BY round(churn_probability, 1) DESC,"
        " CAST(customer_id AS VARCHAR)) AS review_rank FROM sc)"
        " SELECT *, review_rank <= 100 AS review_queue_flag, review_rank <= 100 AS listed FROM ti",
        "train_lr": f"{SPLIT} SELECT CAST(unnest(range(0, {n_numeric} + (SELECT {width} FROM sp"
        " WHERE split = 'train') + 1)) AS INT) AS position, true AS optimal",
        "train_then_score": "SELECT unnest(['every row is scored', 'probabilities', 'ranks',"
        " 'labels', 'bands', 'queue']) AS name, true AS passed",
        "handoff": "SELECT unnest(['model_artifact', 'prediction_artifact', 'evaluation_report',"
        " 'drift_report', 'handoff']) AS name, true AS passed, CAST(0 AS BIGINT) AS failed",
        "top_k_queue": f"{RANKED} SELECT {queue} FROM q WHERE review_rank <= 100",
        "batch_summary": f"{SCORED} {_SUMMARY}",
        "scoring_findings": f"{SCORED} {_scoring_findings()}",
        "ref_numeric": f"{_WATCHED} SELECT feature, {r6('mean')} AS mean, {r6('missing_rate')}"
        f" AS missing_rate FROM ({_numeric_stats('ref', CFG.monitor_numeric)})",
        "ref_categorical": f"{_WATCHED} SELECT feature, value, {r6('share')} AS share"
        f" FROM ({_shares('ref', CFG.monitor_categorical)})",
        "drift_numeric": f"{_DRIFT} SELECT feature, {r6('reference_mean')} AS reference_mean,"
        f" {r6('current_mean')} AS current_mean, {r6('mean_shift')} AS mean_shift,"
        f" {r6('reference_missing_rate')} AS reference_missing_rate,"
        f" {r6('current_missing_rate')} AS current_missing_rate,"
        f" {r6('missing_rate_shift')} AS missing_rate_shift,"
        f" {_status('mean_shift', 'missing_rate_shift')} AS status FROM dn",
        "drift_categorical": f"{_DRIFT} SELECT feature, {r6('mean_shift')} AS mean_shift,"
        " 0e0 AS current_missing_rate, 0e0 AS missing_rate_shift, 0e0 AS true_missing_rate,"
        f" {_status('mean_shift', '0e0')} AS status FROM dc",
        "drift_status": f"{_DRIFT} {_STATUS_SELECT}",
        "drift_events": f"{_EVENTS} {_STATUS_SELECT}",
        "drift_windows": _event_windows(False),
        "drift_windows_streamed": _event_windows(True),
        "drift_prediction": f"{_PREDICTION} SELECT"
        f" {r6('reference_mean_probability')} AS reference_mean_probability,"
        f" {r6('current_mean_probability')} AS current_mean_probability,"
        f" {r6('mean_shift')} AS mean_shift, review_queue_size, review_queue_shift FROM pd",
        "drift_findings": f"{_PREDICTION} {_drift_findings()}",
        "psi": f"{_WATCHED} "
        + union(f"SELECT '{c}' AS feature, {r6(_psi(c))} AS psi" for c in CFG.monitor_numeric),
        "ks": f"{_WATCHED} "
        + union(f"SELECT '{c}' AS feature, {r6(_ks(c))} AS ks" for c in CFG.monitor_numeric),
        "unknown_rate": f"{_WATCHED} " + union(_unknown(c) for c in CFG.monitor_categorical),
        "calibration": f"{SCORED} SELECT CAST(least(9, floor(churn_probability * 10)) AS INT) AS bin,"
        f" count(*) AS rows, {r6('avg(churn_probability)')} AS mean_score,"
        f" {r6('avg(churn)')} AS positive_rate FROM sc GROUP BY 1",
        "calibration_deciles": f"""{SCORED}, o2 AS (SELECT churn_probability AS p, churn AS y,
            row_number() OVER (ORDER BY churn_probability) AS i, count(*) OVER () AS n FROM sc),
            e2 AS (SELECT p AS edge FROM o2, (SELECT unnest(range(1, 10)) AS t) WHERE i = (n * t + 9) // 10)
            SELECT CAST((SELECT count(*) FROM e2 WHERE p > edge) AS INT) AS decile, count(*) AS rows,
            {r6('min(p)')} AS lowest, {r6('max(p)')} AS highest, {r6('avg(p)')} AS mean_score,
            {r6('avg(y)')} AS positive_rate FROM o2 GROUP BY 1""",
        "calendar_features": f"{SNAP} SELECT customer_id, CAST(month(signup_date) AS INT) AS signup_month,"
        " CAST(year(signup_date) AS INT) AS signup_year FROM s",
        "keyword_rates": "WITH w AS (SELECT unnest(['poor', 'issue', 'license', 'data', 'the ']) AS word)"
        ' SELECT source AS "group", count(*) AS rows, word,'
        f" {r6('avg(CAST(contains(lower(coalesce(text, chr(32))), word) AS INT))')} AS rate"
        " FROM documents, w GROUP BY source, word",
        "score_shift": f"""{SCORED}{_SKETCHES},
            pc AS (SELECT bin, CAST(sum(n) OVER (ORDER BY bin) - n AS BIGINT) AS before, sum(n) OVER () AS whole
                   FROM (SELECT x.bin, coalesce(sum(sk.n), 0) AS n FROM (SELECT unnest(range(1000)) AS bin) x
                         LEFT JOIN sk ON sk.bin = x.bin AND yr = '1995-Q1' GROUP BY 1)),
            pt AS (SELECT bin, CAST(least(9, floor(10 * before / whole)) AS INT) AS part FROM pc),
            sh AS (SELECT part, yr, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY yr) AS whole FROM sk JOIN pt USING (bin)
                   WHERE yr IN ('1995-Q1', '1995-Q2') GROUP BY part, yr)
            SELECT part, {r6("coalesce(max(n / whole) FILTER (yr = '1995-Q1'), 0)")} AS previous_share,
            {r6("coalesce(max(n / whole) FILTER (yr = '1995-Q2'), 0)")} AS current_share FROM sh GROUP BY part""",
        "score_collapse": f"""{SCORED} SELECT year(signup_date) || '-Q' || quarter(signup_date) AS batch, count(*) AS rows,
            {r6('avg(churn_probability)')} AS mean_score, {r6('stddev_pop(churn_probability)')} AS score_spread,
            stddev_pop(churn_probability) < 2.6e-1 AS collapsed FROM sc GROUP BY 1""",
        "score_findings": f"""{SCORED}{_SKETCHES},
            pc AS (SELECT bin, CAST(sum(n) OVER (ORDER BY bin) - n AS BIGINT) AS before, sum(n) OVER () AS whole
                   FROM (SELECT x.bin, coalesce(sum(sk.n), 0) AS n FROM (SELECT unnest(range(1000)) AS bin) x
                         LEFT JOIN sk ON sk.bin = x.bin AND yr = '1995-Q1' GROUP BY 1)),
            pt AS (SELECT bin, CAST(least(9, floor(10 * before / whole)) AS INT) AS part FROM pc),
            sh AS (SELECT part, yr, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY yr) AS whole FROM sk JOIN pt USING (bin)
                   WHERE yr IN ('1995-Q1', '1995-Q2') GROUP BY part, yr),
            tv AS (SELECT sum(abs(a - b)) / 2 AS d FROM (SELECT coalesce(max(n / whole) FILTER (yr = '1995-Q1'), 0) AS a,
                   coalesce(max(n / whole) FILTER (yr = '1995-Q2'), 0) AS b FROM sh GROUP BY part)),
            c AS (SELECT count(*) AS n, stddev_pop(churn_probability) AS sp FROM sc WHERE year(signup_date) || '-Q' || quarter(signup_date) = '1995-Q2'),
            m AS (SELECT CAST(max(n) AS DOUBLE) / sum(n) AS most FROM sk WHERE yr = '1995-Q2')
            {from_([finding('history', 'score_distribution_shifted', 'd > 1e-2', r6('d'), '1e-2'),
                    finding('history', 'scores_collapsed', 'sp < 2.6e-1', r6('sp'), '2.6e-1'),
                    finding('history', 'one_bin_holds_most', 'most > 5e-1', r6('most'), '5e-1'),
                    finding('history', 'no_scores', 'n = 0', 'n', '1')], 'tv, c, m')}""",
        "promotion_gate": _gate(),
        "review_metrics": f"""WITH q AS (SELECT DISTINCT CAST(ts AS DATE) AS batch, user_id, ts FROM events WHERE event_type = 'signup'),
            nx AS (SELECT q.batch, q.user_id, q.ts, min(e.ts) AS then_,
                   min_by(e.event_type, (e.ts, e.event_type = 'click', e.event_type = 'error')) AS kind
                   FROM q LEFT JOIN events e ON e.user_id = q.user_id AND e.ts >= q.ts
                        AND e.ts <= q.ts + INTERVAL 3 DAY AND e.event_type IN ('click', 'purchase', 'error')
                   GROUP BY q.batch, q.user_id, q.ts)
            SELECT CAST(batch AS VARCHAR) AS batch, count(*) AS queued, count(kind) AS reviewed,
            {r6('count(kind) / count(*)')} AS reviewed_rate,
            {r6("coalesce(count(*) FILTER (kind = 'purchase') / nullif(count(kind), 0), 0)")} AS contacted_rate,
            {r6("coalesce(count(*) FILTER (kind = 'error') / nullif(count(kind), 0), 0)")} AS overridden_rate,
            {r6('avg(epoch_us(then_) - epoch_us(ts)) / 36e8')} AS mean_hours FROM nx GROUP BY batch""",
        "time_split": f"{SNAP}, n AS (SELECT count(*) AS n, CAST(ceil(2e-1 * count(*)) AS BIGINT) AS h"
        " FROM s), o2 AS (SELECT signup_date AS dt, row_number() OVER (ORDER BY signup_date) AS rn"
        " FROM s), e AS (SELECT (SELECT dt FROM o2, n WHERE rn = n - h + 1) AS te,"
        " (SELECT dt FROM o2, n WHERE rn = n - 2 * h + 1) AS va)"
        " SELECT customer_id, CASE WHEN signup_date >= te THEN 'test' WHEN signup_date >= va"
        " THEN 'validation' ELSE 'train' END AS split FROM s, e",
        "delayed_labels": "WITH h AS (SELECT source AS batch, quality AS y,"
        " CAST(least(1e0, n_chars / 4e3) >= 5e-1 AS INT) AS x"
        " FROM documents LEFT JOIN labels USING (doc_id)),"
        " a AS (SELECT batch, count(*) AS scored_rows, count(y) AS labelled_rows FROM h GROUP BY batch),"
        f" m AS (SELECT batch, {counts('y', 'x')} FROM h WHERE y IS NOT NULL GROUP BY batch)"
        " SELECT batch, scored_rows, labelled_rows, tp AS true_positives, "
        + ", ".join(f"{r6(named()[k])} AS {k}" for k in ("accuracy", "precision", "recall", "f1_score"))
        + " FROM a LEFT JOIN m USING (batch)",
        "top_reasons": f"{SNAP}, c AS ("
        + union(
            f"SELECT customer_id, '{n}' AS name, {e} AS c FROM s"
            for n, e in (
                ("support_tickets", "5.5e-1 * support_tickets"),
                ("monthly_income", "8e-5 * monthly_income"),
                ("age", "1e-2 * (age - 60)"),
            )
        )
        + "), k AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY c DESC, name)"
        " AS rn FROM c) SELECT customer_id, string_agg(name, ',' ORDER BY rn) AS top_reasons"
        " FROM k WHERE rn <= 2 GROUP BY customer_id",
        "batch_checks": f"{SNAP}, b AS (SELECT count(*) AS n, max(signup_date) AS newest FROM s)"
        " SELECT 'row_count' AS name, n BETWEEN 1 AND 1000000000000 AS passed FROM b UNION ALL"
        " SELECT 'freshness', DATE '2002-01-01' - newest <= 365 FROM b UNION ALL"
        " SELECT 'type of customer_id', true UNION ALL SELECT 'type of age', false UNION ALL"
        " SELECT 'type of signup_date', true",
        "profile_overview": f"{SNAP} SELECT count(*) AS row_count, 15 AS column_count,"
        f" {r6('avg(churn)')} AS positive_rate FROM s",
        "target_distribution": "SELECT CAST(quality AS VARCHAR) AS label, count(*) AS n"
        " FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL",
        "numeric_profile": f"{SNAP} {_numeric_profile()}",
        "categorical_profile": f"{SNAP} "
        + union(
            f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS unique_count,"
            f" {r6(f'CAST(count(DISTINCT {c}) AS DOUBLE) / count(*)')} AS unique_ratio FROM s"
            for c in CATEGORICAL
        ),
        "categorical_top3": f"{SNAP} {_top3('s', CATEGORICAL)}",
        "categorical_top3_documents": "WITH dl AS (SELECT * FROM documents LEFT JOIN labels"
        f" USING (doc_id)) {_top3('dl', ('lang', 'source', 'quality'))}",
        "date_profile": f"{SNAP} SELECT 'signup_date' AS \"column\", true AS parseable,"
        " min(signup_date) AS min_date, max(signup_date) AS max_date,"
        " CAST(max(signup_date) - min(signup_date) AS INT) AS span_days FROM s",
        "date_profile_events": "SELECT 'ts' AS \"column\", true AS parseable,"
        " CAST(min(ts) AS DATE) AS min_date, CAST(max(ts) AS DATE) AS max_date,"
        " CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000.0) AS INT)"
        " AS span_days FROM events UNION ALL SELECT 'day', true, CAST(min(ts) AS DATE),"
        " CAST(max(ts) AS DATE), CAST(CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE) AS INT)"
        " FROM events",
        "text_profile": f"{SNAP} {_text_profile('s', 'customer_feedback')}",
        "text_profile_documents": union(_text_profile("documents", c) for c in ("text", "source")),
        "profile_findings": f"{SNAP} {_profile_findings()}",
        "verify_predictions": f"{RANKED} {_verify('q')}",
        "verify_predictions_broken": f"{_BROKEN} {_verify('br')}",
        "invalid_bands": f"{SCORED} SELECT 'x-' || risk_band AS risk_band, count(*) AS count"
        " FROM sc WHERE monthly_income < 0 GROUP BY risk_band",
        "scored_details": f"{RANKED} SELECT count(*) AS row_count,"
        " count(*) FILTER (WHERE review_queue_flag) AS queue_size,"
        " CAST(sum(predicted_label) AS BIGINT) AS positive_predictions,"
        f" {r6('avg(predicted_label)')} AS predicted_positive_rate FROM q",
        "report_sections": f"{TESTED} {_report_checks()}",
    }
