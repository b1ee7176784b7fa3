"""Every registered query against its SQL, and rules about how plans may look."""

import pathlib
import re

import pytest

import __spark_entry__ as entry
from rankwatch.operators import metrics as mt
from rankwatch.operators import quality as ql
from rankwatch.operators import scoring as sc
from rankwatch.operators import verify as vf
from rankwatch.plans import catalog, oracle
from rankwatch.sources import tables as tb

from .compare import connect, differences
from .conftest import SMALL_DIR

SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SMALL_DIR), con, SQL[name]) == []


def test_sql_covers_all_but_the_fitted_model():
    assert set(catalog.registered()) - set(SQL) == set()


def test_entry_is_the_ranked_queue(spark):
    rows = entry.entry(spark).collect()
    assert sorted(r["review_rank"] for r in rows) == list(range(1, 151))
    bands = [r["risk_band"] for r in rows]
    assert [bands.count(b) for b in ("high", "medium", "low")] == [7, 45, 98]


def test_handoff_passes(spark):
    rows = {r["name"]: r["passed"] for r in catalog.handoff(spark, SMALL_DIR).collect()}
    assert len(rows) == 5 and all(rows.values())


def test_no_escape_hatches():
    root = pathlib.Path(entry.__file__).parent / "rankwatch"
    own = (p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts)
    source = "\n".join(p.read_text() for p in own)
    for word in (r"\budf\b", "pandas_udf", "toPandas", "localCheckpoint", "crossJoin", r"\.rdd\b",
                 "mapPartitions", "applyInPandas", "collect_list", "collect_set", "mkdtemp", r"\.llm\b"):
        assert not re.search(word, source), word


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checks_scan_once(spark):
    df = tb.table(spark, SMALL_DIR, "documents")
    text = plan(ql.missing_counts(df))
    assert text.count("FileScan") == 1
    text = plan(ql.category_counts(df, ["lang", "source"]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "ReadSchema: struct<lang:string,source:string>" in text


def test_top_k_needs_no_shuffle(spark):
    df = tb.scored_snapshot(spark, SMALL_DIR).select("customer_id", "churn_probability")
    assert "TakeOrderedAndProject" in plan(sc.top_of_queue(df, catalog.CFG))


def before_single(text):
    """What feeds each single-partition exchange of a plan."""
    lines = text.splitlines()
    return [lines[i + 1] for i, x in enumerate(lines) if "Exchange SinglePartition" in x]


def test_only_aggregates_meet_in_one_task(spark):
    cfg = catalog.CFG
    df = spark.range(1000).selectExpr(
        "id AS customer_id", "rand(1) AS churn_probability", "CAST(id % 2 AS INT) AS churn"
    )
    queue = sc.review_queue(df, cfg)
    for frame in (queue, mt.average_precision(df, cfg, "churn_probability"), vf.verify_scored(queue, cfg, 3)):
        for feed in before_single(plan(frame)):
            assert "HashAggregate" in feed or "Project" in feed, feed
    window = re.search(r"row_number\(\) windowspecdefinition\((\w+)", plan(queue))
    assert window and window.group(1).startswith("_slice")


def test_snapshot_reads_only_what_is_asked(spark):
    text = plan(tb.snapshot(spark, SMALL_DIR, ["customer_id", "churn"]))
    assert not any(t in text for t in ("lineitem", "documents", "nation", "region"))
    text = plan(tb.snapshot(spark, SMALL_DIR, ["customer_id", "city"]))
    assert "nation.parquet" in text and "region.parquet" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
