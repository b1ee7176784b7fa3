import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankwatch.llm import decontam as dc

from .brute import bench_words, contamination, sha

G = random.Random(4)
VOCAB = ["tower", "lamp", "Éclair", "río", "seven", "7", "of", "the", "and", "a"]
SAY = lambda n: " ".join(G.choices(VOCAB, k=n))
ITEMS = [
    (1, SAY(30)), (2, SAY(14)), (3, SAY(10)), (4, "only four words here"), (5, "single"), (6, ""), (7, None),
    (8, "the of " * 12), (10, SAY(11)), (4, "only four words here"),
]


def documents():
    out = [(i, SAY(60), "x") for i in range(30)]
    long = ITEMS[0][1].split()
    out += [
        (100, SAY(20) + " " + " ".join(long[5:15]).upper() + "! " + SAY(9), "x"),
        (101, " ".join(long[3:12]), "x"),  # nine words: one too few
        (102, f"{ITEMS[1][1]}; {ITEMS[2][1]} {SAY(5)} {ITEMS[2][1]}", "x"),
        (103, "Only,FOUR-words.here and single", "x"),
        (104, "the of " * 40, "x"),
        (105, None, "x"), (106, "", "x"), (107, " ...", "x"), (108, "É " * 15, "x"), (109, "single", "x"),
        (110, ITEMS[8][1] + "\x00" + ITEMS[8][1], "x"), (110, ITEMS[8][1] + "\x00" + ITEMS[8][1], "x"),
    ]
    return out


def test_report_equals_brute_force(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.report(docs, items).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        n, hit, found = contamination(text[r["doc_id"]], ITEMS)
        want = (n, hit, len(found), sha(",".join(found)), hit > 0)
        assert tuple(r)[1:] == want, r["doc_id"]
    assert sum(r["contaminated"] for r in got) >= 7


def test_empty_sides(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.report(docs.limit(0), items).count() == 0
    clean = dc.report(docs, items.limit(0)).collect()
    assert len(clean) == len(documents()) and not any(r["contaminated"] for r in clean)


def test_items_without_an_id_count(spark):
    long, short = SAY(12), "no more than four"
    items = spark.createDataFrame([(None, long), (None, short), (1, "named item here"), (None, None)], "item_id long, text string")
    rows = [(1, f"x {long} y"), (2, short), (None, f"{short} and a named item here"), (4, "nothing")]
    got = dc.report(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    want = {
        1: (12, 0, sha(""), True), 2: (4, 0, sha(""), True), None: (7, 1, sha("1"), True), 4: (0, 0, sha(""), False),
    }
    assert {r["doc_id"]: tuple(r)[2:] for r in got} == want


def test_null_id_and_null_text_are_told_apart(spark):
    rows = [(None, "just these four words"), ("just these four words", None)]
    items = spark.createDataFrame([(1, "just these four words")], "item_id long, text string")
    got = dc.report(spark.createDataFrame(rows, "doc_id string, text string"), items).collect()
    assert {r["doc_id"]: r["contaminated"] for r in got} == {None: True, rows[1][0]: False}


def kept(hashes, w):
    """Smallest of every full window, and of the shorter ones at the end."""
    return {min(hashes[i : i + w]) for i in range(len(hashes))}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=6, max_size=30), st.lists(st.integers(0, 50), max_size=9), st.integers(2, 6))
def test_a_shared_run_of_hashes_keeps_a_common_one(run, other, w):
    shared = run[: max(w, 6)]
    assert kept(shared + other, w) & kept(other + shared, w)


@pytest.mark.parametrize("w", [1, 2, 3, 5, 6, 7])
def test_kept_hashes_are_the_minima_of_the_windows(spark, w):
    text = SAY(25)
    df = spark.createDataFrame([(text,)], "text string").select(dc.words(dc.F.col("text")).alias("t"))
    out = dc.with_kept_hashes(df, "t", "k", 3, w)
    all_ = out.select(dc.gram_hashes(dc.F.col("t"), 3)).first()[0]
    assert len(all_) == len(bench_words(text)) - 2
    assert set(out.first()["k"]) == kept(all_, w)


def test_native_plan(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = dc.report(docs, items)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert word not in plan
