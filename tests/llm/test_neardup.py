import random

import pyarrow as pa
import pytest

from rankwatch.llm import neardup as nd
from rankwatch.llm import words as W

from .brute import components, shingles

G = random.Random(11)
VOCAB = ["w%d" % i for i in range(300)]


def say(n):
    return G.choices(VOCAB, k=n)


def edited(words, n):
    out = list(words)
    for i in G.sample(range(len(out)), n):
        out[i] = "e%d" % G.randrange(10**6)
    return out


def corpus():
    """Copies, chains of small edits, a passage that most texts hold, short and odd texts."""
    texts = {}
    add = lambda words: texts.__setitem__(len(texts) * 3 + 7, words if isinstance(words, str) or words is None else " ".join(words))
    base = say(120)
    for _ in range(40):
        add(edited(base, G.randrange(0, 9)))
    passage = say(50)
    for _ in range(40):
        add(say(G.randrange(5, 40)) + passage)
    chain = say(100)
    for _ in range(12):
        add(chain)
        chain = edited(chain, 5)
    for _ in range(60):
        add(say(G.randrange(1, 200)))
    for words in ([], None, "", "   ", "One", "one", "ONE\t", "two words", "a b c", "a b c d", "a b c d e", "a b c d e f"):
        add(words)
    add(" ".join(base).upper())
    add("x " * 3000)
    return texts


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_all_pairs(spark, size, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 16)
    texts = corpus()
    rows = [(i, t, "x") for i, t in texts.items()]
    rows += rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string, sketch string").repartition(5)
    got = nd.near_duplicates(df, size=size).collect()
    label, sizes = components(texts, size)
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (sizes[i], label[i], label[i] == i), texts[i]
    assert len(set(label.values())) < len(label) - 10


def test_sets_are_the_shingles(spark):
    texts = [t for t in corpus().values()]
    found = dict(nd.shingle_sets(pa.array(texts, pa.string()), 3))
    for i, t in enumerate(texts):
        assert len(found.get(i, ())) == len(shingles(t, 3))
    # A long text cut into blocks has the same set.
    long = " ".join(say(5000))
    whole = dict(nd.shingle_sets(pa.array([long]), 3))[0]
    limit, W.blocks.__defaults__ = W.blocks.__defaults__, (1000,)
    try:
        parts = dict(nd.shingle_sets(pa.array([long]), 3))[0]
    finally:
        W.blocks.__defaults__ = limit
    assert (whole == parts).all()


def test_odd_rows(spark):
    rows = [(None, "a b c d e f g"), (None, None), (None, "other"), (3, None), (4, "a b c d e f g")]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"]) == [(0, 3, True), (3, 4, True)]
    assert len(got) == 5
    none = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(none).count() == 0


def test_rows_of_near_copies_do_not_follow_their_lists(spark, monkeypatch):
    """A group of near copies, many just not linked, meets in few lists and finds every link."""
    base = say(150)
    texts = {i: " ".join(edited(base, G.randrange(2, 12))) for i in range(120)}
    counts, stage = {}, nd.stage

    def counted(df, label):
        out = stage(df, label)
        counts.setdefault(label, out.count())
        return out

    monkeypatch.setattr(nd, "stage", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(docs, size=3).collect()}
    assert got == components(texts, 3)[0]
    assert counts["dominated"] > 20 * len(texts)
    assert 0 < counts["open-rows"] and max(counts["long-members"], counts["open-rows"]) < 12 * len(texts)


def test_lists_become_one_where_that_makes_no_more_pairs(spark):
    lists = {5: [1, 2, 3, 4], 6: [1, 2, 4], 7: [1, 3, 4], 11: [9, 20, 21], 12: [9, 22, 23], 13: [3, 4]}
    rows = [(key, rep, 50, min(reps), 50) for key, reps in lists.items() for rep in reps]
    table = spark.createDataFrame(rows, "key long, rep long, n long, a long, n_a long")
    keys = {r["rep"]: r["keys"] for r in nd._as_one(table).collect()}
    assert keys == {1: [5], 2: [5], 3: [5, 13], 4: [5, 13], 9: [11, 12], 20: [11], 21: [11], 22: [12], 23: [12]}
