import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp
from rankwatch.llm import secrets, toxicity
from rankwatch.llm.common import stage, table

from .brute import bench_words, components

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage was given and what it returned."""
    docs = table(spark, SMALL, "documents").withColumn("score", F.lit("mine"))
    out = []
    for name, step in cp.STAGES:
        after = stage(step(spark, docs, SMALL), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (a.toPandas(), b.toPandas()) for name, a, b in out}


def test_all_but_the_last_keep_the_columns(stages):
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secret_scan", "packing"]
    for name in names[:-1]:
        before, after = stages[name]
        assert list(before.columns) == list(after.columns) and set(after["score"]) == {"mine"}


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = table(spark, SMALL, "labels").toPandas().set_index("doc_id")["toxic"]
    gone = set(before["doc_id"]) - set(after["doc_id"])
    known = [labels[i] for i in gone if i in labels.index]
    assert gone and np.mean(known) > 0.9
    docs = table(spark, SMALL, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, SMALL, "labels")))
    assert gone == {r["doc_id"] for r in scored.where("predicted = 1").collect()}


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    label, _ = components(dict(zip(before["doc_id"], before["text"], strict=True)), 5)
    assert sorted(after["doc_id"]) == sorted(set(label.values())) and len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    # Every item here has ten words or more.
    runs = lambda words: {tuple(words[i : i + 10]) for i in range(len(words) - 9)}
    shared = set().union(*(runs(bench_words(r["text"])) for r in table(spark, SMALL, "benchmark").collect()))
    dirty = {
        i for i, t in zip(before["doc_id"], before["text"], strict=True) if runs(bench_words(t)) & shared
    }
    assert dirty and set(after["doc_id"]) == set(before["doc_id"]) - dirty


def test_secrets_are_replaced(stages):
    before, after = (x.sort_values("doc_id").reset_index(drop=True) for x in stages["secret_scan"])
    assert (before["doc_id"] == after["doc_id"]).all()
    assert after["text"].tolist() == [secrets.redacted(t) for t in before["text"]]
    assert (after["n_chars"] == after["text"].str.len()).all()
    assert any(before["text"] != after["text"])
    assert not any(secrets.base_spans(t) for t in after["text"])


def test_everything_left_is_packed(stages):
    before, after = stages["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip(before["doc_id"], before["text"], strict=True)}
    assert after.groupby("doc_id")["length"].sum().to_dict() == want
    assert after.groupby("sequence_id")["length"].sum().max() <= 2048


def test_odd_documents(spark, tmp_path):
    rows = [(1, None, "x"), (2, "", "x"), (3, "one text of more than five words", "x"), (3, "one text of more than five words", "x"),
            (None, "token=12345678 without an id", "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    for name, step in cp.STAGES[:-1]:
        docs = stage(step(spark, docs, SMALL), f"odd-{name}")
    left = sorted(map(tuple, docs.collect()), key=str)
    assert left == sorted([*rows[:3], (None, "[SECRET] without an id", "x"), rows[5]], key=str)
    assert cp.STAGES[-1][1](spark, docs, SMALL).count() == 5
    for name, step in cp.STAGES:
        empty = step(spark, spark.createDataFrame([], "doc_id long, text string, label string"), SMALL)
        assert empty.count() == 0


def test_rows_without_or_with_a_shared_id_are_decided_each(spark):
    a, b = "one text of more than five words here", "another text that has nothing of the first one"
    item = table(spark, SMALL, "benchmark").first()["text"]
    kinds = "doc_id long, text string, _row_key string"
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (7, a + b, "x"), (7, b + a, "x"), (7, b + a, "x"), (None, a, "x"),
            (None, "a text of its own without any id", "x"), (None, "a text of its own without any id", "x"),
            (None, None, "x"), (None, None, "x")]
    left = cp.drop_near_duplicates(spark, spark.createDataFrame(rows, kinds), SMALL).collect()
    assert sorted(map(tuple, left), key=str) == sorted([rows[0], *rows[2:5], *rows[8:]], key=str)
    rows = [(None, f"so {item}", "x"), (None, a, "x"), (5, item, "x"), (5, b, "x"), (None, None, "x")]
    left = cp.drop_contaminated(spark, spark.createDataFrame(rows, kinds), SMALL).collect()
    assert sorted(map(tuple, left), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
