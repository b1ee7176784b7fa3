import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankwatch.llm import toxicity as tx
from rankwatch.llm import words as W
from rankwatch.llm.common import table

SMALL = "/root/testdata/sf0.01"


def spelled(words):
    block = next(W.blocks(pa.array([" ".join(words)])))
    signs, begin, end, _ = tx.units(block)
    return [signs[b:e] for b, e in zip(begin, end, strict=True)]


def kernel(s, t, decay=tx.DECAY):
    """Gap-weighted subsequences of three signs, straight from the definition."""
    total = 0.0
    triples = lambda u: [
        ((u[i], u[j], u[k]), decay ** (k - i + 1))
        for i in range(len(u)) for j in range(i + 1, len(u)) for k in range(j + 1, len(u))
        if u[i] and u[j] and u[k]
    ]
    for a, x in triples(s):
        for b, y in triples(t):
            total += x * y * (a == b)
    return total


def test_units_keep_gaps_and_join_single_letters():
    text = "Hello, i d i o t! st-u.pid 1d10t 42 a b"
    block = next(W.blocks(pa.array([text])))
    signs, begin, end, part = tx.units(block)
    letters = ["".join(chr(96 + c) if c else "." for c in signs[b:e]) for b, e in zip(begin, end, strict=True)]
    assert letters == ["hello", "i.d.i.o.t", "st.u.pid", "idiot", "a", "b"] and set(part) == {0}
    long = spelled(["x" * 40])
    assert [len(u) for u in long] == [16, 16, 16, 16] and sum(map(len, long)) >= 40


def test_kernels_are_those_of_the_definition():
    one, two, three = spelled(["stupid", "st-uxpid", "patient"])
    for u in (one, two, three):
        assert tx.self_kernels(u[None, :])[0] == pytest.approx(kernel(u, u))
    dense = tx._dense([one, two, three])
    for i, s in enumerate((one, two, three)):
        for j, t in enumerate((one, two, three)):
            want = kernel(s, t) / (kernel(s, s) * kernel(t, t)) ** 0.5
            assert dense[i] @ dense[j] == pytest.approx(want)


def test_folded_machine_is_the_landmark_expansion():
    rng = random.Random(1)
    good = spelled(["idiot", "stupid", "moron", "scum"])
    bad = spelled(["".join(rng.choices("thenadro", k=6)) for _ in range(30)])
    model = tx._machine(good, np.ones(len(good)), bad)
    marks = tx._dense(good + bad)
    value, vector = np.linalg.eigh(marks @ marks.T)
    keep = value > 1e-6 * value[-1]
    root = vector[:, keep] / np.sqrt(value[keep])
    z = marks @ marks.T @ root
    y = np.r_[np.ones(4), -np.ones(30)]
    w = tx.squared_hinge(z, y, np.r_[np.full(4, 0.25), np.full(30, 4 / 30)], 1e-4)
    test = spelled(["idi-ot", "thenor"])
    want = tx._dense(test) @ marks.T @ root @ w[:-1] + w[-1]
    got = [model.margins(u, np.array([0]), np.array([len(u)]))[0] for u in test]
    assert got == pytest.approx(want.tolist())
    assert got[0] > 0 > got[1]


def test_the_fit_holds_few_dense_units_at_once():
    rng = random.Random(2)
    words = list({"".join(rng.choices("abcdefghijklmnopqrst", k=rng.randint(4, 12))) for _ in range(700)})
    units = [np.frombuffer(w.encode(), np.uint8) - 96 for w in words]
    good, bad = units[:300], units[300:]
    tracemalloc.start()
    model = tx._machine(good, np.ones(len(good)), bad)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Beside the landmarks stands less than once more of them.
    assert peak < 2 * tx.LANDMARKS * tx.SIDE**3 * 8
    assert all(model.margins(u, np.array([0]), np.array([len(u)]))[0] > 0 for u in good[:5])


def test_held_out_rows_and_gapped_insults(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = tx.fit(docs, labels)
    got = tx.score(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    right = ((got["score"] >= 0.7) == (got["toxic"] == 1)).mean()
    assert right > 0.95
    assert ((got["score"] >= 0) & (got["score"] <= 1)).all() and (got["predicted"] == (got["score"] >= 0.7)).all()


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "you idiot", "c"), (4, "12 !! 3", "d"), (4, "12 !! 3", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    clear = [(100 + i, "the idiot" if i % 2 else "a fine day and more", str(i)) for i in range(60)]
    train = spark.createDataFrame(clear, "doc_id long, text string, score string")
    train = train.withColumn("text", F.concat_ws(" ", "text", "score"))
    labels = train.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = tx.fit(train, labels)
    got = tx.score(docs, model).collect()
    assert len(got) == 5 and {r["doc_id"] for r in got} == {1, 2, None, 4}
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1] == by[2] == by[4] < by[None]
    kept = tx.clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    assert tx.score(docs.limit(0), model).count() == 0


def test_few_toxic_labels_still_make_a_witness(spark):
    """2 % toxic: an insult in 60 % of the toxic and 1.5 % of the clean texts (p < n, lift 40)."""
    rng, rows = random.Random(5), []
    say = lambda: " ".join("".join(rng.choices("thenadro", k=6)) for _ in range(8))
    for i in range(3000):
        toxic = i % 50 == 0
        insult = i % 5 < 3 and i // 50 % 5 < 3 if toxic else i % 67 == 1
        rows.append((i, f"{say()} scumbag {i}" if insult else say(), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held = df.where(tx.held_out(F.col("doc_id")))
    model = tx.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert model.floor is None and model.margins(spelled(["scumbag"])[0], np.array([0]), np.array([7]))[0] > 0
    got = tx.score(held, model).join(held, "doc_id").toPandas()
    has = got["text"].str.contains("scumbag")
    assert got["score"][has].min() > 0.2 > 0.1 > got["score"][~has].median()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "idiot"), (2, "fine")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in tx.score(docs, tx.fit(docs, none)).collect()} == {0.0}
