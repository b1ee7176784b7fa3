import math
import random

import pytest

from rankwatch.llm import langid as li
from rankwatch.llm.common import table
from rankwatch.llm.toxicity import held_out

SMALL = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    docs = table(spark, SMALL, "documents")
    got = li.predict(docs, li.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got["lang"] == got["lang_pred"])[got["held_out"]].mean() > 0.98
    assert got["held_out"].sum() == docs.where(held_out(docs["doc_id"])).count()
    assert ((got["score"] >= 0) & (got["score"] <= 1)).all()


def grams(word, order):
    padded = "\x01" + word + "\x01" if order > 1 else word
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def test_scores_equal_a_plain_backoff(spark):
    """Known words by their log frequency, unseen ones by the longest known n-grams."""
    g = random.Random(6)
    alphabet = {"aa": "abcdeé", "bb": "defghß"}
    say = lambda lang: " ".join("".join(g.choices(alphabet[lang], k=g.randrange(1, 7))) for _ in range(30))
    rows = [(i, say(lang), lang) for i in range(60) for lang in alphabet]
    docs = spark.createDataFrame([(i * 2 + (k == "bb"), t, k) for i, t, k in rows], "doc_id long, text string, lang string")
    model = li.fit(docs)
    train = [r for r in docs.where(~held_out(docs["doc_id"])).collect()]
    counts = {}
    for r in train:
        for w in r["text"].split():
            counts.setdefault(("w", w), {}).setdefault(r["lang"], []).append(1)
            for n in li.ORDERS:
                for x in grams(w, n):
                    counts.setdefault((n, x), {}).setdefault(r["lang"], []).append(1)

    def logs(kind, keep):
        known = {k: {a: len(v) for a, v in c.items()} for k, c in counts.items() if kind(k[0])}
        known = {k: {a: n for a, n in c.items() if n >= keep} for k, c in known.items()}
        known = {k: c for k, c in known.items() if c}
        out = {}
        for lang in ("aa", "bb"):
            total = sum(c.get(lang, 0) for c in known.values()) + 0.5 * len(known)
            for k, c in known.items():
                out.setdefault(k, {})[lang] = math.log((c.get(lang, 0) + 0.5) / total)
        return out

    word_logs, gram_logs = logs(lambda k: k == "w", li.MIN_COUNT), logs(lambda k: k != "w", 1)
    texts = [say("aa"), say("bb"), "zz abc", "éééé def", "hgß"]
    import numpy as np
    import pyarrow as pa

    from rankwatch.llm import words as W

    for t in texts:
        block = next(W.blocks(pa.array([t])))
        data, begin, end, _ = li.spelled(block)
        keys = W.span_hashes(data, begin, end)
        got = model.word_scores(data, begin, end, keys)
        for i, w in enumerate(t.split()):
            score = word_logs.get(("w", w))
            for n in li.ORDERS:
                if score is None:
                    known = [gram_logs[n, x] for x in grams(w, n) if (n, x) in gram_logs]
                    if known:
                        score = {lang: sum(k[lang] for k in known) / len(known) for lang in ("aa", "bb")}
            want = np.array([score["aa"], score["bb"]]) if score else np.zeros(2)
            assert got[i] == pytest.approx(want - want.mean(), abs=1e-5), w


def test_odd_rows(spark):
    docs = table(spark, SMALL, "documents")
    model = li.fit(docs)
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 - !!", "x"), (None, "the thing", "x"), (4, "漢字", "x"), (4, "漢字", "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {(r["doc_id"]): (r["lang_pred"], r["score"]) for r in li.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[None][0] == "en" and got[4][0] in model.languages
    assert li.predict(odd.limit(0), model).count() == 0
    nothing = li.fit(docs.limit(0))
    assert {r["lang_pred"] for r in li.predict(odd, nothing).collect()} == {"und"}
