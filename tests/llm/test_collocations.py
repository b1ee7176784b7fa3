import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankwatch.llm import collocations as co
from tests.compare import connect, differences
from tests.llm.brute import LOWER
from rankwatch.llm import oracle

COLUMNS = "doc_id long, text string, lang string"
NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def brute(rows, least=10, share=50, top=2000):
    out = []
    for lang in {r[2] if r[2] is not None else "und" for r in rows}:
        f = Counter()
        for _, text, own in rows:
            if (own if own is not None else "und") == lang:
                for words in pieces(text):
                    f.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            longer = (q for q in found if len(q) > len(p) and p in (q[:2], q[1:]))
            if any(100 * found[q] >= share * a for q in longer):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            s, _, l_, r = min(cuts)
            scored.append((-s, -a, " ".join(p).encode(), l_, r))
        for rank, (s, a, p, l_, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l_, r, n, -s))
    return sorted(out)


def same(got, want):
    assert got.columns == NAMES
    assert sorted(tuple(r) for r in got.collect()) == want


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "The", "a", "Éa", "new", "york", "city", "x\x00y", "z z", "–"] + [f"w{i}" for i in range(30)]
    ends = [" ", " ", "  ", "\t", " ", " ", ", ", ". ", "\n", "\r\n", "!", "\x0b", ";", ": "]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(60)):
            text += rng.choice(words[: rng.choice([4, 10, 41])]) + rng.choice(ends)
            if rng.random() < 0.1:
                text += "new york city" + rng.choice(ends)
        rows.append((i, text, rng.choice(["en", "de", None, "und", "fr"])))
    return rows


@pytest.mark.parametrize("flush, route_rows", [(2_000_000, 400_000), (500, 400_000), (300, 40)])
def test_equals_counting(spark, flush, route_rows):
    rows = corpus(1, 400)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    same(co.collocations(df, flush=flush, route_rows=route_rows), brute(rows))


def test_top_and_ties(spark):
    rows = corpus(2, 300)
    df = spark.createDataFrame(rows, COLUMNS)
    same(co.collocations(df, top=7, least=5, share=80), brute(rows, 5, 80, 7))


def test_odd_input(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, " \t.,\n", None), (None, "a b c " * 12, None), (5, "a b c " * 12, "und"),
            (6, "one", "en")] + [(7, "Same Same same. same", "en")] * 30 + [(8, "w, " * 20, "de")]
    df = spark.createDataFrame(rows, COLUMNS)
    clash = df.withColumns({c: F.lit(1) for c in ("w1", "w2", "c", "f", "a", "l", "n", "rank", "spread", "route")})
    same(co.collocations(clash), brute(rows))
    assert co.collocations(df.limit(0)).collect() == []


def test_texts_longer_than_a_block(spark):
    words = [f"v{i % 97}" + "." * (i % 11 == 0) for i in range(400_000)]
    rows = [(1, " ".join(words), "en"), (2, "lone " * 300_000, "en"), (3, "short one", "en")]
    same(co.collocations(spark.createDataFrame(rows, COLUMNS)), brute(rows))


@pytest.mark.parametrize("n, kinds", [(10, 3), (200_000, 4), (200_000, 5000), (100_000, 1)])
def test_quicksort_counts_partitions(n, kinds):
    rng = np.random.default_rng(n + kinds)
    keys = [(rng.zipf(1.3, n) % kinds).astype(np.int64) - 1 for _ in range(3)]
    weight = rng.integers(1, 5, n)
    for least in ([0, 0, 0], [40, 40, 40]):
        got = co.multikey(keys, weight, least)
        alive = np.ones(n, bool)
        for depth in range(3):
            sizes = Counter()
            code = list(zip(*(k.tolist() for k in keys[: depth + 1]), strict=True))
            for c, w, ok in zip(code, weight.tolist(), alive, strict=True):
                if ok:
                    sizes[c] += w
            sizes = {c: s for c, s in sizes.items() if s >= least[depth]}
            at, size = got[depth]
            assert {code[i]: s for i, s in zip(at.tolist(), size.tolist(), strict=True)} == sizes
            assert len(at) == len(sizes)
            alive &= np.array([c in sizes for c in code])


def test_words_and_pieces():
    data = pa.array(["A b.C", None, "", "d\te ", ".,", "f"], pa.string())
    (raw, starts, docs), = co._blocks(data)
    text, head, doc = co.words(raw, starts, docs)
    assert text.to_pylist() == ["a", "b", "c", "d", "e", "f"]
    assert head.tolist() == [True, False, True, True, False, True] and doc.tolist() == [0, 0, 0, 3, 3, 5]


def test_sql_counts_the_same(spark):
    rows = corpus(3, 200)
    df = spark.createDataFrame(rows, COLUMNS)
    con = connect("/root/testdata/sf0.001")
    con.execute("CREATE OR REPLACE TEMP TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r for r in rows if "\x00" not in (r[1] or "")])
    plain = df.where(~F.col("text").contains("\x00"))
    assert differences(co.collocations(plain), con, oracle.statements()["op11_phrase_collocations"]) == []
