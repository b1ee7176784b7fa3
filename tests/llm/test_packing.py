import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rankwatch.llm import packing as pk

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = ["a", "s", "t", "'", "re", "ve", "ll", "r", " ", "\n", "1", "9", "!", "-", "é", "Ñ", "ß", "ª", "²", "'S",
         "<|endoftext|>", "…", "\x85", "\x1f", "𝒳", "İ", "ŉ", "é", "\xa0"]


def texts(n, seed=3):
    g = random.Random(seed)
    out = ["".join(g.choices(SIGNS[: 20 if i % 3 else 99], k=g.randrange(40))) for i in range(n)]
    return [*out, "", None, "Over and over again. " * 4000]


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_ids_are_those_of_the_library(path):
    given = texts(3000)
    library = Tokenizer.from_file(path)
    got = dict(pk.encode_batch(pa.array(given), path))
    for i, t in enumerate(given):
        assert got.get(i, np.zeros(0)).tolist() == library.encode(t or "", add_special_tokens=False).ids, t


def test_nnls_meets_the_conditions_of_the_optimum():
    g = np.random.default_rng(5)
    a, b = g.random((20, 30)), g.normal(size=20) * 5
    x = pk.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope <= 1e-6).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6


@pytest.mark.parametrize("histogram", [[0] * 16, [5] * 16, [1000] + [0] * 15, [0] * 9 + [70] + [0] * 6, [3, 0, 9] + [1] * 13])
def test_plan_places_every_piece(histogram):
    used = np.zeros(16, int)
    for lengths, copies in pk.plan(histogram):
        assert sum(lengths) <= 16 and copies > 0
        for b in lengths:
            used[b - 1] += copies
    assert used.tolist() == histogram


def test_pieces_and_sequences(spark):
    given = texts(400)
    rows = [(i, t, "x") for i, t in enumerate(given)] + [(1, given[1], "x"), (None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(4)
    got = pk.pack(df, PATH, keep_ids=True).collect()
    library = Tokenizer.from_file(PATH)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _ in rows}
    seen, sequences = {}, {}
    for r in got:
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert list(r["ids"]) == ids and r["doc_tokens"] == len(want[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, ids in want.items():
        times = 2 if i == 1 else 1
        assert sum(n for _, n in seen[i]) == times * len(ids)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))


def test_little_padding_and_nothing_to_pack(spark):
    g = random.Random(8)
    rows = [(i, "day " * g.randrange(1, 3000)) for i in range(3000)]
    got = pk.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH)
    total = got.selectExpr("sum(length)", "count(DISTINCT sequence_id)").first()
    assert total[0] / (2048 * total[1]) > 0.97
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pk.pack(none, PATH).count() == 0
