import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rankwatch.llm import tokencount as tc
from rankwatch.llm import words as W

from .test_packing import BYTES, PATH, texts


@pytest.mark.parametrize("path", [BYTES, PATH])
def test_counts_are_those_of_the_library(path):
    given = texts(3000, 7)
    library = Tokenizer.from_file(path)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in given]
    assert tc.count_batch(pa.array(given), path).tolist() == want


def run_states(symbols):
    """The transducer, one symbol after another."""
    after, ended = tc.compiled()
    state, out = tc.START, []
    for s in symbols:
        at = state * tc._SYMBOLS + s
        out.append(int(ended[at]))
        state = int(after[at]) // tc._SYMBOLS
    return out


@pytest.mark.parametrize("chunk", [1, 2, 7, 64])
def test_scan_over_chunks_equals_one_pass(chunk):
    g = random.Random(chunk)
    symbols = np.array([g.randrange(11) + 12 * (g.random() < 0.05 or i == 0) for i in range(500)], np.uint8)
    assert tc.emissions(symbols, chunk).tolist() == run_states(symbols.tolist())


def test_pieces_are_those_of_the_pattern():
    library = Tokenizer.from_file(BYTES)
    for t in texts(1500, 9)[:-1]:
        if not t:
            continue
        block = next(W.blocks(pa.array([t])))
        begins, ends, odd = tc.pieces(block)
        if not len(odd):
            raw = t.encode()
            assert [raw[a:b] for a, b in zip(begins, ends, strict=True)] == [
                "".join(t[a:b]).encode() for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(t)
            ]


def test_columns_and_odd_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "", "x"), (3, "word " * 1100, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, tc.count_tokens(df, BYTES).collect()), key=str)
    assert got == sorted(
        [(1, 3, 2, False)] * 2 + [(2, 0, 0, False), (None, 0, 0, False), (3, 5500, 1101, True)], key=str
    )
    assert tc.count_tokens(df.limit(0), BYTES).count() == 0


def test_small_blocks_change_nothing(monkeypatch):
    given = pa.array(["one two three four five " * 200, None, "'s x's " * 50])
    whole = tc.count_batch(given, BYTES)
    monkeypatch.setattr(W.blocks, "__defaults__", (100,))
    assert (tc.count_batch(given, BYTES) == whole).all()
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTES
