"""Token counts by finite-state transducers.

The splitting rule of the byte-level tokenizer (contractions, an optional blank before a run
of letters, digits or signs, white space by itself) is compiled into a deterministic
transducer over 13 character symbols. A transition says where a piece has ended: before
the current character, before the one ahead of it, or both. The merges inside a piece form
the second transducer: its state is the piece read so far, and the transition that leaves a
piece emits the piece's number of tokens. That table is compiled as pieces turn up, from the
ranked merges of the vocabulary, and kept per worker within a fixed size.

A block of text is cut into chunks that are scanned side by side. For a chunk the first pass
computes its state map (exit state for each entry state); the maps compose by a parallel
prefix scan, which gives every chunk its true entry state; the second pass emits.

Texts with characters outside the compiled alphabet (code points from 0x180, odd controls) or
with the opening of a special string are counted by the library as a whole: same result.

Null and empty texts have 0 tokens. Repeated rows are counted each. Extra columns of the input
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.llm import bpe
from rankwatch.llm import words as W
from rankwatch.llm.common import small_batches

# Symbols: contraction letters apart from the other letters.
(LET, S_T_M_D, R, V, L, E, NUM, SIGN, TICK, BLANK, WHITE, PAD) = range(12)
_FIRST = 12  # a symbol plus this: the first character of a text
_SYMBOLS = 2 * _FIRST
(START, IN_L, IN_N, IN_O, ONE_BLANK, ONE_WHITE, BLANKS, WHITES, IN_T, T_R, T_V, T_L, DONE) = range(13)
_STATES = 13
BEFORE, BEFORE_LAST = 1, 2
_CHUNK = 512


def _fresh(sym: int) -> int:
    if sym <= E:
        return IN_L
    return {NUM: IN_N, SIGN: IN_O, TICK: IN_T, BLANK: ONE_BLANK, WHITE: ONE_WHITE}[sym]


def _step(state: int, sym: int) -> tuple[int, int]:
    """(next state, where pieces have ended) for one character."""
    letter, white = sym <= E, sym in (BLANK, WHITE)
    sign = sym in (SIGN, TICK)
    if state == IN_L and letter or state == IN_N and sym == NUM or state == IN_O and sign:
        return state, 0
    if state in (ONE_BLANK, ONE_WHITE, BLANKS, WHITES):
        if white:
            return (BLANKS if sym == BLANK else WHITES), 0
        many = BEFORE_LAST if state in (BLANKS, WHITES) else 0
        if state in (ONE_BLANK, BLANKS):  # the last blank belongs to what follows
            return (IN_O if sign else _fresh(sym)), many
        return _fresh(sym), many | BEFORE
    if state == IN_T:
        if sym == S_T_M_D:
            return DONE, 0
        if sym in (R, V, L):
            return {R: T_R, V: T_V, L: T_L}[sym], 0
        if sign:
            return IN_O, 0
    if state in (T_R, T_V, T_L):
        if sym == (L if state == T_L else E):
            return DONE, 0
        after, ended = _step(IN_L, sym)
        return after, ended | BEFORE_LAST
    return _fresh(sym), BEFORE


@cache
def compiled() -> tuple[np.ndarray, np.ndarray]:
    """Next states (times the alphabet size) and emissions, both by state and symbol."""
    after = np.zeros((_STATES, _SYMBOLS), np.uint16)
    ended = np.zeros((_STATES, _SYMBOLS), np.uint8)
    for s in range(_STATES):
        for a in range(PAD):
            after[s, a], ended[s, a] = _step(s, a)
            # A new text: what was open ends, an unfinished contraction was a lone tick.
            after[s, a + _FIRST] = _fresh(a)
            ended[s, a + _FIRST] = BEFORE | (BEFORE_LAST if s in (T_R, T_V, T_L) else 0)
        after[s, PAD] = s
        after[s, PAD + _FIRST] = START
        ended[s, PAD + _FIRST] = BEFORE | (BEFORE_LAST if s in (T_R, T_V, T_L) else 0)
    return (after * _SYMBOLS).ravel(), ended.ravel()


_SYMBOL_OF = np.full(W.PLAIN, SIGN, np.uint8)
_SYMBOL_OF[W.CLASSES == W.LETTER] = LET
_SYMBOL_OF[W.CLASSES == W.NUMBER] = NUM
_SYMBOL_OF[W.CLASSES == W.SPACE] = WHITE
_SYMBOL_OF[32] = BLANK
_SYMBOL_OF[39] = TICK
for _c, _s in zip("stmdrvle", [S_T_M_D] * 4 + [R, V, L, E], strict=True):
    _SYMBOL_OF[ord(_c)] = _s


def emissions(symbols: np.ndarray, chunk: int = _CHUNK) -> np.ndarray:
    """Where pieces ended, per symbol: the two-pass scan over chunks."""
    after, ended = compiled()
    rows = -(-len(symbols) // chunk)
    padded = np.full(rows * chunk, PAD, np.uint8)
    padded[: len(symbols)] = symbols
    columns = np.ascontiguousarray(padded.reshape(rows, chunk).T)

    maps = np.repeat(np.arange(_STATES, dtype=np.uint16)[:, None] * _SYMBOLS, rows, axis=1)
    for column in columns:
        maps = after.take(maps + column)
    # Inclusive prefix scan of function composition.
    maps = (maps // _SYMBOLS).T
    reach = 1
    while reach < rows:
        composed = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.int64), axis=1)
        maps = np.concatenate([maps[:reach], composed])
        reach *= 2
    entry = np.zeros(rows, np.uint16)
    entry[1:] = maps[:-1, START]

    state = entry * _SYMBOLS
    out = np.empty_like(columns)
    for i, column in enumerate(columns):
        at = state + column
        out[i] = ended.take(at)
        state = after.take(at)
    return out.T.reshape(-1)[: len(symbols)]


def pieces(block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begins, ends, odd parts) of the pieces of a block, in bytes."""
    data = block.data
    odd_bytes = W._ODD_BYTE[data]
    odd_bytes[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead]
    cp = first.astype(np.int64)
    two = np.flatnonzero((first >= 0xC2) & (first <= 0xC5))
    cp[two] = ((cp[two] & 0x1F) << 6) | (data[lead[two] + 1] & 0x3F)
    wide = cp >= W.PLAIN
    cp[wide] = 0
    odd_bytes[lead[two]] |= (cp[two] >= 0x80) & (cp[two] < 0xA0)
    symbols = _SYMBOL_OF[cp]
    symbols[np.searchsorted(lead, block.starts)] += _FIRST
    marks = emissions(np.append(symbols, np.uint8(PAD + _FIRST)))
    cut = np.zeros(len(lead) + 1, bool)
    cut |= (marks & BEFORE) > 0
    cut[:-1] |= (marks[1:] & BEFORE_LAST) > 0
    edges = np.append(lead, len(data))[cut]
    odd = np.unique(W.doc_of(np.flatnonzero(odd_bytes), block.starts))
    return edges[:-1], edges[1:], odd


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        layout = json.load(f)
    split = layout.get("pre_tokenizer") or {}
    ours = (
        split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not layout.get("normalizer")
    )
    # Special tokens that do not open with these two signs would be overlooked.
    ours = ours and all(t["content"].startswith("<|") for t in layout.get("added_tokens", ()))
    return Tokenizer.from_file(path), W.Memo(dtype=np.int32), ours and bpe.merges(path).usable


def count_batch(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens per text of a string column."""
    tokenizer, memo, ours = _tokenizer(path)
    counts = np.zeros(len(texts), np.int64)
    whole = set() if ours else set(range(len(texts)))
    for block in W.blocks(texts) if ours else ():
        begins, ends, odd = pieces(block)
        whole.update(block.docs[odd].tolist())
        hashes = W.span_hashes(block.data, begins, ends)
        keys, at, back = np.unique(hashes, return_index=True, return_inverse=True)

        def make(fresh, data=block.data, b=begins[at], e=ends[at]):
            # Pieces of odd parts may break a character; their counts are never used.
            b, e = b[fresh], e[fresh]
            short = e - b <= bpe.LONGEST
            out = np.zeros(len(fresh), np.int32)
            out[short] = bpe.merges(path).encode(data, b[short], e[short])[1]
            for i in np.flatnonzero(~short).tolist():
                piece = data[b[i] : e[i]].tobytes().decode("utf-8", "replace")
                out[i] = len(tokenizer.encode(piece, add_special_tokens=False))
            return out

        emitted = memo.get(keys, make)[back]
        np.add.at(
            counts,
            block.docs,
            np.add.reduceat(emitted, np.searchsorted(begins, block.starts)).astype(np.int64),
        )
    for i in sorted(whole):
        text = texts[i].as_py() or ""
        counts[i] = len(tokenizer.encode(text, add_special_tokens=False))
    return counts


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(W.buffers(texts)[0])), pa.array(count_batch(texts, tokenizer_path))],
                ["id", "n_bytes", "n_tokens"],
            )

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string"))
    kind = narrow.schema["id"].dataType.simpleString()
    counted = narrow.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
