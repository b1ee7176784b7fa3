"""Packing tokenised documents into fixed windows by non-negative least squares.

Every document becomes its token ids and an end id, cut into full windows and a rest. The
histogram of piece lengths (in steps of `step` tokens, rounded up, so at most window / step
rows) is all the driver sees. Shallow combinations of lengths that fill a window exactly
are the columns of a matrix; non-negative least squares finds how often each should be used to
meet the histogram; the counts are rounded down, and the greedy rest takes the longest piece
left and fills up with the longest that fits. Pieces are then numbered inside their length and
each takes the place that the plan gives its number.

Numbering is by cells of (length, hash of the row) with summed offsets, so a length that a
third of all pieces has is spread over tasks.

Null and empty texts are one piece that holds the end id. Repeated rows are packed each.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwatch.llm import bpe
from rankwatch.llm import words as W
from rankwatch.llm.common import numbered, small_batches, stage, tidy

WINDOW = 2048
STEP = 16
DEPTH = 3
CELLS = 64
ROWS_PER_CELL = 100_000


# ---- token ids --------------------------------------------------------------------------


def word_pieces(block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased data, begins, ends, odd parts) of contractions, runs of letters, single
    digits and runs of signs; white space is dropped."""
    cls, odd = W.classes(block.data)
    odd[:-1] |= (block.data[:-1] == 0x3C) & (block.data[1:] == 0x7C)
    data = W.lowered(block.data)
    begin, end = W.runs(cls, block.starts)
    kind = cls[begin]
    cut = np.zeros(len(data) + 1, bool)
    cut[begin] = True
    numbers = (cls == W.NUMBER) & ((data & 0xC0) != 0x80)
    cut[:-1] |= numbers
    # A lone tick takes s, t, m, d or re, ve, ll from the letters after it.
    alone = (kind[:-1] == W.OTHER) & (end[:-1] - begin[:-1] == 1) & (kind[1:] == W.LETTER)
    tick = np.flatnonzero(alone)
    tick = tick[data[begin[tick]] == 39]
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[block.starts] = True
    p, stop = begin[tick + 1], end[tick + 1]
    inside = ~starts_text[p]
    p, stop = p[inside], stop[inside]
    a = data[p]
    b = np.where(p + 1 < stop, data[np.minimum(p + 1, len(data) - 1)], 0)
    one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
    two = (((a == 114) | (a == 118)) & (b == 101)) | ((a == 108) & (b == 108))
    cut[p[one | two]] = False
    cut[p[one] + 1] = True
    cut[p[two] + 2] = True
    cut[-1] = False
    at = np.flatnonzero(cut)
    to = np.append(at[1:], len(data))
    keep = cls[at] != W.SPACE
    odd_parts = np.unique(W.doc_of(np.flatnonzero(odd), block.starts))
    return data, at[keep], to[keep], odd_parts


class _Ids:
    """Token ids by piece: a memo of (place, length) into one pool."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        split = json.dumps(layout.get("pre_tokenizer"))
        rule = r"'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
        self.ours = rule in split and "Lowercase" in json.dumps(layout.get("normalizer"))
        self.ours &= all(t["content"].startswith("<|") for t in layout.get("added_tokens", ()))
        self.merges = bpe.merges(path)
        self.ours &= self.merges.usable
        self.memo = W.Memo(width=2, dtype=np.int64, most=1 << 19)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def add(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(place in the pool, length) of new pieces."""
        out = np.zeros((len(begins), 2), np.int64)
        short = ends - begins <= bpe.LONGEST
        ids, counts = self.merges.encode(data, begins[short], ends[short])
        out[short] = np.stack([self.used + np.cumsum(counts) - counts, counts], axis=1)
        self._append(ids)
        for i in np.flatnonzero(~short).tolist():
            text = data[begins[i] : ends[i]].tobytes().decode("utf-8", "replace")
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            out[i] = self.used, len(ids)
            self._append(np.array(ids, np.uint32))
        return out

    def _append(self, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def block(self, block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the block, number of ids per part, odd parts)"""
        data, begins, ends, odd = word_pieces(block)
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(block.docs), np.int64), odd
        keys, at, back = np.unique(
            W.span_hashes(data, begins, ends), return_index=True, return_inverse=True
        )
        if len(self.memo.keys) + len(keys) > self.memo.most:
            self.memo.clear()
            self.used = 0

        def make(fresh):
            return self.add(data, begins[at[fresh]], ends[at[fresh]])

        place, count = self.memo.get(keys, make)[back].T
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(place - before[:-1], count) + np.arange(before[-1])]
        edges = np.searchsorted(begins, np.append(block.starts, len(data)))
        return ids, np.diff(before[edges]), odd


@cache
def _ids(path: str) -> _Ids:
    return _Ids(path)


def encode_batch(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(position, ids) of every text that has ids; a long text's ids are joined."""
    table = _ids(path)
    plain = lambda i: table.tokenizer.encode(texts[i].as_py() or "", add_special_tokens=False).ids
    if not table.ours:
        for i in range(len(texts)):
            yield i, np.array(plain(i), np.uint32)
        return
    open_doc, parts, odd_doc = -1, [], False
    for block in W.blocks(texts):
        ids, counts, odd = table.block(block)
        edges = np.concatenate([[0], np.cumsum(counts)])
        is_odd = np.zeros(len(block.docs), bool)
        is_odd[odd] = True
        for k, doc in enumerate(block.docs.tolist()):
            own = ids[edges[k] : edges[k + 1]]
            if doc == open_doc:
                parts.append(own)
                odd_doc |= bool(is_odd[k])
                continue
            if open_doc >= 0:
                yield open_doc, np.array(plain(open_doc), np.uint32) if odd_doc else _joined(parts)
            open_doc, parts, odd_doc = doc, [own], bool(is_odd[k])
    if open_doc >= 0:
        yield open_doc, np.array(plain(open_doc), np.uint32) if odd_doc else _joined(parts)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def cut_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]): full windows and a rest per text."""
    last = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            rows, out = [], []
            done = 0

            def close(i: int, ids: np.ndarray) -> None:
                ids = np.concatenate([ids, last])
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    rows.append((i, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), len(ids)))
                    if keep_ids:
                        out.append(part.tolist())

            nothing = np.zeros(0, np.uint32)
            for i, ids in encode_batch(texts, tokenizer_path):
                for empty in range(done, i):
                    close(empty, nothing)
                close(i, ids)
                done = i + 1
            for empty in range(done, len(texts)):
                close(empty, nothing)
            table = np.array(rows, np.int64).reshape(-1, 5)
            columns = [keys.take(pa.array(table[:, 0])), *(pa.array(table[:, c]) for c in range(1, 5))]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string"))
    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = narrow.mapInArrow(tidy(run), schema + ", ids array<int>" * keep_ids)
    return pieces.withColumnRenamed("id", id_column)


# ---- the plan ---------------------------------------------------------------------------


def combinations(bins: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Descending length combinations that fill a window of `bins` steps: up to `depth` parts,
    and one length repeated as often as it fits with one filler."""
    found: set[tuple[int, ...]] = set()

    def extend(head: tuple[int, ...], room: int, parts: int) -> None:
        if room == 0:
            found.add(head)
        elif parts:
            top = min(room, head[-1] if head else bins)
            for b in range(-(-room // parts), top + 1):
                extend((*head, b), room - b, parts - 1)

    extend((), bins, depth)
    for b in range(1, bins // depth + 1):
        rest = bins % b
        found.add((b,) * (bins // b) + ((rest,) if rest else ()))
    return sorted(found, reverse=True)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 0) -> np.ndarray:
    """min |a x - b| over x >= 0 by the active-set method: let in the column with the steepest
    gradient, solve on the columns let in, step back to the first that would turn negative."""
    n = a.shape[1]
    x, inside = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds or 3 * n):
        gradient = a.T @ (b - a @ x)
        gradient[inside] = -np.inf
        j = int(np.argmax(gradient))
        if gradient[j] <= tolerance:
            break
        inside[j] = True
        while True:
            cols = np.flatnonzero(inside)
            s = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
            if (s > 0).all():
                break
            low = cols[s <= 0]
            step = np.min(x[low] / np.maximum(x[low] - s[s <= 0], 1e-300))
            x[cols] += step * (s - x[cols])
            out = cols[(x[cols] <= tolerance) & (s <= 0)]
            if not len(out):
                out = low[np.argmin(x[low]) : np.argmin(x[low]) + 1]
            inside[out] = False
            x[~inside] = 0.0
            if not inside.any():
                return x
        x[:] = 0.0
        x[cols] = s
    return x


def plan(histogram: Sequence[int], depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in steps, copies)]; histogram[b - 1] pieces have length b. All are placed."""
    left = np.array(histogram, np.int64)
    bins = len(left)
    columns = [c for c in combinations(bins, depth) if all(left[b - 1] for b in c)]
    use = np.zeros((bins, max(1, len(columns))))
    for j, c in enumerate(columns):
        for b in c:
            use[b - 1, j] += 1
    out: list[tuple[tuple[int, ...], int]] = []

    def place(lengths: tuple[int, ...], copies: int) -> None:
        need = np.bincount(np.array(lengths) - 1, minlength=bins)
        some = need > 0
        copies = min(copies, int((left[some] // need[some]).min()))
        if copies > 0:
            left[:] -= need * copies
            out.append((lengths, copies))

    if columns:
        wanted = np.floor(nnls(use, left.astype(float), rounds=4 * bins) + 1e-6)
        for j in np.argsort(-wanted):
            if wanted[j] >= 1:
                place(columns[j], int(wanted[j]))
    while left.any():
        room, lengths, spare = bins, [], left.copy()
        while room and spare[:room].any():
            b = int(np.flatnonzero(spare[:room])[-1]) + 1
            lengths.append(b)
            spare[b - 1] -= 1
            room -= b
        place(tuple(lengths), int(left.max()))
    return out


# ---- placing ----------------------------------------------------------------------------


def _places(spark: SparkSession, chosen: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """(bin, from, to, first_sequence, slot): which numbers of a length go where. A few
    thousand rows: bounded by the combinations, not by the data."""
    rows, taken, sequence = [], {}, 0
    for lengths, copies in chosen:
        for slot, b in enumerate(lengths):
            at = taken.get(b, 0)
            rows.append((b, at, at + copies, sequence, slot))
            taken[b] = at + copies
        sequence += copies
    return spark.createDataFrame(
        rows, "_bin int, _from long, _to long, _first long, _slot int"
    )


def place(pieces: DataFrame, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """Add `sequence_id` and `offset` to a table of pieces with `length` up to `window`.

    `pieces` is read three times: stage it first. Every further column is kept."""
    spark = pieces.sparkSession
    kept = pieces.columns
    bins = window // step
    sized = pieces.withColumn("_bin", F.ceil(F.col("length") / step).cast("int"))
    counts = {r["_bin"]: r["n"] for r in sized.groupBy("_bin").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    chosen = plan([counts.get(b, 0) for b in range(1, bins + 1)])

    cells = max(CELLS, -(-total // ROWS_PER_CELL))
    # In each bin by a hash of the piece, so neighbours in a text do not follow one another.
    mixed = F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in kept])
    rows = numbered(sized, "_bin", cells, [mixed], "_number", ROWS_PER_CELL)
    # The table of places is bounded by the combinations, so it is sent to every task.
    placed = rows.join(
        F.broadcast(_places(spark, chosen)).withColumnRenamed("_bin", "_b"),
        (F.col("_bin") == F.col("_b"))
        & (F.col("_number") >= F.col("_from"))
        & (F.col("_number") < F.col("_to")),
    )
    before = (
        Window.partitionBy("sequence_id")
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("sequence_id", F.col("_first") + F.col("_number") - F.col("_from"))
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .select(*[F.col(f"`{c}`") for c in kept], "sequence_id", "offset")
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all texts with the sequence and the offset each goes to."""
    pieces = cut_pieces(docs, tokenizer_path, window, end_id, id_column, text_column, keep_ids)
    return place(stage(pieces, "pieces"), window)
