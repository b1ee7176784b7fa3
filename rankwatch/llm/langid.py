"""Language by words first, then by progressively shorter character n-grams.

A word that is known (seen at least `MIN_COUNT` times in the fitting rows) is scored by its log
frequency in each language. An unseen word falls back to the character 4-grams of the word
with its borders; if none of them is known to 3-grams, then 2-grams, then single characters.
A text's language is the one with the highest sum over its words; the score is its share of
the posterior, from evidence tempered by the number of words.

Words are maximal runs of letters, lower-cased in the Latin range. The rows used for fitting
are bounded by `sample_rows` (drawn by hash of the id) and counted on the executors; what
reaches the driver are the counts of words and n-grams of that sample. Predicting is one pass
over whole texts without a shuffle.

Null texts, and texts without a letter, get `und` and score 0. A text whose letters tell
nothing gets the most frequent language. Ties go to the language that sorts first. Extra
columns are ignored. Without a row to learn from every prediction is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwatch.llm import words as W
from rankwatch.llm.common import small_batches
from rankwatch.llm.toxicity import held_out

SAMPLE_ROWS = 4_000
MIN_COUNT = 2
ORDERS = (4, 3, 2, 1)
_BORDER = 1
_WORD, _GRAM = 0, 1
# Evidence of a text counts as that of at most so many independent words.
TEMPER = 30.0


def spelled(block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased data, begins, ends, part) of the runs of letters.

    Bytes of characters beyond the Latin tables count as letters here when they are ones."""
    cls, _ = W.classes(block.data)
    data = W.lowered(block.data)
    mask = cls == W.LETTER
    wide = np.flatnonzero(block.data >= 0xC6)
    if len(wide):
        mask |= _wide_letters(block.data, wide)
    begin, end = W.split_runs(mask, block.starts)
    return data, begin, end, W.doc_of(begin, block.starts)


def _wide_letters(data: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters outside the Latin tables."""
    mask = np.zeros(len(data), bool)
    lead = data[wide]
    size = np.where(lead >= 0xF0, 4, np.where(lead >= 0xE0, 3, 2))
    kinds: dict[bytes, bool] = {}
    for at, n in zip(wide.tolist(), size.tolist(), strict=True):
        raw = data[at : at + n].tobytes()
        if raw not in kinds:
            kinds[raw] = raw.decode("utf-8", "replace").isalpha()
        if kinds[raw]:
            mask[at : at + n] = True
    return mask


def gram_keys(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, order: int
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, word) of the n-grams of one order; a key spells its characters in 16 bits each.

    Single characters are taken without the borders."""
    lengths = end - begin
    head = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(head, lengths)
    at = np.repeat(begin, lengths) + place
    raw = data[at].astype(np.uint64)
    owner = np.repeat(np.arange(len(begin)), lengths)
    # A Latin character is one sign; bytes of others stand for themselves.
    two = np.flatnonzero((raw >= 0xC2) & (raw <= 0xC5))
    sign = np.where(raw < 0x80, raw, raw + np.uint64(0x200))
    keep = np.ones(len(raw), bool)
    sign[two] = ((raw[two] & np.uint64(0x1F)) << np.uint64(6)) | (raw[two + 1] & np.uint64(0x3F))
    keep[two + 1] = False
    sign, owner = sign[keep], owner[keep]
    if order == 1:
        return sign, owner
    count = np.bincount(owner, minlength=len(begin))
    # Borders around every word.
    total = count + 2
    head = np.cumsum(total) - total
    padded = np.full(total.sum(), _BORDER, np.uint64)
    inner = np.arange(len(sign)) - np.repeat(np.cumsum(count) - count, count)
    padded[np.repeat(head, count) + 1 + inner] = sign
    word = np.repeat(np.arange(len(begin)), total)
    n = len(padded) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.zeros(n, np.uint64)
    for i in range(order):
        keys = (keys << np.uint64(16)) | padded[i : i + n]
    inside = word[:n] == word[order - 1 :]
    return keys[inside], word[:n][inside]


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    word_keys: np.ndarray
    word_logs: np.ndarray
    gram_keys: np.ndarray
    gram_logs: np.ndarray
    memo: W.Memo | None = field(default=None, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "memo"}

    def __setstate__(self, state):
        self.__dict__.update(state, memo=None)

    def word_scores(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Log scores per language, centred, of distinct words."""
        out = np.zeros((len(keys), len(self.languages)))
        at, known = _find(self.word_keys, keys)
        out[known] = self.word_logs[at[known]]
        open_ = np.flatnonzero(~known)
        for order in ORDERS:
            if not len(open_):
                break
            grams, word = gram_keys(data, begin[open_], end[open_], order)
            at, hit = _find(self.gram_keys, grams)
            word, at = word[hit], at[hit]
            hits = np.bincount(word, minlength=len(open_))
            for j in range(out.shape[1]):
                total = np.bincount(word, self.gram_logs[at, j], minlength=len(open_))
                out[open_, j] = total / np.maximum(hits, 1)
            open_ = open_[hits == 0]
        return out - out.mean(axis=1, keepdims=True)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        if self.memo is None:
            self.memo = W.Memo(width=max(1, len(self.languages)), dtype=np.float32, most=1 << 19)
        total = np.zeros((len(texts), max(1, len(self.languages))))
        counts = np.zeros(len(texts))
        for block in W.blocks(texts):
            data, begin, end, part = spelled(block)
            if not len(begin):
                continue
            own, head = np.unique(part, return_index=True)
            docs = block.docs[own]
            counts[docs] += np.diff(np.append(head, len(part)))
            if not self.languages:
                continue
            keys, at, back = np.unique(
                W.span_hashes(data, begin, end), return_index=True, return_inverse=True
            )
            scores = self.memo.get(
                keys,
                lambda f, k=keys, a=at, d=data, b=begin, e=end: self.word_scores(d, b[a[f]], e[a[f]], k[f]),
            )
            for j in range(len(self.languages)):
                total[docs, j] += np.add.reduceat(scores[:, j].astype(np.float64)[back], head)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        tempered = total * (np.minimum(counts, TEMPER) / np.maximum(counts, 1))[:, None]
        z = tempered + np.log(self.prior)
        z -= z.max(axis=1, keepdims=True)
        share = np.exp(z)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        names = [self.languages[b] if n else "und" for b, n in zip(best.tolist(), counts.tolist(), strict=True)]
        return names, np.where(counts > 0, share[np.arange(len(best)), best], 0.0)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys if len(table) else np.zeros(len(keys), bool))


def _logs(rows, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, log frequency per language) with add-half smoothing."""
    keys = np.unique(np.array([r["key"] for r in rows], np.int64).view(np.uint64))
    table = np.zeros((len(keys), len(languages)))
    place = {name: j for j, name in enumerate(languages)}
    at = np.searchsorted(keys, np.array([r["key"] for r in rows], np.int64).view(np.uint64))
    np.add.at(table, (at, [place[r["lang"]] for r in rows]), [r["n"] for r in rows])
    totals = table.sum(axis=0) + 0.5 * max(1, len(keys))
    return keys, np.log((table + 0.5) / totals)


def _counts(sample: DataFrame) -> DataFrame:
    """(lang, kind, key, n) of words and n-grams, added up per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                texts = batch.column(0).filter(pa.array(langs == lang))
                for block in W.blocks(texts):
                    data, begin, end, _ = spelled(block)
                    if not len(begin):
                        continue
                    hashes = W.span_hashes(data, begin, end)
                    keys, at, n = np.unique(hashes, return_index=True, return_counts=True)
                    parts = [(np.full(len(keys), _WORD), keys, n)]
                    for order in ORDERS:
                        grams, word = gram_keys(data, begin[at], end[at], order)
                        some, back = np.unique(grams, return_inverse=True)
                        times = np.bincount(back, n[word], minlength=len(some)).astype(np.int64)
                        parts.append((np.full(len(some), _GRAM), some, times))
                    kind, key, times = (np.concatenate(c) for c in zip(*parts, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(key), pa.string()),
                            pa.array(kind.astype(np.int32)),
                            pa.array(key.view(np.int64)),
                            pa.array(times.astype(np.int64)),
                        ],
                        ["lang", "kind", "key", "n"],
                    )

    found = sample.mapInArrow(run, "lang string, kind int, key long, n long")
    return found.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on rows with a language that are not held out."""
    small_batches(docs.sparkSession)
    rid = F.col("doc_id")
    rows = docs.where(~held_out(rid) & F.col("lang").isNotNull()).select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        empty = np.zeros(0, np.uint64)
        return Model([], np.ones(1), empty, np.zeros((0, 1)), empty, np.zeros((0, 1)))
    # As many rows of every language as there are, up to its part of the bound.
    each = sample_rows / len(languages)
    drawn = F.lit(False)
    for name, n in sizes.items():
        share = int(min(1.0, each / n) * (1 << 20))
        drawn = drawn | ((F.col("lang") == name) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share))
    counted = _counts(rows.where(drawn & F.col("text").isNotNull()).select("text", "lang"))
    found = counted.where(f"n >= {MIN_COUNT} OR kind = {_GRAM}").toPandas().to_dict("records")
    words, grams = ([r for r in found if r["kind"] == k] for k in (_WORD, _GRAM))
    total = sum(sizes.values())
    prior = np.array([sizes[name] / total for name in languages])
    return Model(languages, prior, *_logs(words, languages), *_logs(grams, languages))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = sent.value.predict(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
