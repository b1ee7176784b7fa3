"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

Units are the words of a text, lower-cased, with inner signs kept as gaps, digits and signs
that stand for letters read as those letters, and runs of three or more single letters joined
("i d i o t"). Two units are compared by the gap-weighted subsequence kernel of order 3,
normalised: every common subsequence of three letters counts, the less the wider it is
spread, so inserted characters and gaps cost a little and endings differ freely.

The machine is fitted on single units, not on sentences: labels are of texts, and how many
toxic and clean texts hold a unit makes it a positive example (a witness: its rate in toxic
texts is far above that in clean ones, beyond chance), a negative one, or none. Insults of
several words that are harmless each are therefore not learned. Landmarks are the most frequent witnesses and some negatives; Nyström features are
k(u, landmarks) K^(-1/2); a linear machine with squared hinge loss is fitted on them. Since
the kernel is an inner product over letter triples, the machine folds into one weight per
triple, which is what scoring a unit looks up: the same number, without a product per landmark.
A text's score is a logistic function of its highest unit margin, its count of positive units
and its length, fitted on the margins that a machine of the other folds gives (a machine knows
the accidents of its own texts).

The labelled rows used for fitting are bounded by `sample_rows` (drawn by hash of the id), the
units by `witnesses`, `negatives` and `mixed`.
Scoring covers every unit of every text; it is one pass without a shuffle.

Null and empty texts have no unit: they get the score of a text without evidence. Ties
and repeated rows are scored alike. Extra columns are ignored. Without labelled rows of both
classes every score is the smoothed share of toxic labels, 0 without labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwatch.llm import words as W
from rankwatch.llm.common import small_batches, stage, tidy

SAMPLE_ROWS = 8_000
WITNESSES = 1_500
NEGATIVES = 4_000
MIXED = 1_000
LANDMARKS = 160
FOLDS = 3
DECAY = 0.6
SIDE = 32
LONGEST, STRIDE = 16, 8
# Several tables of so many units by 560 triples stand in memory together.
UNITS_AT_ONCE = 512
# Units as dense rows of 256 KB each, on the driver beside the landmarks' own.
DENSE_AT_ONCE = 32
THRESHOLD = 0.7

# Signs by character: letters 1 to 26, other letters in five classes, 0 is a gap.
_SIGN = np.zeros(W.PLAIN, np.uint8)
for _c in range(W.PLAIN):
    if W.CLASSES[_c] == W.LETTER:
        _low = ord(chr(_c).lower()) if len(chr(_c).lower()) == 1 else _c
        _SIGN[_c] = _low - 96 if 97 <= _low <= 122 else 27 + _low % 5
for _a, _b in zip("013457@$", "oieastas", strict=True):
    _SIGN[ord(_a)] = ord(_b) - 96
_LETTERLIKE = _SIGN > 0


def held_out(id_column: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 1 when divided by 3 (null id: as empty)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def units(block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(signs, begins, ends, part of the block) of the units of a block."""
    data = block.data
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead]
    cp = first.astype(np.int64)
    two = np.flatnonzero((first >= 0xC2) & (first <= 0xC5))
    cp[two] = ((cp[two] & 0x1F) << 6) | (data[lead[two] + 1] & 0x3F)
    wide = cp >= W.PLAIN
    cp[wide] = 0
    signs = _SIGN[cp]
    signs[wide] = 27 + first[wide] % 5
    real = (W.CLASSES[cp] == W.LETTER) | wide
    starts = np.searchsorted(lead, block.starts)
    begin, end = W.split_runs(~W._WHITE[first], starts)
    # Trim to the first and the last sign; what has no letter (a number, say) is no unit.
    letters = np.flatnonzero(real)
    some = np.searchsorted(letters, end) > np.searchsorted(letters, begin)
    begin, end = begin[some], end[some]
    letters = np.flatnonzero(signs)
    lo, hi = np.searchsorted(letters, begin), np.searchsorted(letters, end)
    some = hi > lo
    begin, end = letters[lo[some]], letters[hi[some] - 1] + 1
    part = np.searchsorted(starts, begin, "right") - 1
    if len(begin):
        # Runs of single letters become one unit.
        single = end - begin == 1
        chain = np.ones(len(begin), bool)
        chain[1:] = ~(single[1:] & single[:-1] & (part[1:] == part[:-1]))
        head = np.flatnonzero(chain)
        size = np.diff(np.append(head, len(begin)))
        long = (size >= 3) & single[head]
        take = np.repeat(~long, size)
        begin = np.concatenate([begin[take], begin[head[long]]])
        end = np.concatenate([end[take], end[(head + size - 1)[long]]])
        # Long units are looked at through windows that overlap by half.
        count = np.maximum(1, -(-(end - begin - LONGEST) // STRIDE) + 1)
        shift = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begin, end = np.repeat(begin, count) + shift * STRIDE, np.repeat(end, count)
        end = np.minimum(end, begin + LONGEST)
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], end[order]
        part = np.searchsorted(starts, begin, "right") - 1
    return signs, begin, end, part


def _hashes(signs: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Like words.span_hashes, for spans that may overlap."""
    lengths = end - begin
    if not len(lengths):
        return np.zeros(0, np.uint64)
    head = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(head, lengths)
    at = np.repeat(begin, lengths) + place
    terms = W._BYTE_MIX[signs[at]] * W.powers(LONGEST)[place]
    return W.mix(np.add.reduceat(terms, head) + lengths.astype(np.uint64) * W._BASE)


def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples i < j < k below n and the decay of their spread."""
    i, j, k = (x.ravel() for x in np.meshgrid(*[np.arange(n)] * 3, indexing="ij"))
    ok = (i < j) & (j < k)
    t = np.stack([i[ok], j[ok], k[ok]])
    return t, DECAY ** (t[2] - t[0] + 1.0)


_TRIPLES = {n: _triples(n) for n in range(1, LONGEST + 1)}


def triple_features(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(triple codes, weights) of units of one length; gaps in a triple weigh nothing."""
    (i, j, k), decay = _TRIPLES[rows.shape[1]]
    a, b, c = rows[:, i].astype(np.int64), rows[:, j], rows[:, k]
    weight = np.where((a > 0) & (b > 0) & (c > 0), decay, 0.0)
    return (a * SIDE + b) * SIDE + c, weight


def self_kernels(rows: np.ndarray) -> np.ndarray:
    """k(u, u) for units of one length, by the usual recursion over prefixes."""
    n = rows.shape[1]
    total = np.zeros(len(rows))
    same = [[(rows[:, a] == rows[:, b]) & (rows[:, a] > 0) for b in range(n)] for a in range(n)]
    before = np.ones((n + 1, n + 1, len(rows)))
    for order in range(1, 4):
        if order == 3:
            for a in range(n):
                for b in range(n):
                    total += same[a][b] * before[a, b] * DECAY**2
            break
        after = np.zeros((n + 1, n + 1, len(rows)))
        for a in range(1, n + 1):
            inner = np.zeros(len(rows))
            for b in range(1, n + 1):
                inner = DECAY * inner + same[a - 1][b - 1] * before[a - 1, b - 1] * DECAY**2
                after[a, b] = DECAY * after[a - 1, b] + inner
        before = after
    return total


def _dense(rows: list[np.ndarray]) -> np.ndarray:
    """Normalised triple features of a few units, one row each. Rows are normalised where they
    stand: the driver holds them once."""
    out = np.zeros((len(rows), SIDE**3))
    for r, unit in enumerate(rows):
        codes, weight = triple_features(unit[None, :])
        np.add.at(out[r], codes[0], weight[0])
        out[r] /= np.maximum(np.sqrt((out[r] ** 2).sum()), 1e-12)
    return out


@dataclass
class Model:
    triples: np.ndarray  # weight per letter triple
    bias: float
    line: np.ndarray  # constant, highest margin, log count, share, log length
    floor: float | None = None  # a constant score when nothing could be learned
    memo: W.Memo = field(default_factory=lambda: W.Memo(dtype=np.float32), repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "memo"}

    def __setstate__(self, state):
        self.__dict__.update(state, memo=W.Memo(dtype=np.float32))

    def margins(self, signs: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.full(len(begin), self.bias)
        lengths = end - begin
        for n in np.unique(lengths).tolist():
            if n < 3:
                continue
            for own in np.array_split(np.flatnonzero(lengths == n), 1 + (lengths == n).sum() // UNITS_AT_ONCE):
                rows = signs[begin[own][:, None] + np.arange(n)]
                codes, weight = triple_features(rows)
                norm = np.sqrt(np.maximum(self_kernels(rows), 1e-24))
                out[own] += (self.triples[codes] * weight).sum(axis=1) / np.maximum(norm, 1e-12)
        return out

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Per text: highest margin (-1 without units), positive units, units."""
        out = np.zeros((len(texts), 3))
        out[:, 0] = -1.0
        for block in W.blocks(texts):
            signs, begin, end, part = units(block)
            if not len(begin):
                continue
            keys, at, back = np.unique(
                _hashes(signs, begin, end), return_index=True, return_inverse=True
            )
            margin = self.memo.get(
                keys, lambda f, s=signs, b=begin[at], e=end[at]: self.margins(s, b[f], e[f])
            )[back]
            own, head = np.unique(part, return_index=True)
            docs = block.docs[own]
            out[docs, 0] = np.maximum(out[docs, 0], np.maximum.reduceat(margin, head))
            out[docs, 1] += np.add.reduceat((margin > 0).astype(float), head)
            out[docs, 2] += np.diff(np.append(head, len(margin)))
        return out

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if self.floor is not None:
            return np.full(len(evidence), self.floor)
        z = _line_features(evidence) @ self.line
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _line_features(evidence: np.ndarray) -> np.ndarray:
    top, count, size = evidence.T
    return np.stack(
        [
            np.ones(len(top)),
            np.clip(top, -1.5, 1.5),
            np.log1p(count),
            np.sqrt(count / np.maximum(size, 1)),
            np.log1p(size) / 5,
        ],
        axis=1,
    )


def squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (last one: bias) of a linear machine, by Newton steps on the rows inside the
    margin."""
    x = np.hstack([z, np.ones((len(z), 1))])
    keep = np.eye(x.shape[1]) * ridge
    keep[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        inside = y * (x @ w) < 1
        xs, ws = x[inside], weight[inside]
        new = np.linalg.solve(xs.T @ (xs * ws[:, None]) + keep, xs.T @ (ws * y[inside]))
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[0] = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.diag(pull + 1e-9)
        step = np.linalg.solve(h, x.T @ (y - p) - pull * w)
        w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _unit_counts(sample: DataFrame) -> DataFrame:
    """(fold, unit, p, n): how many toxic and clean texts of a fold a unit is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, toxic, folds = batch.columns
            y = np.asarray(toxic.to_numpy(zero_copy_only=False), bool)
            fold = folds.to_numpy()
            for block in W.blocks(texts):
                signs, begin, end, part = units(block)
                hashes = _hashes(signs, begin, end)
                # Once per text, then summed over the block.
                order = np.lexsort((part, hashes))
                h, p = hashes[order], part[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
                order, h, p = order[new], h[new], p[new]
                if not len(h):
                    continue
                # Units of a block by fold.
                own = fold[block.docs[p]]
                by = np.lexsort((own, h))
                order, h, p, own = order[by], h[by], p[by], own[by]
                head = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (own[1:] != own[:-1])])
                is_toxic = y[block.docs[p]]
                pos = np.add.reduceat(is_toxic.astype(np.int64), head)
                all_ = np.diff(np.append(head, len(h)))
                spans = order[head]
                found = [signs[b:e].tobytes() for b, e in zip(begin[spans], end[spans], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[head]), pa.array(found, pa.binary()), pa.array(pos), pa.array(all_ - pos)],
                    ["fold", "unit", "p", "n"],
                )

    counts = sample.select("text", (F.col("toxic") > 0).alias("toxic"), "fold").mapInArrow(
        tidy(run), "fold int, unit binary, p long, n long"
    )
    return counts.groupBy("fold", "unit").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def draw_sample(docs: DataFrame, labels: DataFrame, rows: int, id_column: str = "doc_id") -> DataFrame:
    """(text, toxic, fold) of at most about `rows` labelled rows that are not held out, each
    distinct text once."""
    rid = F.col(id_column)
    known = labels.select(id_column, "toxic").where(F.col("toxic").isNotNull() & rid.isNotNull())
    known = known.where(~held_out(rid)).groupBy(id_column).agg(F.max("toxic").alias("toxic"))
    share = rows / max(1, known.count())
    drawn = F.pmod(F.xxhash64(rid), F.lit(1 << 20)) < int(share * (1 << 20))
    texts = docs.select(id_column, F.col("text").cast("string").alias("text"))
    texts = texts.where(~held_out(rid) & F.col("text").isNotNull() & drawn)
    # The drawn labels are at most some thousand rows.
    joined = texts.join(F.broadcast(known.where(drawn)), id_column)
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    return joined.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("fold", fold)


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
    witnesses: int = WITNESSES, negatives: int = NEGATIVES, mixed: int = MIXED,
) -> Model:
    """Fit on labelled rows that are not held out."""
    bounds = witnesses, negatives, mixed
    small_batches(docs.sparkSession)
    sample = stage(draw_sample(docs, labels, sample_rows), "toxic-sample")
    # (toxic, clean) texts per fold.
    sizes = {
        r["fold"]: np.array([r["p"], r["n"]])
        for r in sample.groupBy("fold")
        .agg(F.count_if(F.col("toxic") > 0).alias("p"), F.count_if(F.col("toxic") <= 0).alias("n"))
        .collect()
    }
    pos, neg = (int(x) for x in sum(sizes.values(), np.zeros(2, int)))
    nothing = Model(np.zeros(SIDE**3), -1.0, np.zeros(5))
    if not pos or not neg:
        nothing.floor = (pos / (pos + neg)) if pos + neg else 0.0
        return nothing
    counted = stage(_unit_counts(sample), "toxic-units")
    model = _fit_machine(counted, pos, neg, *bounds)
    if model is None:
        nothing.floor = pos / (pos + neg)
        return nothing
    parts = []
    for fold, own in sizes.items():
        p, n = pos - int(own[0]), neg - int(own[1])
        other = _fit_machine(counted.where(F.col("fold") != fold), p, n, *bounds) if p and n else None
        parts.append(_collect_evidence(sample.where(F.col("fold") == fold), other or model))
    evidence = np.vstack(parts)
    model.line = logistic(_line_features(evidence[:, 1:]), evidence[:, 0])
    return model


def _fit_machine(
    counted: DataFrame, pos: int, neg: int, most_good: int, most_clean: int, most_mixed: int
) -> Model | None:
    """The machine for counts out of `pos` toxic and `neg` clean texts, if they tell anything."""
    total = counted.groupBy("unit").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    total = total.withColumn("m", F.col("p") + F.col("n"))
    # How far the toxic share of a unit's texts is from that of all texts, as a log likelihood
    # ratio; above the logarithm of the number of units, chance makes less than one witness.
    share, units_seen = pos / (pos + neg), total.count()
    apart = F.col("p") * F.log(F.greatest(F.col("p"), F.lit(1e-9)) / F.col("m") / share) + F.col("n") * F.log(
        F.greatest(F.col("n"), F.lit(1e-9)) / F.col("m") / (1 - share)
    )
    lift = ((F.col("p") + 0.5) / (pos + 1)) / ((F.col("n") + 0.5) / (neg + 1))
    # Rates, so the balance of the classes does not matter. Bounded by parameters: the strongest
    # witnesses (four times as frequent in toxic texts), a hash-drawn part of the clean units, and
    # the most frequent units that lean to toxic texts without being witnesses.
    clear = F.col("p") * neg >= 4 * F.col("n") * pos
    total = total.where(F.length("unit") >= 3)
    witnesses = (
        total.where(clear & (lift >= 3) & (apart >= float(np.log(max(units_seen, 1)))))
        .orderBy(F.col("p").desc(), F.col("n"), "unit")
        .limit(most_good)
        .collect()
    )
    clean = total.where(20 * F.col("p") * neg <= F.col("n") * pos).orderBy(F.xxhash64("unit")).limit(most_clean).collect()
    mixed = (
        total.where(~clear & (lift >= 2) & (F.col("m") >= 5)).orderBy(F.col("m").desc(), "unit").limit(most_mixed).collect()
    )
    good, bad = ([np.frombuffer(bytes(r["unit"]), np.uint8) for r in rows] for rows in (witnesses, clean + mixed))
    if not good or not bad:
        return None
    return _machine(good, np.array([r["p"] for r in witnesses], float), bad)


def _machine(good: list[np.ndarray], counts: np.ndarray, bad: list[np.ndarray]) -> Model:
    half = LANDMARKS * 3 // 4
    # Landmarks spread over the witnesses by their counts, then negatives.
    chosen = good[:half] + bad[: LANDMARKS - min(half, len(good))]
    marks = _dense(chosen)
    gram = marks @ marks.T
    value, vector = np.linalg.eigh(gram)
    keep = value > 1e-6 * value[-1]
    root = vector[:, keep] / np.sqrt(value[keep])
    everything = good + bad
    some = (everything[i : i + DENSE_AT_ONCE] for i in range(0, len(everything), DENSE_AT_ONCE))
    z = np.vstack([_dense(units) @ marks.T @ root for units in some])
    # Made again at the end rather than held beside the fit.
    del marks
    y = np.concatenate([np.ones(len(good)), -np.ones(len(bad))])
    weight = np.concatenate([counts / counts.sum(), np.full(len(bad), 4.0 / len(bad))])
    w = squared_hinge(z, y, weight, ridge=1e-4)
    return Model(_dense(chosen).T @ (root @ w[:-1]), float(w[-1]), np.zeros(5))


def _collect_evidence(sample: DataFrame, model: Model) -> np.ndarray:
    """(label, evidence) of sampled rows: a few numbers each, bounded by the sample."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, toxic = batch.columns
            columns = [toxic, *(pa.array(c) for c in sent.value.evidence(texts).T)]
            yield pa.RecordBatch.from_arrays(columns, ["y", "top", "count", "size"])

    rows = sample.select("text", (F.col("toxic") > 0).cast("double").alias("y"))
    found = rows.mapInArrow(tidy(run), "y double, top double, count double, size double")
    return np.array([tuple(r) for r in found.collect()]).reshape(-1, 4)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = sent.value.scores(sent.value.evidence(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(tidy(run), f"doc_id {kind}, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = sent.value.scores(sent.value.evidence(batch.column(at)))
            yield batch.filter(pa.array(value < threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
