"""Phrase collocations by multikey three-way quicksort of suffix pointers.

Texts (A-Z lower-cased) are split into pieces at `. , ; : ! ?` and line ends, and pieces into
words at blanks and tabs. Everything is counted per language. A candidate is a phrase of 2 to 3
words that occurs `LEAST` times or more; its score is how much more often it occurs than
its parts say, at the cut where that is least: floor(10^6 a^2 / (l r)).

1. Words are counted. Those so frequent that a task could not hold all that begins with them are
   `hot`; their list has at most `MOST_HOT` entries, or else all words count as hot.
2. A task keeps the words of about `FLUSH` positions as numbers of a dictionary of its own. Every
   position is a suffix pointer, and the pointers are sorted to the greatest depth, language
   first, then three words: a pivot parts them into smaller, equal and greater, equal ones go
   on to the next word. The sizes of equal partitions are the weights of distinct suffixes.
3. Weighted suffixes are routed by their leading word; where that is hot, by two words; where both
   are hot (no pair is more frequent than either of its words), by all three. They travel as one
   packed row per task and route, and each route is sorted the same way: sizes of equal
   partitions are the counts of phrases, and a partition under `LEAST` is abandoned. Only pairs of
   hot words have parts of their counts in several routes; those are summed.
4. Candidates look up the counts of their parts, are dropped where a longer candidate explains
   them, and each language's best are ranked in two steps, parts of a language first.

Counts stay below 10^14 per phrase, so that products are exact decimals of at most 37 digits.

Null texts are empty; a null language is `und`, as is one of that name. Repeated rows count each
time. An empty table gives an empty result; extra columns are ignored, whatever their names.
A text longer than a block is worked through piece by piece, a piece is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwatch.llm import words as W
from rankwatch.llm.common import byte_batches, lookup, rows_in_parts, stage

LEAST = 10
DEPTH = 3
SHARE = 50  # a longer candidate with this percentage of the count explains the shorter one
TOP = 2000
FLUSH = 1_000_000
ROUTE_ROWS = 500_000
MOST_HOT = 200_000
# Partitions up to this size are finished by a plain sort of the words that are left.
SMALL = 1 << 15
# Parts of a language in the first step of ranking.
PARTS = 64

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", 10, 11, 12, 13]] = True
_BETWEEN = _PIECE_END.copy()
_BETWEEN[[32, 9]] = True


def multikey(keys: list[np.ndarray], weight: np.ndarray, least: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every depth the equal partitions of the pointers 0..n-1: one pointer and the weight
    of each. Partitions under `least` of their depth are neither listed nor sorted further."""
    order = np.arange(len(weight))
    found: list[tuple[list, list]] = [([], []) for _ in keys]
    todo = [(0, len(order), 0)] if len(order) else []
    while todo:
        low, high, depth = todo.pop()
        own = order[low:high]
        if high - low <= SMALL:
            _finish(own, keys, weight, least, depth, found)
            continue
        key = keys[depth][own]
        pivot = np.median(key[:: max(1, len(key) // 9)][:9]).astype(key.dtype)
        less, more = key < pivot, key > pivot
        equal = ~(less | more)
        a, b = low + np.count_nonzero(less), high - np.count_nonzero(more)
        order[low:high] = np.concatenate([own[less], own[equal], own[more]])
        todo += [(x, y, depth) for x, y in ((low, a), (b, high)) if x < y]
        size = int(weight[order[a:b]].sum())
        if a < b and size >= least[depth]:
            found[depth][0].append(order[a : a + 1].copy())
            found[depth][1].append(np.array([size]))
            if depth + 1 < len(keys):
                todo.append((a, b, depth + 1))
    none = np.zeros(0, np.int64)
    return [(np.concatenate([none, *p]), np.concatenate([none, *s])) for p, s in found]


def _finish(own, keys, weight, least, depth, found) -> None:
    own = own[np.lexsort([keys[d][own] for d in range(len(keys) - 1, depth - 1, -1)])]
    head = np.zeros(len(own), bool)
    head[:1] = True
    for d in range(depth, len(keys)):
        key = keys[d][own]
        head[1:] |= key[1:] != key[:-1]
        at = np.flatnonzero(head)
        if not len(at):
            return
        size = np.add.reduceat(weight[own], at)
        alive = size >= least[d]
        found[d][0].append(own[at[alive]])
        found[d][1].append(size[alive])
        if not alive.all():
            keep = np.repeat(alive, np.diff(np.append(at, len(own))))
            own, head = own[keep], head[keep]


def _parts(text: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A text cut at ends of pieces into parts of about `limit` bytes."""
    ends, at = np.flatnonzero(_PIECE_END[text]), 0
    while at < len(text):
        k = np.searchsorted(ends, at + limit)
        stop = int(ends[k]) + 1 if k < len(ends) else len(text)
        yield text[at:stop]
        at = stop


def _blocks(texts: pa.Array, limit: int = W.BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, where texts begin, position of each text) of consecutive texts."""
    offsets, raw = W.buffers(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        if offsets[i + 1] - offsets[i] > 2 * limit:
            for part in _parts(raw[offsets[i] : offsets[i + 1]], limit):
                yield part, np.zeros(1, np.int64), np.array([i])
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        while j > i + 1 and offsets[j] - offsets[j - 1] > 2 * limit:
            j -= 1
        yield raw[offsets[i] : offsets[j]], offsets[i:j] - offsets[i], np.arange(i, j)
        i = j


def words(data: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, whether each begins a piece, the text each is of)"""
    data = W.LOWER_ASCII[data]
    live = starts < len(data)
    begin, end = W.split_runs(~_BETWEEN[data], starts[live]) if len(data) else (starts[:0], starts[:0])
    ended = np.concatenate([[0], np.cumsum(_PIECE_END[data])])
    doc = docs[live][W.doc_of(begin, starts[live])] if len(begin) else docs[:0]
    piece, head = ended[begin], np.ones(len(begin), bool)
    head[1:] = (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
    inside = data[~_BETWEEN[data]]
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    text = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(inside)])
    return text, head, doc


class _Collector:
    """Words of a task until there are enough to work on."""

    def __init__(self):
        self.text, self.head, self.lang = [], [], []
        self.langs: dict[str, int] = {}
        self.size = 0

    def add(self, text: pa.Array, head: np.ndarray, lang: np.ndarray) -> None:
        self.text.append(text)
        self.head.append(head)
        self.lang.append(lang)
        self.size += len(text)

    def coded(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(vocabulary, word numbers, which begin a piece, language numbers)"""
        coded = pa.concat_arrays(self.text).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        return coded.dictionary, code, np.concatenate(self.head), np.concatenate(self.lang)


def _collected(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[_Collector]:
    held = _Collector()
    for batch in batches:
        own = batch.column("lang").to_pylist()
        for data, starts, docs in _blocks(batch.column("text")):
            text, head, doc = words(data, starts, docs)
            if not len(text):
                continue
            number = {i: held.langs.setdefault(own[i], len(held.langs)) for i in np.unique(doc).tolist()}
            lang = np.zeros(len(own), np.int64)
            lang[list(number)] = list(number.values())
            held.add(text, head, lang[doc])
            if held.size >= flush:
                yield held
                held = _Collector()
    if held.size:
        yield held


def _texts(docs: DataFrame) -> DataFrame:
    byte_batches(docs.sparkSession)
    narrow = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    return narrow.where("text IS NOT NULL")


def word_counts(docs: DataFrame, flush: int = FLUSH) -> DataFrame:
    """(lang, w1, f)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _collected(batches, flush):
            vocabulary, code, _, lang = held.coded()
            pair, count = np.unique(lang * len(vocabulary) + code, return_counts=True)
            yield from pa.table({
                "lang": pa.array(list(held.langs), pa.string()).take(pa.array(pair // len(vocabulary))),
                "w1": vocabulary.cast(pa.string()).take(pa.array(pair % len(vocabulary))),
                "c": pa.array(count, pa.int64()),
            }).to_batches(1 << 16)

    counted = _texts(docs).mapInArrow(run, "lang string, w1 string, c long")
    return counted.groupBy("lang", "w1").agg(F.sum("c").alias("f"))


def _hashes(text: pa.Array) -> np.ndarray:
    offsets, raw = W.buffers(text)
    return W.span_hashes(raw, offsets[:-1], offsets[1:])


def _lang_hashes(langs: list[str]) -> np.ndarray:
    """Of names that may be empty."""
    return _hashes(pa.array(["=" + x for x in langs], pa.large_string()))


def _among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    at = np.searchsorted(sorted_, values)
    return sorted_[np.minimum(at, len(sorted_) - 1)] == values


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i4").tobytes(), "zstd", asbytes=True)


COLD, WARM, SPREAD = 0, 1, 2  # routed by one, two or all words
_PACK = (
    "route long, lang string, kind int, n long, vocabulary long, size long, ends binary, words binary,"
    " w1 binary, w2 binary, w3 binary, c binary"
)


def _routed(hot: np.ndarray | None, routes: int, flush: int):
    """Packed weighted suffixes per route, language and kind. `hot` are sorted hashes of language
    and word; None: all words are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _collected(batches, flush):
            vocabulary, code, head, lang = held.coded()
            keys, goes_on = [lang, code], np.ones(len(code), bool)
            for d in range(1, DEPTH):
                # Does the piece go on for d more words?
                goes_on[: max(0, len(code) - d)] &= ~head[d:]
                goes_on[max(0, len(code) - d) :] = False
                keys.append(np.where(goes_on, np.concatenate([code[d:], np.zeros(min(d, len(code)), np.int64)]), -1))
            at, size = multikey(keys, np.ones(len(code), np.int64), [0] * len(keys))[-1]
            lang, w = keys[0][at], [k[at] for k in keys[1:]]
            del keys, code, head, goes_on

            names = list(held.langs)
            of_lang, of_word = _lang_hashes(names)[lang], np.append(_hashes(vocabulary), np.uint64(1))
            one = W.mix(of_lang + of_word[w[0]])
            two = W.mix(one + of_word[w[1]])
            if hot is None:
                kind = np.full(len(at), SPREAD)
            else:
                second = W.mix(of_lang + of_word[w[1]])
                kind = _among(one, hot) * (1 + (_among(second, hot) & (w[1] >= 0)))
            route = np.where(kind == COLD, one, np.where(kind == WARM, two, W.mix(two + of_word[w[2]])))
            route = (route % np.uint64(routes)).astype(np.int64)
            part = (route * len(names) + lang) * 3 + kind
            order = np.argsort(part, kind="stable")
            part = part[order]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            rows: dict[str, list] = {c.split()[0]: [] for c in _PACK.split(", ")}
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
                own, (here, at_kind) = order[a:b], divmod(int(part[a]), 3)
                used, local = np.unique(np.stack([x[own] for x in w]), return_inverse=True)
                missing = int(used[0] < 0)
                ends, text = W.buffers(vocabulary.take(pa.array(used[missing:])))
                rows["route"].append(here // len(names))
                rows["lang"].append(names[here % len(names)])
                rows["kind"].append(at_kind)
                rows["n"].append(b - a)
                rows["size"].append(int(ends[-1] - ends[0]))
                rows["vocabulary"].append(len(ends) - 1)
                rows["ends"].append(_packed(np.diff(ends)))
                rows["words"].append(pa.compress(text[ends[0] : ends[-1]].tobytes(), "zstd", asbytes=True))
                for name, x in zip(("w1", "w2", "w3"), local.reshape(DEPTH, -1) - missing, strict=True):
                    rows[name].append(_packed(x))
                rows["c"].append(_packed(size[own]))
            yield from pa.table(rows, _ARROW).to_batches(64)

    return run


_ARROW = pa.schema([
    ("route", pa.int64()), ("lang", pa.string()), ("kind", pa.int32()), ("n", pa.int64()), ("vocabulary", pa.int64()),
    ("size", pa.int64()), *[(c, pa.binary()) for c in ("ends", "words", "w1", "w2", "w3", "c")],
])
_PHRASE = "lang string, w1 string, w2 string, w3 string, c long"


def _vocabulary(packed: bytes, size: int, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    data = pa.decompress(packed, size, "zstd")
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), data])


def _phrases(least: int):
    """The counts of phrases of two and three words in one route. Pairs that are spread over
    routes can only be judged with their third word, hot leading words with their second."""
    limits = {COLD: [0, least, least, least], WARM: [0, 0, least, least], SPREAD: [0, 0, 0, least]}

    def unpacked(data: bytes, n: int) -> np.ndarray:
        return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), "<i4").astype(np.int64)

    def run(rows: pa.Table) -> pa.Table:
        held: dict[int, list[dict]] = {}
        for r in rows.to_pylist():
            held.setdefault(r["kind"], []).append(r)
        out = []
        for kind, packs in held.items():
            langs = sorted({r["lang"] for r in packs})
            text = [_vocabulary(r["words"], r["size"], unpacked(r["ends"], r["vocabulary"])) for r in packs]
            coded = pa.concat_arrays(text).dictionary_encode()
            number = np.append(coded.indices.to_numpy().astype(np.int64), -1)
            lang = np.repeat([langs.index(r["lang"]) for r in packs], [r["n"] for r in packs])
            keys, begin = [lang], np.concatenate([[0], np.cumsum([len(t) for t in text])])
            for name in ("w1", "w2", "w3"):
                local = [unpacked(r[name], r["n"]) for r in packs]
                keys.append(np.concatenate([number[np.where(x < 0, -1, x + b)] for x, b in zip(local, begin, strict=False)]))
            weight = np.concatenate([unpacked(r["c"], r["n"]) for r in packs])
            sizes = multikey(keys, weight, limits[kind])
            names, vocabulary = pa.array(langs, pa.string()), coded.dictionary.cast(pa.string())
            for depth in range(2, DEPTH + 1):
                at, size = sizes[depth]
                whole = keys[depth][at] >= 0
                at, size = at[whole], size[whole]
                word = [
                    vocabulary.take(pa.array(k[at])) if d <= depth else pa.nulls(len(at), pa.string())
                    for d, k in enumerate(keys[1:], 1)
                ]
                out.append(pa.table([names.take(pa.array(keys[0][at])), *word, pa.array(size, pa.int64())], ["lang", "w1", "w2", "w3", "c"]))
        return pa.concat_tables(out)

    return run


def phrase_counts(docs: DataFrame, counts: DataFrame, least: int, flush: int, route_rows: int) -> DataFrame:
    """(lang, w1, w2, w3, a) of all phrases of two (w3 null) and three words with a >= `least`;
    `counts` are those of single words."""
    total = counts.agg(F.sum("f").alias("n")).first()["n"] or 0
    routes = rows_in_parts(docs.sparkSession, total, route_rows)
    frequent = counts.where(F.col("f") * 4 > route_rows)
    hot = None
    if frequent.count() <= MOST_HOT:
        rows = frequent.select("lang", "w1").collect()
        of_lang = _lang_hashes([r["lang"] for r in rows])
        hot = np.sort(W.mix(of_lang + _hashes(pa.array([r["w1"] for r in rows], pa.large_string()))))
    packed = _texts(docs).mapInArrow(_routed(hot, routes, flush), _PACK)
    # About one route per task, however many there are.
    packed = packed.repartition(routes, "route")
    counted = stage(packed.groupBy("route").applyInArrow(_phrases(least), _PHRASE), "phrases")
    two = counted.where("w3 IS NULL").groupBy("lang", "w1", "w2").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    three = counted.where("w3 IS NOT NULL")
    both = two.select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "c").unionByName(three)
    return both.withColumnRenamed("c", "a")


def _score(l_: str, r: str) -> Column:
    return F.expr(
        "CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(14,0)) * CAST(a AS DECIMAL(14,0)))"
        f" DIV (CAST({l_} AS DECIMAL(14,0)) * CAST({r} AS DECIMAL(14,0)))"
    )


def _with(rows: DataFrame, counts: DataFrame, words_: list[str], name: str) -> DataFrame:
    """`rows` and the count of the phrase of those words."""
    own = [f"w{i}" for i in range(1, len(words_) + 1)]
    table = counts.select("lang", *[F.col(o).alias(w) for o, w in zip(own, words_, strict=True)], F.col("f").alias(name))
    return stage(lookup(rows, table, ["lang", *words_]).select(*rows.columns, name), f"with-{name}")


def collocations(
    docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, flush: int = FLUSH, route_rows: int = ROUTE_ROWS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases by score, count and
    the phrase's bytes."""
    leading = stage(word_counts(docs, flush), "word-counts")
    found = stage(phrase_counts(docs, leading, least, flush, route_rows), "candidates")
    one = leading.where(F.col("f") >= least).select("lang", "w1", "f")
    two, three = found.where("w3 IS NULL"), found.where("w3 IS NOT NULL")
    pair = two.select("lang", "w1", "w2", F.col("a").alias("f"))

    # A pair that a longer candidate explains goes, whatever becomes of that.
    held = three.select("lang", "w1", "w2", "a").unionByName(
        three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    )
    longest = held.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    kept = two.join(longest, ["lang", "w1", "w2"], "left").where(f"longer IS NULL OR 100 * longer < {share} * a")
    kept = stage(kept.select("lang", "w1", "w2", "w3", "a"), "unexplained")

    short = _with(_with(kept, one, ["w1"], "l"), one, ["w2"], "r")
    short = short.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("l", "r").alias("score"))
    cuts = _with(_with(_with(_with(three, one, ["w1"], "l1"), pair, ["w2", "w3"], "r1"), pair, ["w1", "w2"], "l2"), one, ["w3"], "r2")
    cuts = cuts.withColumns({"s1": _score("l1", "r1"), "s2": _score("l2", "r2")})
    first = F.col("s1") <= F.col("s2")
    long = cuts.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        *[F.when(first, F.col(x + "1")).otherwise(F.col(x + "2")).alias(n) for x, n in (("l", "l"), ("r", "r"), ("s", "score"))],
    )

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    scored = short.unionByName(long).select("*", part)
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    some = some.where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    totals = leading.groupBy("lang").agg(F.sum("f").alias("n"))
    # At most `top` rows of a language are left.
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
