r"""Secret scans: fixed patterns, and a guess-cost dynamic program on credential values.

The base patterns give the kinds `assign`, `access` and `hex`. The method looks at what stands
in a credential's place (a wider list of names, any signs in the value; in quotes with blanks,
otherwise up to a blank) and asks how many guesses an informed guesser needs: the value is cut
into dictionary words, dates, repeats, keyboard walks, alphabetic or numeric sequences and
brute-force characters so that the product of their guesses is least. Values of `MIN_LOG10` or
more become spans of the kind `guess`, whatever their length and signs, unless a base span holds
them already.

The dictionary is that of the corpus, behind some fixed words of passwords: words by the number
of documents they are in, at least `MIN_DOCUMENTS`, the `DICTIONARY` most frequent ones. Words
in a credential's place do not count, so a secret does not become a word by being copied. A
word has 3 to `LONGEST` letters, so the broadcast holds at most DICTIONARY x LONGEST letters.

Offsets are code points, the end exclusive. Null texts are empty texts and have no span.
Repeated rows are scanned each; extra columns are kept by `redact` and ignored by `scan`.
Two passes over whole texts; only words and their counts are shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwatch.llm.common import small_batches, stage, tidy

KINDS = ("assign", "access", "hex", "guess")
MIN_LOG10 = 10.0
MIN_DOCUMENTS = 2
DICTIONARY = 50_000
LONGEST = 40
PLACEHOLDER = "[SECRET]"

_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
# Where credentials stand, beyond the base names; the value is what follows up to the closing
# quote on its line or, without one, up to a blank.
_CONTEXT = re.compile(
    r"""(?ai:passwords?|passwd|passphrase|passcode|pwd|secret|token|credentials?|bearer
        |(?:api|access|private|secret|client|auth)[_-]?key|client[_-]?secret|auth)
        (?:["']?[\x20\t]*+[:=]{1,2}[\x20\t]*+|[\x20\t]++is:?[\x20\t]++)
        (?:"([^"\r\n]++)"|'([^'\r\n]++)'|["']?([^\s"'<>]++))""",
    re.X,
)
# Frequent passwords' words, by rank.
_WORDS = (
    "password 123456 qwerty letmein welcome dragon monkey admin login master sunshine princess"
    " football baseball shadow superman batman trustno1 iloveyou whatever freedom secret summer"
    " winter spring autumn hello charlie michael jordan hunter killer soccer jessica pepper"
    " ginger cookie computer internet access changeme default test guest user root server pass"
    " token example sample love money power magic star tiger eagle silver golden orange purple"
    " yellow green black white blue red monday friday january june july december company office"
    " your here this that the and for not null none true false string value enter insert"
).split()
_RANK = {w: i + 1 for i, w in enumerate(_WORDS)}
_LEET = str.maketrans("013457@$!", "oieastasi")
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (x, y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_DATES = tuple(
    re.compile(p)
    for p in (
        r"(?:19|20)\d\d",
        r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])",
        r"(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)?\d\d)",
        r"(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])[-/.]?(?:(?:19|20)?\d\d)",
    )
)


class Words:
    """Words by rank: the fixed ones first, then those of a corpus."""

    def __init__(self, corpus: list[str]):
        self.rank = {w: i + 1 for i, w in enumerate(dict.fromkeys([*_WORDS, *corpus]))}
        self.longest = max(map(len, self.rank))
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}


_FIXED = Words([])
# Costs of values up to so many characters are kept, so many at a time, as long as their dictionary.
_KEPT_LENGTH, _KEPT = 128, 1 << 14
_PARTS = 16
_LETTERS = re.compile(r"[^\W\d_]{3,}")
# A walk of more keys turns too often to cost less than MIN_LOG10.
_WALK = 128


def _lower(text: str) -> str:
    """Lower case, as many characters as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _walks(text: str) -> Iterator[tuple[int, int, float]]:
    """Runs of three or more along neighbouring keys or along the alphabet or the digits."""
    low = _lower(text)
    i = 0
    while i < len(low) - 2:
        j, turns, way = i, 0, None
        while j + 1 < min(len(low), i + _WALK):
            a, b = _PLACE.get(low[j]), _PLACE.get(low[j + 1])
            if not a or not b or a == b or abs(a[0] - b[0]) > 1 or abs(a[1] - b[1]) > 1:
                break
            step = (b[0] - a[0], b[1] - a[1])
            turns, way = turns + (step != way), step
            j += 1
        if j - i >= 2:
            for end in range(i + 3, j + 2):
                yield i, end, math.log10(47 * (end - i)) + min(turns, end - i) * math.log10(4.6)
        k = i
        step = ord(low[i + 1]) - ord(low[i])
        while abs(step) == 1 and k + 1 < len(low) and low[k + 1].isalnum() and ord(low[k + 1]) - ord(low[k]) == step:
            k += 1
        if k - i >= 2:
            for end in range(i + 3, k + 2):
                yield i, end, math.log10(26 * 2 * (end - i))
        i += 1


def _repeats(text: str) -> Iterator[tuple[int, int, int, int]]:
    """(begin, end, unit length, times) of units of up to eight characters said again."""
    for size in range(1, 9):
        i = 0
        while i + 2 * size <= len(text):
            end = i + size
            while text[end : end + size] == text[i : i + size]:
                end += size
            if end - i >= max(3, 2 * size):
                yield i, end, size, (end - i) // size
                i = end - size + 1
            else:
                i += 1


def _alphabet(text: str) -> float:
    return math.log10(
        max(
            2,
            26 * any(c.islower() for c in text)
            + 26 * any(c.isupper() for c in text)
            + 10 * any(c.isdigit() for c in text)
            + 33 * any(not c.isalnum() for c in text),
        )
    )


def guess_cost(value: str, words: Words = _FIXED) -> float:
    """log10 of the fewest guesses over all segmentations."""
    if len(value) > _KEPT_LENGTH:
        return _least_cost(value, words)
    if value not in words.known:
        if len(words.known) >= _KEPT:
            words.known.clear()
        words.known[value] = _least_cost(value, words)
    return words.known[value]


def _least_cost(value: str, words: Words) -> float:
    """Linear in the length of the value but for its longest dictionary word."""
    n, low = len(value), _lower(value)
    plain = low.translate(_LEET)
    each = _alphabet(value)
    spans: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i + 3, min(n, i + words.longest) + 1):
            rank = words.rank.get(low[i:j])
            swapped = rank is None
            rank = rank or words.rank.get(plain[i:j])
            if rank:
                mixed = value[i:j] != low[i:j]
                spans[i].append((j, math.log10(rank * (1 + mixed) * (1 + 3 * swapped))))
        if value[i].isdigit():
            for k, pattern in enumerate(_DATES):
                m = pattern.match(value, i)
                if m:
                    spans[i].append((m.end(), math.log10(120 if k == 0 else 365 * 120)))
    for i, j, cost in _walks(value):
        spans[i].append((j, cost))
    for i, j, size, times in _repeats(value):
        spans[i].append((j, size * each + math.log10(times)))
    best = [0.0] + [math.inf] * n
    for i in range(n):
        best[i + 1] = min(best[i + 1], best[i] + each)
        for j, cost in spans[i]:
            best[j] = min(best[j], best[i] + cost)
    return best[n]


Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if ":" in text or "=" in text:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_LIKELY = re.compile(r"(?ai:pass|pwd|secret|token|credential|bearer|key|auth)")


def _values(text: str) -> Iterator[tuple[int, int]]:
    """(begin, end) of the values in a credential's place."""
    if not (_LIKELY.search(text) and (":" in text or "=" in text or " is" in text or "\tis" in text)):
        return
    for m in _CONTEXT.finditer(text):
        group = next(g for g in (1, 2, 3) if m[g] is not None)
        start, end = m.span(group)
        if group == 3:
            end = start + len(m[group].rstrip(".,;:!?)]}"))
        if start < end:
            yield start, end


def guessed_spans(
    text: str, base: list[Span], min_log10: float = MIN_LOG10, words: Words = _FIXED
) -> list[Span]:
    """Values in a credential's place that cost too many guesses to be words or dates."""
    return [
        ("guess", start, end)
        for start, end in _values(text)
        if guess_cost(text[start:end], words) >= min_log10
        and not any(a <= start and end <= b for _, a, b in base)
    ]


def find(text: str | None, words: Words = _FIXED) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a whole text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, guessed_spans(text, base, words=words)


def words_of(text: str) -> set[str]:
    """The distinct words of a text outside the credentials' places."""
    parts, at = [], 0
    for start, end in _values(text):
        parts.append(text[at:start])
        at = end
    rest = "\n".join([*parts, text[at:]])
    return {w for w in set(_LETTERS.findall(rest.lower())) if len(w) <= LONGEST}


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> Words:
    """The `size` most frequent words of the texts, by documents; ties by the word.

    The number of documents that the last of them is in is found on counts of counts; words with
    more are ranked in two steps, so no more than `size` come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(words_of(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
            )

    small_batches(docs.sparkSession)
    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "word string, n long")
    totals = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_DOCUMENTS)
    totals = stage(totals, "document-counts")
    # One row per number of documents that some word is in.
    reached = F.sum("words").over(Window.orderBy(F.col("n").desc()))
    sizes = totals.groupBy("n").agg(F.count(F.lit(1)).alias("words")).withColumn("reached", reached)
    last = sizes.where(F.col("reached") >= size).agg(F.max("n")).first()[0]
    order = [F.col("n").desc(), "word"]
    some = totals.where(F.col("n") >= (last or 0)).withColumn("part", F.pmod(F.xxhash64("word"), F.lit(_PARTS)))
    some = some.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    some = some.where(F.col("place") <= size)
    whole = some.withColumn("place", F.row_number().over(Window.orderBy(*order))).where(F.col("place") <= size)
    return Words([r["word"] for r in sorted(whole.select("word", "place").collect(), key=lambda r: r["place"])])


def _written(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionary(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                base, more = find(text, sent.value)
                for column, kind in zip(rows, KINDS[:3], strict=False):
                    column.append(sum(s[0] == kind for s in base))
                rows[3].append(hashlib.sha256(_written(base).encode()).hexdigest())
                rows[4].append(_written(base + more))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(rows, kinds, strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    small_batches(docs.sparkSession)
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        tidy(run), f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(text: str | None, words: Words = _FIXED) -> str | None:
    """The text with every span, base or added, replaced; overlapping spans become one."""
    base, more = find(text, words)
    if not base and not more:
        return text
    out, at = [], 0
    for _, a, b in sorted(base + more, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], PLACEHOLDER]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The rows with secrets replaced in `text` and `n_chars` brought up to date."""
    at = [c.lower() for c in docs.columns].index("text")
    sent = docs.sparkSession.sparkContext.broadcast(dictionary(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([redacted(t, sent.value) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    small_batches(docs.sparkSession)
    out = docs.mapInArrow(tidy(run), docs.schema)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out
