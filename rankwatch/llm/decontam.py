"""Benchmark decontamination by winnowing.

Both sides keep, of every `w` consecutive hashes of `k` words, the smallest. With
k + w - 1 = 10 every shared span of ten words keeps a common hash on both sides: the ten
words have the same w hashes and so the same smallest one. Kept hashes of documents and items
are joined; each meeting is extended to the ten-word windows around it, which are compared
word by word. Items of fewer than ten words are one window: for each such length k is the
length and w is 1.

Everything is DataFrame work on the JVM. The documents' kept hashes are written once; texts are
read a second time only for documents with a meeting. Benchmarks are joined by what Spark
knows of their size, so a large one is shuffled.

Words: A-Z lower-cased, then runs of letters, digits and everything beyond ASCII. A null or
empty text has no words and is clean; an item without words has no window. Repeated documents
are reported each; items with equal ids count as one item. An item without an id counts in n_hit
and contaminated like any other; n_items and items_sha256 are of ids and leave it out. Joins go
by a key of id and text, of documents and of items. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwatch.llm.common import row_key, stage

WINDOW = 10
K = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # Pure ASCII (as many bytes as characters) takes the shorter way to the same letters.
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )
    # Breaks at the ends would leave empty words.
    return F.array_remove(F.split(lowered, _BREAKS), "")


def gram_hashes(tokens: Column, k: int) -> Column:
    """Hashes of all runs of k words, by place."""
    return F.when(
        F.size(tokens) >= k,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - (k - 1)), lambda i: F.xxhash64(F.slice(tokens, i, k))
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def with_kept_hashes(df: DataFrame, tokens: str, out: str, k: int, w: int) -> DataFrame:
    """Add the distinct smallest hashes of w neighbours (all hashes where there are fewer).

    Each step is a column of its own: inside one expression it would be computed again for
    every use."""
    df, last = df.withColumn("_s0", gram_hashes(F.col(tokens), k)), "_s0"
    # Smallest of 2, then of 4 and so on by joining overlapping stretches; the stretches at the
    # end are shorter, which keeps a few more.
    reach = 1
    while reach < w:
        step = min(reach, w - reach)
        name = f"_s{reach}"
        shifted = F.slice(last, step + 1, 1 << 30)
        df = df.withColumn(name, F.zip_with(last, shifted, lambda a, b: F.least(a, b)))
        reach, last = reach + step, name
    return df.withColumn(out, F.array_distinct(last))


def _rules(window: int, k: int, lengths: list[int]) -> list[tuple[int, int, int]]:
    """(window length, k, w): the full windows, then one rule for each shorter item length."""
    return [(window, k, window - k + 1), *((n, n, 1) for n in lengths if n < window)]


def windows_of_items(items: DataFrame, window: int) -> DataFrame:
    """(key, item_id, words, length of its windows) of items that have words."""
    tokens = items.select(
        F.col("item_id"), row_key("item_id", "text").alias("_item_key"), words(F.col("text")).alias("_item")
    )
    return tokens.where(F.size("_item") > 0).withColumn(
        "_len", F.least(F.size("_item"), F.lit(window))
    )


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(documents with n_words and a row key, hit windows of (key, item_id, start, length))."""
    cut = stage(windows_of_items(items, window), "items")
    # Lengths below the window: at most window - 1 values.
    lengths = sorted(r["_len"] for r in cut.select("_len").distinct().collect())
    rules = _rules(window, k, lengths)

    tokens = F.col("_words")
    base = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kept = base.withColumn("_words", words(F.col("text")))
    for n, kk, w in rules:
        kept = with_kept_hashes(kept, "_words", f"_f{n}", kk, w)
    kept = kept.select(
        "doc_id",
        row_key("doc_id", "text").alias("_key"),
        F.size("_words").cast("long").alias("n_words"),
        *[f"_f{n}" for n, _, _ in rules],
    )
    kept = stage(kept, "fingerprints")

    met = []
    for n, kk, w in rules:
        own = cut.where(F.col("_len") == n).select(
            "_item_key", F.posexplode(gram_hashes(F.col("_item"), kk)).alias("_q", "_h")
        )
        own = stage(own, f"item-hashes-{n}")
        marks = own.select("_h").distinct()
        found = kept.select("_key", F.explode(f"_f{n}").alias("_h")).join(stage(marks, "marks"), "_h", "left_semi")
        met.append((n, kk, w, stage(found, f"met-{n}"), own))

    touched = stage(reduce(DataFrame.unionByName, [m[3].select("_key") for m in met]).distinct(), "touched")
    suspects = stage(
        base.withColumn("_key", row_key("doc_id", "text"))
        .join(touched, "_key", "left_semi")
        .dropDuplicates(["_key"])
        .select("_key", words(F.col("text")).alias("_words")),
        "suspects",
    )
    hits = []
    for n, kk, w, found, own in met:
        # Where the common hashes stand in both texts, then every window around them.
        places = suspects.select("_key", "_words", F.posexplode(gram_hashes(tokens, kk)).alias("_p", "_h"))
        narrow = places.select("_key", "_p", "_h").join(found, ["_key", "_h"], "left_semi")
        around = (
            narrow.join(own.select("_h", "_item_key", "_q"), "_h")
            .select("_key", "_item_key", "_p", "_q", F.explode(F.sequence(F.lit(0), F.lit(w - 1))).alias("_o"))
            .where((F.col("_p") >= F.col("_o")) & (F.col("_q") >= F.col("_o")))
            .select("_key", "_item_key", (F.col("_p") - F.col("_o")).alias("_start"), (F.col("_q") - F.col("_o")).alias("_at"))
            .distinct()
        )
        texts = cut.where(F.col("_len") == n).select("_item_key", "item_id", "_item")
        doc_side = F.slice(F.col("_words"), F.col("_start") + 1, n)
        item_side = F.slice(F.col("_item"), F.col("_at") + 1, n)
        checked = (
            around.join(suspects, "_key")
            .join(texts, "_item_key")
            .where((F.size(doc_side) == n) & (doc_side == item_side))
            .select("_key", "item_id", F.col("_start").alias("start"), F.lit(n).alias("length"))
        )
        hits.append(checked.distinct())
    return kept.select("doc_id", "_key", "n_words"), reduce(DataFrame.unionByName, hits)


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row."""
    rows, hits = find_hits(docs, items, window, k)
    hits = stage(hits, "hit-windows")
    # Words under the union of the windows of a document: what each adds beyond those before.
    spans = hits.groupBy("_key", "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy("_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = spans.withColumn("_from", F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    covered = fresh.groupBy("_key").agg(
        F.sum(F.greatest(end - F.col("_from"), F.lit(0))).cast("long").alias("n_hit")
    )
    named = (
        hits.where(F.col("item_id").isNotNull())
        .select("_key", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("_key")
        .agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("_items"))
    )
    found = covered.join(named, "_key", "left")
    return rows.join(found, "_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("_items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
