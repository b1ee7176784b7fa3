"""Near duplicates from bottom-k sketches of one hash function.

A document is the set of its word shingles; documents whose sets have a Jaccard similarity of
at least `percent` / 100 are linked, and the classes are the connected components.

1. Documents with equal sets form one class, represented by the smallest id; only
   representatives go on.
2. The `k` smallest shingle hashes are the sketch. Inverted lists are kept by neighbouring
   retained values (two that follow each other in the sketch): documents as similar as asked
   share most of these, and where a set is retained whole they share one for certain, while a
   single frequent shingle makes no list.
3. Lists of up to `LIST` representatives give all their pairs, with the number of lists a pair
   meets in. Longer lists only give the pairs with their first representative.
4. A pair's similarity is estimated from the smallest `k` values of both sketches together.
   Only pairs that are clearly below are dropped (more than five standard deviations).
5. What is left is verified on the full sets, and the links are joined to components.
6. Representatives with more than an eighth of their neighbouring values in long lists
   ("dominated") may have partners that only long lists show. There, every representative that
   is not in the component of its list's first one meets all of the list with a similar size,
   part by part on sketches; rows with a pair of different components that is not ruled out
   meet again with their full sets, and what they link are components. Lists with the same first
   representative, which in a group of near copies hold much the same rows, meet as one list
   unless that makes more pairs. So long lists lose nothing either, and the pairs of a group are
   never written.

Shingles are compared as 64-bit hashes. Sets larger than k are candidates unless no two
neighbouring values among their k are common, which at the threshold has a chance below 1e-9.
No partner or candidate is capped.

Null and empty texts have no shingle and are linked with nothing. A text with fewer words than
a shingle is one shingle. Repeated rows are copies; a row without an id is a member of
its class but never its representative unless all lack one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankwatch.llm import words as W
from rankwatch.llm.common import drop_finished, lookup, rows_in_parts, small_batches, stage, tidy

K = 40
LIST = 16
BLOCK_ROWS = 512
_SEED = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(position, sorted distinct shingle hashes) of every text that has words."""
    open_doc, parts = -1, []
    for block in W.blocks(texts):
        data, begin, end = W.white_words(block)
        hashes = W.span_hashes(data, begin, end)
        edges = np.searchsorted(begin, np.append(block.starts, len(data)))
        for i, doc in enumerate(block.docs.tolist()):
            own = hashes[edges[i] : edges[i + 1]]
            if doc == open_doc:
                parts.append(own)
                continue
            if open_doc >= 0 and (whole := np.concatenate(parts)).size:
                yield open_doc, _set(whole, size)
            open_doc, parts = doc, [own]
    if open_doc >= 0 and (whole := np.concatenate(parts)).size:
        yield open_doc, _set(whole, size)


def _set(hashes: np.ndarray, size: int) -> np.ndarray:
    n = max(1, len(hashes) - size + 1)
    h = np.full(n, min(size, len(hashes)), np.uint64)
    for i in range(min(size, len(hashes))):
        h = W.mix(h * W._BASE + hashes[i : i + n])
    return np.unique(h)


def sketches(docs: DataFrame, size: int, k: int) -> DataFrame:
    """(doc_id, n, s1, s2, sketch): size of the set, a 128-bit sum of it, its k smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            s1, s2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            kept: list = [[]] * batch.num_rows
            for i, values in shingle_sets(batch.column(1), size):
                n[i] = len(values)
                s1[i] = np.add.reduce(W.mix(values + _SEED))
                s2[i] = np.add.reduce(W.mix(values ^ _SEED))
                kept[i] = values[:k].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n),
                    pa.array(s1.view(np.int64)),
                    pa.array(s2.view(np.int64)),
                    pa.array(kept, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "s1", "s2", "sketch"],
            )

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(tidy(run), f"doc_id {kind}, n long, s1 long, s2 long, sketch array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(rep, members) of the documents in `ids`; their texts are read a second time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sets = [], []
            for i, values in shingle_sets(batch.column(1), size):
                at.append(i)
                sets.append(values.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(sets, pa.binary())],
                ["rep", "members"],
            )

    narrow = docs.select(F.col("doc_id").alias("rep"), F.col("text").cast("string").alias("text"))
    kind = narrow.schema["rep"].dataType.simpleString()
    return narrow.join(ids, "rep", "left_semi").mapInArrow(tidy(run), f"rep {kind}, members binary")


def _similar_sizes(percent: int) -> Column:
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return low * 100 >= high * percent


def estimated(pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose union sketch does not rule the similarity out."""
    p = percent / 100
    low = max(0.0, p - 5.5 * (p * (1 - p) / k) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                a = left[i].values.to_numpy().view(np.uint64)
                b = right[i].values.to_numpy().view(np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                twice = both[1:] == both[:-1]
                distinct = len(both) - int(twice.sum())
                if len(a) < k and len(b) < k:
                    keep[i] = int(twice.sum()) * 100 >= percent * distinct
                    continue
                # The k smallest values of the union; a value in both stands twice.
                first = np.concatenate([[True], ~twice])
                rank = np.cumsum(first)
                shared = int((twice & (rank[1:] <= k)).sum())
                keep[i] = shared >= low * min(k, distinct)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"]
            )

    kind = pairs.schema["a"].dataType.simpleString()
    side = lambda c: classes.select(F.col("rep").alias(c), F.col("sketch").alias(f"sketch_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "sketch_a", "sketch_b").mapInArrow(tidy(run), f"a {kind}, b {kind}")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                shared = int((a[at] == b).sum())
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    side = lambda c: sets.select(F.col("rep").alias(c), F.col("members").alias(f"m_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "m_a", "m_b").mapInArrow(tidy(run), f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(rep, label): the smallest id reachable, for every id in `links` of (a, b).

    Every round takes the smallest label next door and then the label's label, so the number of
    rounds grows with the logarithm of a component's diameter. Rounds are written out."""
    both = stage(
        links.select(F.col("a").alias("x"), F.col("b").alias("y"))
        .unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(),
        "links",
    )
    labels = stage(
        both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("rep"), F.least("x", "m").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("rep").alias("y"), F.col("label").alias("l")), "y")
            .groupBy("x").agg(F.min("l").alias("l")).withColumnRenamed("x", "rep")
        )
        hooked = labels.join(near, "rep").select("rep", F.least("label", "l").alias("label"), F.col("label").alias("old"))
        hooked = stage(hooked, "hooked")
        up = hooked.select(F.col("rep").alias("label"), F.col("label").alias("over"))
        jumped = stage(
            hooked.join(up, "label").select("rep", F.col("over").alias("label"), (F.col("over") != F.col("old")).alias("moved")),
            "labels",
        )
        labels = jumped.select("rep", "label")
        if not jumped.where("moved").limit(1).count():
            return labels


_PART = ("key", "t", "x", "y")


class _Side:
    """Rows of one side of a bucket of list parts, sorted by part."""

    def __init__(self, rows: pa.Table):
        self.columns = {c: rows.column(c).combine_chunks() for c in rows.column_names}
        part = self["key"].view(np.uint64).copy()
        for name in _PART[1:]:
            part = W.mix(part + self[name].astype(np.int64).view(np.uint64) + _SEED)
        self.order = np.argsort(part, kind="stable")
        self.parts, self.head = np.unique(part[self.order], return_index=True)
        self.head = np.append(self.head, len(part))

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name].to_numpy(zero_copy_only=False)

    def rows(self, i: int) -> np.ndarray:
        return self.order[self.head[i] : self.head[i + 1]]

    def values(self, name: str, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the arrays of some rows, which of the rows each is of)"""
        offsets, flat = self.columns[name].offsets.to_numpy(), self.columns[name].values.to_numpy()
        size = offsets[rows + 1] - offsets[rows]
        at = np.repeat(offsets[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return flat[at], np.repeat(np.arange(len(rows)), size)


def _in_common(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """How many values every row of one side shares with every row of the other."""
    both = np.intersect1d(one[0], two[0])
    out = np.zeros(shape, np.float32)
    for i in range(0, len(both), 4096):
        some = both[i : i + 4096]
        tables = []
        for (values, owner), rows in zip((one, two), shape, strict=True):
            at = np.searchsorted(some, values)
            at[at == len(some)] = 0
            hit = some[at] == values
            table = np.zeros((rows, len(some)), np.float32)
            table[owner[hit], at[hit]] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _met(left: pa.Table, right: pa.Table) -> Iterator[tuple[_Side, _Side, np.ndarray, np.ndarray]]:
    """The parts that both sides of a bucket have."""
    if left.num_rows and right.num_rows:
        one, two = _Side(left), _Side(right)
        _, at_one, at_two = np.intersect1d(one.parts, two.parts, return_indices=True)
        for p, q in zip(at_one.tolist(), at_two.tolist(), strict=True):
            yield one, two, one.rows(p), two.rows(q)


def _open_rows(k: int, percent: int, low: float, kind: pa.DataType):
    """Rows of list parts with a pair of different labels that the union sketch does not rule
    out. A pair counts in the first of the long lists that hold both."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        for one, two, rows, others in _met(left, right):
            shape = (len(rows), len(others))
            shared = _in_common(one.values("sketch", rows), two.values("sketch", others), shape)
            n_one, n_two = one["n"][rows], two["n"][others]
            small, large = np.minimum.outer(n_one, n_two), np.maximum.outer(n_one, n_two)
            # Common values, against the fewest among the k smallest of the union.
            some = (shared >= low * np.minimum(k, small)) & (100 * small >= percent * large)
            some &= one["label"][rows][:, None] != two["label"][others]
            if not some.any():
                continue
            own = one["key"][rows[0]]
            earlier = []
            for side, at in ((one, rows), (two, others)):
                keys, owner = side.values("keys", at)
                earlier.append((keys[keys < own], owner[keys < own]))
            some &= _in_common(*earlier, shape) == 0
            part = tuple(one[c][rows[0]] for c in _PART)
            for i, side, at in ((0, one, rows[some.any(axis=1)]), (1, two, others[some.any(axis=0)])):
                found += [(*part, i, *r) for r in zip(side["rep"][at].tolist(), side["label"][at].tolist(), strict=True)]
        columns = list(zip(*found, strict=True)) if found else [()] * 7
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), kind, kind]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*_PART, "side", "rep", "label"]
        )

    return run


def _links_in_parts(percent: int, kind: pa.DataType):
    """Pairs of labels that a pair of full sets in one part links."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: set[tuple] = set()
        for one, two, rows, others in _met(left, right):
            sets = [[np.frombuffer(m, np.uint64) for m in side["members"][at]] for side, at in ((one, rows), (two, others))]
            size = [np.array([len(m) for m in side]) for side in sets]
            flat = [(np.concatenate(side), np.repeat(np.arange(len(side)), n)) for side, n in zip(sets, size, strict=True)]
            shared = _in_common(*flat, (len(rows), len(others)))
            union = size[0][:, None] + size[1] - shared
            label = one["label"][rows], two["label"][others]
            i, j = np.nonzero((100 * shared >= percent * union) & (label[0][:, None] != label[1]))
            a, b = label[0][i], label[1][j]
            found.update(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.Table.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    return run


def _bucketed(one: DataFrame, two: DataFrame, parts: int, function, schema: str) -> DataFrame:
    """Parts of both sides that meet, many in one call."""
    buckets = rows_in_parts(one.sparkSession, parts, 32)
    bucket = F.pmod(F.xxhash64(*_PART), F.lit(buckets)).cast("int")
    # New names of columns, so the two sides are not mistaken for one.
    one, two = (df.withColumn("bucket", bucket).toDF(*df.columns, "bucket") for df in (one, two))
    return one.groupBy("bucket").cogroup(two.groupBy("bucket")).applyInArrow(function, schema)


def _as_one(in_long: DataFrame) -> DataFrame:
    """(rep, keys): the lists a representative meets others in; `in_long` is (key, rep, n, a, n_a)
    with the first representative `a` of the list.

    Lists with the same first representative become one, under the smallest of their keys, where
    its rows make no more pairs than theirs. Whoever shares a list shares the one it went into."""
    pairs = F.pow(F.col("m").cast("double"), 2)
    apart = in_long.groupBy("a", "key").agg(F.count("*").alias("m")).groupBy("a").agg(
        F.sum(pairs).alias("pairs"), F.min("key").alias("one")
    )
    merged = in_long.select("a", "rep").distinct().groupBy("a").agg(F.count("*").alias("m"))
    lists = merged.join(apart, "a").select("a", F.when(pairs <= F.col("pairs"), F.col("one")).alias("one"))
    # A row holds at most k - 1 keys.
    return lookup(in_long, stage(lists, "long-lists"), ["a"]).groupBy("rep").agg(
        F.sort_array(F.collect_set(F.coalesce("one", "key"))).alias("keys")
    )


def _long_links(
    docs: DataFrame, facts: DataFrame, labels: DataFrame, size: int, k: int, percent: int
) -> DataFrame:
    """Links between components inside long lists; `facts` is (rep, n, sketch, keys).

    Rows meet rows of their own and the neighbouring size classes; both sides of a class are
    cut into parts of bounded size by a hash. What a part emits follows its rows, not its
    pairs: first the rows with a pair that the sketches do not rule out, then, with their full
    sets, the components that are linked."""
    p = percent / 100
    low = max(0.0, p - 5.5 * (p * (1 - p) / k) ** 0.5)
    kind = facts.schema["rep"].dataType
    facts = stage(facts.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "long-facts")
    # The rows of lists are written out of their representative's keys. Lists of one component are left out.
    known = facts.withColumn("key", F.explode("keys"))
    first = known.groupBy("key").agg(
        F.min(F.struct("rep", "label"))["label"].alias("first"), (F.min("label") < F.max("label")).alias("open")
    ).where("open").select("key", "first")
    # Sizes of one class and the next can differ by the asked ratio, never those two apart.
    known = stage(
        known.join(first, "key")
        .withColumn("g", F.floor(F.log(F.col("n")) / F.lit(-np.log(p)) if p < 1 else F.col("n")).cast("int"))
        .withColumn("apart", F.col("label") != F.col("first")).drop("first"),
        "long-members",
    )
    # Which classes of a list meet is worked out on the classes; rows only go where others are.
    parts = lambda n: F.ceil(n / BLOCK_ROWS).cast("int")
    sized = stage(
        known.groupBy("key", "g").agg(F.count("*").alias("n"), F.count_if("apart").alias("n_apart")), "long-sizes"
    )
    near = F.explode(F.sequence(F.col("g") - 1, F.col("g") + 1)).alias("t")
    there = sized.select("key", F.col("g").alias("t"), parts(F.col("n")).alias("rights"))
    meet = stage(sized.where("n_apart > 0").select("key", "g", "n_apart", near).join(there, ["key", "t"]), "long-classes")
    cells = stage(
        meet.groupBy("key", "t").agg(parts(F.sum("n_apart")).alias("lefts"), F.max("rights").alias("rights")), "long-cells"
    )
    hashed = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("key", "rep", "n", "label", "sketch", "keys")
    ways = meet.select("key", "g", "t").join(cells, ["key", "t"])
    one = known.where("apart").join(ways, ["key", "g"]).select(*columns, "t", hashed("lefts").alias("x"), every("rights").alias("y"))
    two = known.withColumn("t", F.col("g")).join(cells, ["key", "t"]).select(
        *columns, "t", every("lefts").alias("x"), hashed("rights").alias("y")
    )
    n_parts = cells.agg(F.sum(F.col("lefts") * F.col("rights"))).first()[0] or 0
    arrow = to_arrow_type(kind)
    spelled = kind.simpleString()
    open_ = stage(
        _bucketed(one, two, n_parts, _open_rows(k, percent, low, arrow), f"key long, t int, x int, y int, side int, rep {spelled}, label {spelled}"),
        "open-rows",
    )
    sets = stage(_sets(docs, open_.select("rep"), size), "open-sets")
    whole = open_.join(sets, "rep").select(*_PART, "side", "rep", "label", "members")
    sides = (whole.where(F.col("side") == i).drop("side") for i in (0, 1))
    n_open = open_.select(*_PART).distinct().count()
    drop_finished(docs.sparkSession)
    return _bucketed(*sides, 8 * n_open, _links_in_parts(percent, arrow), f"a {spelled}, b {spelled}").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    small_batches(docs.sparkSession)
    rows = stage(sketches(docs, size, k), "sketches")
    classes = stage(
        rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n")
        .agg(F.min(F.struct("doc_id", "sketch")).alias("f"))
        .select(F.col("f.doc_id").alias("rep"), "n", "s1", "s2", F.col("f.sketch").alias("sketch")),
        "classes",
    )
    # Lists by two values that follow each other.
    keys = F.zip_with(
        F.slice("sketch", 1, F.greatest(F.size("sketch") - 1, F.lit(0))),
        F.slice("sketch", 2, k),
        lambda a, b: F.xxhash64(a, b),
    )
    entries = classes.where(F.size("sketch") > 1).select("rep", "n", F.explode(keys).alias("key"))
    lengths = entries.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    entries = stage(
        entries.join(lengths, "key").select("key", "rep", "n", (F.col("m") > LIST).alias("long")), "entries"
    )
    long_ = entries.where("long")
    spread = long_.groupBy("rep").agg(F.count("*").alias("n_long"))
    heavy = stage(
        spread.join(classes.select("rep", (F.size("sketch") - 1).alias("n_keys")), "rep")
        .select("rep", "n_long", "n_keys"),
        "heavy",
    )
    dominated = heavy.where("8 * n_long > n_keys").select("rep")

    short = entries.where("NOT long").join(
        heavy.select("rep", "n_long", "n_keys"), "rep", "left"
    ).select("key", "rep", "n", F.coalesce(F.col("n_long") * 5 > F.col("n_keys"), F.lit(False)).alias("few"))
    short = stage(short, "short-lists")
    a = short.select("key", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("few").alias("few_a"))
    b = short.select("key", F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("few").alias("few_b"))
    met = (
        a.join(b, "key").where((F.col("a") < F.col("b")) & _similar_sizes(percent))
        .groupBy("a", "b")
        .agg(F.count("*").alias("met"), F.max(F.col("few_a") | F.col("few_b")).alias("few"), F.min(F.least("n_a", "n_b")).alias("least"))
    )
    # Two meetings are certain for sets retained whole and all but certain for larger ones,
    # unless long lists have taken a part of the keys.
    pairs = met.where((F.col("met") > 1) | F.col("few")).select("a", "b")

    in_long = stage(long_.join(dominated, "rep", "left_semi").select("key", "rep", "n"), "dominated")
    first = in_long.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("f")).select(
        "key", F.col("f.rep").alias("a"), F.col("f.n").alias("n_a")
    )
    in_long = stage(in_long.join(first, "key"), "long-rows")
    to_first = (
        in_long.select("a", "n_a", F.col("rep").alias("b"), F.col("n").alias("n_b"))
        .where((F.col("a") < F.col("b")) & _similar_sizes(percent)).select("a", "b")
    )
    pairs = stage(pairs.unionByName(to_first).distinct(), "pairs")
    likely = stage(estimated(pairs, classes, k, percent), "likely")
    drop_finished(docs.sparkSession)

    ends = likely.select(F.col("a").alias("rep")).unionByName(likely.select(F.col("b").alias("rep")))
    sets = stage(_sets(docs, ends, size), "sets")
    labels = components(verified(likely, sets, percent))
    drop_finished(docs.sparkSession)

    facts = _as_one(in_long).join(classes.select("rep", "n", "sketch"), "rep")
    more = _long_links(docs, facts, labels, size, k, percent)
    linked = labels.where("rep <> label").select(F.col("rep").alias("a"), F.col("label").alias("b"))
    return _members(rows, classes, components(linked.unionByName(more)))


def _sets(docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """Full sets of some representatives, each once."""
    return full_sets(docs, stage(reps.distinct(), "needed"), size).dropDuplicates(["rep"])


def _members(rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row with its class's component. The join key of a row without shingles or id is
    its own hash, so those rows don't meet in one task."""
    named = classes.join(labels, "rep", "left").select(
        "s1", "s2", F.col("n").alias("n_c"), F.coalesce("label", "rep").alias("label")
    )
    joined = rows.drop("sketch").join(
        named, (rows["s1"] == named["s1"]) & (rows["s2"] == named["s2"]) & (rows["n"] == named["n_c"]) & (rows["n"] > 0), "left"
    )
    component = F.coalesce(F.col("label"), F.col("doc_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.col("label").isNull()).alias("kept"),
    )
