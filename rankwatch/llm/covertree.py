"""Near duplicates among vectors: dual traversal of cover trees, exact at a cosine threshold.

Vectors are compared only within a label (not null) and a length. On the unit sphere a cosine of
at least `cosine` is a distance of at most sqrt(2 - 2 cosine), and distances obey the triangle
inequality, so two tree nodes can be told apart, or linked as a whole, by the distance of their
centres and their covering radii.

1. Equal directions are one point with a count; only distinct points go on.
2. Labels with more than `CHUNK` points are cut into cells: points belong to the nearest of a few
   centres, the first ones of a farthest-first order of a bounded sample (`SAMPLE`), which is a
   nested cover of its own. The sample decides how even the cells are, never what is compared.
   Cells with more than `CHUNK` points are dealt to chunks by a hash.
3. A task builds the cover tree of one chunk: nested levels with halving radii; a node's centre is
   its first child's centre, the children's centres are farther apart than the level's radius
   and cover the node's points within it. Trees are written as one row per chunk.
4. Pairs of cells that their measured radii can not tell apart are listed per label (at most
   `MOST_CELLS` cells each), and a task walks down the two trees of each pair of their chunks.
   Pairs of nodes too far apart are left out, pairs near enough throughout are counted without
   being opened, the rest is opened down to points, where the cosine itself decides.
5. A pair of chunks yields a count per point and a forest of links, at most a row per point of
   either, never the pairs themselves. Counts are summed and the forests joined to components.

The pairs of a group of near copies are counted, not written. Work grows with the pairs of chunks
that radii do not separate: in data without structure, with the square of a label's points.

A vector that is null, zero or holds a null or non-finite component, or has no label, links with
nothing and is its own component. Rows of equal direction under one label are linked with each
other. Repeated ids are vectors of their own; a row without an id counts and links, and names a
component only where all of it lacks ids. An empty table gives an empty result; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwatch.llm.common import byte_batches, connected, lookup, stage

CHUNK = 4096
SAMPLE = 8192
MOST_CELLS = 1024
LEAF = 32
# Bounds are trusted beyond this; a distance from a cosine is that uncertain near 0.
SLACK = 1e-6
# Distances of one step of the traversal are worked out in blocks of so many.
BLOCK = 1 << 20
_NODE = np.dtype([("start", "i8"), ("end", "i8"), ("centre", "i8"), ("radius", "f8"), ("kids", "i8"), ("kids_end", "i8")])


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def directions(vectors: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """(positions, vectors) of those that take part, scaled by a power of two to below 1: that
    changes no cosine and no digit, and squares neither overflow nor vanish."""
    at, out = [], []
    offsets, values = vectors.offsets.to_numpy(), vectors.values
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    holes = values.is_null().to_numpy(zero_copy_only=False)
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(valid).tolist():
        a, b = offsets[i], offsets[i + 1]
        v = flat[a:b]
        if a == b or holes[a:b].any() or not np.isfinite(v).all():
            continue
        top = np.abs(v).max()
        if top > 0:
            at.append(i)
            out.append(np.ldexp(v, -math.frexp(top)[1]) + 0.0)
    return at, out


def points(df: DataFrame) -> DataFrame:
    """(vec_id, g, v, key): `g` is the group that is compared, `key` tells points apart (128 bits
    of their bytes and group); null where the vector takes no part."""
    kind = df.schema["embedding"].dataType.elementType
    store = np.float32 if isinstance(kind, T.FloatType) else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_pylist()
            n = batch.num_rows
            group, vector, key = [None] * n, [None] * n, [None] * n
            for i, v in zip(*directions(batch.column("embedding")), strict=True):
                if labels[i] is not None:
                    group[i] = f"{len(v)}:{labels[i]}"
                    vector[i] = v.astype(store).tobytes()
                    text = group[i].encode()
                    key[i] = hashlib.blake2b(b"%d:%b%b" % (len(text), text, vector[i]), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(group, pa.string()), pa.array(vector, pa.binary()), pa.array(key, pa.binary())],
                ["vec_id", "g", "v", "key"],
            )

    narrow = df.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"),
        F.col("embedding").cast("array<float>" if store is np.float32 else "array<double>"),
    )
    return narrow.mapInArrow(run, "vec_id long, g string, v binary, key binary")


def _matrix(rows, store) -> np.ndarray:
    return np.stack([np.frombuffer(v, store) for v in rows]).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def farthest_first(u: np.ndarray, most: int) -> np.ndarray:
    """The first `most` rows of a farthest-first order of unit vectors: every prefix is a nested
    cover, its radius the distance at which the next row would join."""
    chosen, best = [0], _distance(u @ u[0])
    while len(chosen) < min(most, len(u)):
        nxt = int(best.argmax())
        if best[nxt] <= 0:
            break
        chosen.append(nxt)
        best = np.minimum(best, _distance(u @ u[nxt]))
    return u[chosen]


@dataclass
class Tree:
    """Points in the order of the tree, so that a node is a range of them, and the nodes."""

    x: np.ndarray
    norm: np.ndarray
    weight: np.ndarray
    node: np.ndarray

    def cosines(self, own: np.ndarray, other: "Tree", others: np.ndarray) -> np.ndarray:
        return (self.x[own] @ other.x[others].T) / np.outer(self.norm[own], other.norm[others])


def _cover(u: np.ndarray, first: int, radius: float) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(owner, distance to it) per row and the centres: farther apart than `radius`, every row
    within it of its own."""
    centres, best = [first], _distance(u @ u[first])
    owner = np.zeros(len(u), np.int64)
    while True:
        open_ = np.flatnonzero(best > radius)[:64]
        if not len(open_):
            return owner, best, centres
        d = _distance(u @ u[open_].T)
        for k, row in enumerate(open_.tolist()):
            if best[row] > radius:
                nearer = d[:, k] < best
                nearer[row] = True
                owner[nearer] = len(centres)
                best = np.where(nearer, d[:, k], best)
                best[row] = 0.0
                centres.append(row)


def build_tree(x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, Tree]:
    """(order of the points, tree)"""
    u = _unit(x)
    order = np.arange(len(x))
    far = float(_distance(u @ u[0]).max())
    nodes: list[list] = [[0, len(x), 0, far, 0, 0]]  # the centre is a place in the order
    at = 0
    while at < len(nodes):
        start, end, centre, radius = nodes[at][:4]
        if end - start > LEAF and radius > SLACK:
            level = 2.0 ** math.floor(math.log2(radius))
            level = level if level < radius else level / 2
            own = order[start:end]
            owner, best, centres = _cover(u[own], centre - start, level)
            if len(centres) > 1:
                # Each child begins with its centre.
                head = np.zeros(len(own), bool)
                head[centres] = True
                sort = np.lexsort((~head, owner))
                order[start:end] = own[sort]
                sizes = np.bincount(owner)
                radii = np.zeros(len(sizes))
                np.maximum.at(radii, owner, best)
                nodes[at][2], nodes[at][4], nodes[at][5] = start, len(nodes), len(nodes) + len(sizes)
                begin = start
                for size, r in zip(sizes.tolist(), radii.tolist(), strict=True):
                    nodes.append([begin, begin + size, begin, r, 0, 0])
                    begin += size
        at += 1
    x = x[order]
    node = np.array([tuple(n) for n in nodes], _NODE)
    return order, Tree(x, np.linalg.norm(x, axis=1), weight[order], node)


@dataclass
class _Front:
    """What a node opens to: its children, or its points (node -1)."""

    node: np.ndarray
    start: np.ndarray
    end: np.ndarray
    centre: np.ndarray
    radius: np.ndarray


def _open(tree: Tree, node: int, point: int) -> _Front:
    if node >= 0 and tree.node["kids"][node]:
        at = np.arange(tree.node["kids"][node], tree.node["kids_end"][node])
        kids = tree.node[at]
        single = kids["end"] - kids["start"] == 1
        return _Front(np.where(single, -1, at), kids["start"], kids["end"], kids["centre"], kids["radius"])
    at = np.arange(tree.node["start"][node], tree.node["end"][node]) if node >= 0 else np.array([point])
    return _Front(np.full(len(at), -1), at, at + 1, at, np.zeros(len(at)))


class _Union:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        parent = self.parent
        while True:
            a, b = parent[i], parent[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := parent[parent], parent):
                parent[:] = up


def traverse(one: Tree, two: Tree | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two trees (or inside one, `two` None): linked weight per point of `one` and
    of `two`, and for all points, those of `two` after those of `one`, the first of their class.

    Inside one tree a point does not link with itself; its own weight is left to the caller."""
    same, other = two is None, one if two is None else two
    reach, n = math.sqrt(2.0 - 2.0 * cosine), len(one.x)
    shift = 0 if same else n
    union = _Union(n if same else n + len(other.x))
    mine, theirs = np.zeros(n, np.int64), np.zeros(len(other.x), np.int64)
    total = np.concatenate([[0], np.cumsum(one.weight)]), np.concatenate([[0], np.cumsum(other.weight)])
    todo = [(0, 0, 0, 0)]  # (node, point) of either side; a point where the node is -1
    while todo:
        a, p, b, q = todo.pop()
        left, right = _open(one, a, p), _open(other, b, q)
        rows = max(1, BLOCK // len(right.node))
        for k in range(0, len(left.node), rows):
            s = slice(k, k + rows)
            cos = one.cosines(left.centre[s], other, right.centre)
            d = _distance(cos)
            room = left.radius[s][:, None] + right.radius[None, :]
            points_ = (left.node[s] < 0)[:, None] & (right.node < 0)[None, :]
            near = np.where(points_, cos >= cosine, d + room <= reach - SLACK)
            for i, j in zip(*np.nonzero(~points_ & ~near & (d - room <= reach + SLACK)), strict=True):
                todo.append((int(left.node[k + i]), int(left.centre[k + i]), int(right.node[j]), int(right.centre[j])))
            i, j = np.nonzero(near)
            i += k
            if same:
                twin = (left.start[i] == right.start[j]) & (left.node[i] < 0)
                i, j = i[~twin], j[~twin]
            if not len(i):
                continue
            li, le, ri, re = left.start[i], left.end[i], right.start[j], right.end[j]
            _add(mine, li, le, total[1][re] - total[1][ri])
            if not same:
                _add(theirs, ri, re, total[0][le] - total[0][li])
            union.join(left.centre[i], right.centre[j] + shift)
            wide = np.flatnonzero((le - li > 1) | (re - ri > 1))
            for x, y, z, w in zip(li[wide], le[wide], ri[wide], re[wide], strict=True):
                union.join(np.arange(x, y), np.full(y - x, z + shift))
                union.join(np.arange(z, w) + shift, np.full(w - z, x))
                if same and x == z:
                    mine[x:y] -= one.weight[x:y]
    return mine, theirs, union.parent


def _add(out: np.ndarray, start: np.ndarray, end: np.ndarray, gain: np.ndarray) -> None:
    one = end - start == 1
    np.add.at(out, start[one], gain[one])
    for s, e, g in zip(start[~one], end[~one], gain[~one], strict=True):
        out[s:e] += g


_CHUNK_ROW = "g string, cell int, chunk long, keys array<binary>, weight array<long>, x binary, node binary"


def _tree_row(store):
    def run(rows: pa.Table) -> pa.Table:
        x = _matrix(rows.column("v").to_pylist(), store)
        order, tree = build_tree(x, rows.column("weight").to_numpy())
        keys = rows.column("key").combine_chunks().take(pa.array(order))
        return pa.table({
            **{c: rows.column(c).slice(0, 1) for c in ("g", "cell", "chunk")},
            "keys": pa.array([keys.to_pylist()], pa.list_(pa.binary())),
            "weight": pa.array([tree.weight], pa.list_(pa.int64())),
            "x": pa.array([tree.x.astype(store).tobytes()], pa.binary()),
            "node": pa.array([tree.node.tobytes()], pa.binary()),
        })

    return run


def _read_tree(weight: list[int], x: bytes, node: bytes, store) -> Tree:
    weight = np.array(weight, np.int64)
    rows = np.frombuffer(x, store).reshape(len(weight), -1).astype(np.float64)
    return Tree(rows, np.linalg.norm(rows, axis=1), weight, np.frombuffer(node, _NODE))


def _traversal(cosine: float, store):
    """Per pair of trees: (a, links, b), the linked weight of every point that has any and its
    class's first point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                one = _read_tree(r["weight"], r["x"], r["node"], store)
                two = None if r["same"] else _read_tree(r["weight2"], r["x2"], r["node2"], store)
                mine, theirs, first = traverse(one, two, cosine)
                keys = r["keys"] if two is None else r["keys"] + r["keys2"]
                links = mine if two is None else np.concatenate([mine, theirs])
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[k] for k in at.tolist()], pa.binary()),
                        pa.array(links[at], pa.int64()),
                        pa.array([keys[k] for k in first[at].tolist()], pa.binary()),
                    ],
                    ["a", "links", "b"],
                )

    return run


def _meeting_cells(centres: np.ndarray, reach: float):
    """Pairs of cells of one group that their centres' distance and radii do not keep apart."""

    def run(rows: pa.Table) -> pa.Table:
        cell, radius = rows.column("cell").to_numpy(), rows.column("radius").to_numpy()
        d = _distance(centres[cell] @ centres[cell].T) if cell.min() >= 0 else np.zeros((len(cell), len(cell)))
        i, j = np.nonzero((d <= reach + SLACK + radius[:, None] + radius[None, :]) & (cell[:, None] <= cell[None, :]))
        return pa.table({
            "g": pa.array([rows.column("g")[0].as_py()] * len(i), pa.string()),
            "cell": pa.array(cell[i], pa.int32()),
            "cell2": pa.array(cell[j], pa.int32()),
        })

    return run


def _into_cells(centres: np.ndarray, chunk: int, store):
    """Cell and distance to its centre; points of groups that fit in one chunk are one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            cell, far = np.full(len(n), -1, np.int32), np.zeros(len(n))
            vectors = batch.column("v").to_pylist()
            size = np.array([len(v) for v in vectors])
            for length in np.unique(size[n > chunk]).tolist():
                at = np.flatnonzero((size == length) & (n > chunk))
                x = _unit(_matrix([vectors[i] for i in at.tolist()], store))
                # Shorter vectors are as good as filled up with zeros.
                wide = min(x.shape[1], centres.shape[1])
                d = _distance(x[:, :wide] @ centres[:, :wide].T)
                cell[at] = d.argmin(axis=1)
                far[at] = d[np.arange(len(at)), cell[at]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("g", "key", "v", "weight")] + [pa.array(cell, pa.int32()), pa.array(far)],
                ["g", "key", "v", "weight", "cell", "far"],
            )

    return run


def _centres(distinct: DataFrame, most: int, rows: int, store) -> np.ndarray:
    """Unit vectors to cut large groups by, from a sample of bounded size drawn by key."""
    share = min(1.0, SAMPLE / max(rows, 1))
    drawn = distinct.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v")
    vectors = [np.frombuffer(r["v"], store).astype(np.float64) for r in drawn.toLocalIterator()]
    wide = max((len(v) for v in vectors), default=1)
    x = np.array([np.pad(v, (0, wide - len(v))) for v in vectors]) if vectors else np.ones((1, 1))
    return farthest_first(_unit(x), most)


def near_duplicates(df: DataFrame, cosine: float = 0.98, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding, label).

    `n_links` counts the other rows at `cosine` or more (0 < cosine <= 1), `component_id` is the
    smallest id reachable, `kept` is whether that is the row's own."""
    spark = df.sparkSession
    byte_batches(spark)
    kind = df.schema["embedding"].dataType.elementType
    store, reach = (np.float32 if isinstance(kind, T.FloatType) else np.float64), math.sqrt(2.0 - 2.0 * cosine)
    rows = stage(points(df), "vectors")
    whole = rows.where("key IS NOT NULL")
    distinct = stage(
        whole.groupBy("key").agg(
            F.min("g").alias("g"), F.min("v").alias("v"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first")
        ),
        "points",
    )
    sizes = stage(distinct.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "group-sizes")
    top = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    most = min(MOST_CELLS, -(-4 * (top["most"] or 0) // chunk)) if (top["most"] or 0) > chunk else 1
    centres = _centres(distinct, most, top["all"] or 0, store)

    sized = lookup(distinct, sizes, ["g"]).select("g", "key", "v", "weight", "n")
    placed = stage(
        sized.mapInArrow(_into_cells(centres, chunk, store), "g string, key binary, v binary, weight long, cell int, far double"),
        "cells",
    )
    cells = stage(
        placed.groupBy("g", "cell").agg(F.max("far").alias("radius"), F.ceil(F.count(F.lit(1)) / chunk).alias("chunks")),
        "cell-sizes",
    )
    trees = stage(
        lookup(placed, cells.select("g", "cell", "chunks"), ["g", "cell"])
        .withColumn("chunk", F.pmod(F.xxhash64("key"), "chunks"))
        .groupBy("g", "cell", "chunk").applyInArrow(_tree_row(store), _CHUNK_ROW),
        "trees",
    )

    meet = cells.groupBy("g").applyInArrow(_meeting_cells(centres, reach), "g string, cell int, cell2 int")
    chunks = cells.select("g", "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    work = (
        meet.join(chunks, ["g", "cell"])
        .join(chunks.toDF("g", "cell2", "chunk2"), ["g", "cell2"])
        .where("cell < cell2 OR chunk <= chunk2")
        .select("g", "cell", "chunk", "cell2", "chunk2", F.expr("cell = cell2 AND chunk = chunk2").alias("same"))
    )
    work = stage(work, "chunk-pairs")
    right = trees.toDF("g", "cell2", "chunk2", "keys2", "weight2", "x2", "node2")
    # A pair of one chunk with itself needs its tree only once.
    alone = work.where("same").join(trees, ["g", "cell", "chunk"])
    pairs = work.where("NOT same").join(trees, ["g", "cell", "chunk"]).join(right, ["g", "cell2", "chunk2"])
    names = ["same", "keys", "weight", "x", "node"]
    run, found = _traversal(cosine, store), "a binary, links long, b binary"
    links = stage(
        alone.select(*names).mapInArrow(run, found)
        .unionByName(pairs.select(*names, "keys2", "weight2", "x2", "node2").mapInArrow(run, found)),
        "links",
    )

    counts = links.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    classes = connected(links.select("a", "b"))
    named = distinct.select("key", "weight", "first")
    member = classes.withColumnRenamed("node", "key").join(named, "key")
    least = stage(member.groupBy("label").agg(F.min("first").alias("least")), "least")
    joined = lookup(stage(member.select("key", "label"), "members"), least, ["label"]).select("key", "least")
    known = stage(
        named.join(counts, "key", "left").join(joined, "key", "left").select(
            "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("least", "first").alias("component_id"),
        ),
        "answers",
    )
    out = lookup(stage(whole.select("vec_id", "key"), "keys"), known, ["key"])
    none = rows.where("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        out.select("vec_id", "n_links", "component_id").unionByName(none)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
