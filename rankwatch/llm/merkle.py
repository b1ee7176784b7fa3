"""Merkle manifest of a dataset: a tree of digests per language and one over the languages.

`H` is the lowercase hex SHA-256 of its inputs written one after the other, digests as hex text.
A row's leaf is H over its fields, each `-` if null, else its UTF-8 byte count, a colon and the
value. The leaves of a language ascend by id; every `FAN` neighbouring nodes become their H while
there is more than one node (the last run may be shorter). What is left is the language's
subroot, and the subroots, in order of the language (null first, then by UTF-8 bytes), give the
root the same way.

1. One pass over the rows computes the leaf and, for tampered rows, the leaf of the text with
   A-Z lower-cased; texts are neither shuffled nor read again.
2. Leaves are numbered per language: a range partitioning on (language, id, leaf, place in the
   staged file), a running number inside partitions, and offsets from the counts. A language or
   an id that holds most rows is spread like any other; rows equal in everything too.
3. Aligned subtrees of height `HEIGHT` (4,096 leaves) are blocks, one row each. A block keeps its
   nodes in a van Emde Boas layout: the tree is split at half height, the top part stored first
   and the subtrees below it one after the other, recursively. `addresses` says where a node
   lies, for building and for finding siblings. The roots of the blocks are the leaves of the
   next tier of blocks, so a tier is 4,096 times smaller than the one before.
4. Proofs go down the same tiers: a block's row gets the siblings above its root from the block
   that holds it as a leaf, and at the bottom each leaf meets its block's row. A group is a
   block, at most 4,096 rows, whatever the sizes of the languages.

Odd input: null fields are `-`; rows without an id come first in their language and are never
tampered; rows that share an id are ordered by leaf; equal rows are leaves of their own; an empty
table gives no row and the root is None; extra columns are ignored, whatever their names. A
text's length matters only to the pass that hashes it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwatch.llm.common import rows_in_parts, stage

FAN = 8
HEIGHT = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A task numbers about this many leaves.
ROWS_PER_PART = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree_height(n: int) -> int:
    """Levels of runs above `n` leaves."""
    h = 0
    while FAN**h < n:
        h += 1
    return h


def addresses(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where the nodes `index` of a level lie in the layout of a whole tree of `levels` levels."""
    at = np.zeros(len(index), np.int64)
    index = np.asarray(index, np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = levels - top
        span = FAN ** (depth - top)
        subtree = index // span
        at += (FAN**top - 1) // (FAN - 1) + subtree * ((FAN**below - 1) // (FAN - 1))
        index = index - subtree * span
        depth, levels = depth - top, below
    return at


def _sizes(n: int, height: int) -> list[int]:
    """Nodes per level, from the root's level down to the leaves'."""
    sizes = [n]
    for _ in range(height):
        sizes.append(-(-sizes[-1] // FAN))
    return sizes[::-1]


def layout(leaves: list[bytes], height: int) -> bytes:
    """All nodes of a subtree over the given leaves, 32 bytes each, in their places."""
    levels = height + 1
    nodes = np.zeros(((FAN**levels - 1) // (FAN - 1), 32), np.uint8)
    row = leaves
    for depth in range(height, -1, -1):
        where = addresses(depth, np.arange(len(row)), levels)
        nodes[where] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, 32)
        hexes = [x.hex() for x in row]
        row = [
            hashlib.sha256("".join(hexes[i : i + FAN]).encode()).digest() for i in range(0, len(hexes), FAN)
        ]
    return nodes.tobytes()


def level(nodes: bytes, n: int, height: int, depth: int) -> list[str]:
    """The nodes of one level, as hex text, read from their places."""
    where = addresses(depth, np.arange(_sizes(n, height)[depth]), height + 1)
    text = np.frombuffer(nodes, np.uint8).reshape(-1, 32)[where].tobytes().hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def siblings(nodes: bytes, n: int, height: int, wanted: list[int]) -> list[str]:
    """For some leaves, the siblings at every level up to the block's root: `left,right` per
    level, each ended by a semicolon."""
    above = [""]
    for depth in range(1, height + 1):
        row = level(nodes, n, height, depth)
        at = range(len(row)) if depth < height else wanted
        above = [
            f"{''.join(row[i - i % FAN : i])},{''.join(row[i + 1 : i - i % FAN + FAN])};{above[i // FAN]}"
            for i in at
        ]
    return above if height else [""] * len(wanted)


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and its siblings give."""
    for step in path.split(";")[:-1]:
        left, right = step.split(",")
        leaf = hashlib.sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(text: Column) -> Column:
    fields = [_field(text if c == "text" else F.col(c)) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*fields), 256))


def tampered_rows(doc_id: Column) -> Column:
    """The rows whose text is altered: 3 divides the CRC-32 of the id as decimal text."""
    return F.crc32(doc_id.cast("string")) % 3 == 0


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, g, leaf, tampered, place): one row per document, without its text. `g` orders
    languages, null first; `tampered` is the altered text's leaf where the row is altered."""
    text = F.col("text").cast("string")
    lang = F.col("lang").cast("string")
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("g"),
        leaf_digest(text).alias("leaf"),
        F.when(tampered_rows(F.col("doc_id")), leaf_digest(F.translate(text, _UPPER, _LOWER))).alias("tampered"),
        F.monotonically_increasing_id().alias("place"),
    )


def _count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each `g` in a partition sorted by it."""
    part = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column("g").dictionary_encode()
        codes = column.indices.to_numpy()
        heads = np.flatnonzero(np.diff(codes, prepend=-1))
        starts = np.repeat(heads, np.diff(np.append(heads, n)))
        number = np.arange(n) - starts
        first = column.dictionary[int(codes[0])].as_py()
        if first == last:
            number[: heads[1] if len(heads) > 1 else n] += seen
        last, seen = column.dictionary[int(codes[-1])].as_py(), int(number[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, part), pa.int32()), pa.array(number, pa.int64())],
            [*batch.schema.names, "part", "number"],
        )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The staged rows with `pos` (from 0 in each `g`, by `order`) and `n`, the rows of the `g`."""
    spark = rows.sparkSession
    parts = rows_in_parts(spark, rows.count(), ROWS_PER_PART)
    by = [F.col("g"), *[F.col(c).asc_nulls_first() for c in order]]
    ranged = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    counted = stage(ranged.mapInArrow(_count_up, f"{names}, part int, number long"), "numbered")
    sizes = stage(counted.groupBy("g", "part").agg(F.count(F.lit(1)).alias("rows")), "numbered-sizes")
    whole = sizes.groupBy("g").agg(F.sum("rows").alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("g", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    offsets = stage(offsets.join(whole, "g"), "numbered-offsets")
    return counted.join(offsets, ["g", "part"]).select(
        *rows.columns, (F.col("number") + F.col("before")).alias("pos"), "n"
    )


_BLOCK = "g string, block long, n long, height int, count int, root binary, nodes binary"


def _builder(most: int):
    """One block from its leaves; `most` is the height of a whole block."""

    def run(rows: pa.Table) -> pa.Table:
        order = rows.column("pos").combine_chunks().to_numpy().argsort(kind="stable")
        digests = rows.column("leaf").to_pylist()
        n = rows.column("n")[0].as_py()
        height = min(most, tree_height(n))
        nodes = layout([digests[i] for i in order], height)
        return pa.table({
            "g": pa.array([rows.column("g")[0].as_py()], pa.string()),
            "block": pa.array([rows.column("pos")[0].as_py() // FAN**most], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "height": pa.array([height], pa.int32()),
            "count": pa.array([len(order)], pa.int32()),
            "root": pa.array([nodes[:32]], pa.binary()),
            "nodes": pa.array([nodes], pa.binary()),
        })

    return run


def _block(height: int) -> Column:
    return F.floor(F.col("pos") / FAN**height)


def _finished(height: int) -> Column:
    return F.col("n") <= FAN**height


def _grow(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Tiers of blocks over numbered leaves (g, pos, n, leaf). A `g` whose leaves fit in one block
    is finished; the others' block roots are the leaves of the next tier."""
    tiers, row = [], leaves.select("g", "pos", "n", "leaf")
    while True:
        grouped = row.groupBy("g", _block(height).alias("_b"))
        blocks = stage(grouped.applyInArrow(_builder(height), _BLOCK), f"blocks-{len(tiers)}")
        tiers.append(blocks)
        more = blocks.where(~_finished(height))
        if not more.limit(1).count():
            return tiers
        row = more.select(
            "g", F.col("block").alias("pos"), F.ceil(F.col("n") / FAN**height).alias("n"), F.col("root").alias("leaf")
        )


def _descend(leaves: DataFrame, blocks: DataFrame, height: int) -> DataFrame:
    """(g, pos, path, subroot) of leaves (g, pos) whose blocks know what is above them."""
    leaves_per_block = FAN**height

    def run(own: pa.Table, held: pa.Table) -> pa.Table:
        block = held.to_pylist()[0]
        pos = own.column("pos").to_pylist()
        at = [p % leaves_per_block for p in pos]
        paths = siblings(block["nodes"], block["count"], block["height"], at)
        return pa.table({
            "g": own.column("g"),
            "pos": own.column("pos"),
            "path": pa.array([p + block["path"] for p in paths], pa.string()),
            "subroot": pa.array([block["subroot"]] * len(pos), pa.string()),
        })

    left = leaves.select("g", "pos", _block(height).alias("block")).groupBy("g", "block")
    held = blocks.groupBy("g", "block")
    return left.cogroup(held).applyInArrow(run, "g string, pos long, path string, subroot string")


def _hung(tiers: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The lowest tier's blocks with `path`, the siblings above their root, and `subroot`;
    `above` has (g, path, subroot) of whole trees."""
    known = None
    for t in range(len(tiers) - 1, -1, -1):
        blocks = tiers[t]
        hung = blocks.where(_finished(height)).join(above, "g")
        if known is not None:
            inner = _descend(blocks.where(~_finished(height)).select("g", F.col("block").alias("pos")), known, height)
            inner = inner.withColumnRenamed("pos", "block")
            hung = hung.unionByName(blocks.join(inner, ["g", "block"]))
        known = stage(hung, f"hung-{t}")
    return known


@dataclass
class Manifest:
    """Numbered leaves, the tiers of blocks over them and over the languages, and the root."""

    leaves: DataFrame  # (doc_id, g, leaf, tampered, place, pos, n)
    tiers: list[DataFrame]
    subroots: DataFrame  # (g, leaf, pos, n), with g empty and `lang` the language's key
    top: list[DataFrame]
    root: str | None
    height: int  # of a whole block


def build(docs: DataFrame, height: int = HEIGHT) -> Manifest:
    """Hash, number and join the rows to trees; everything is staged."""
    rows = stage(hashed(docs), "leaves")
    leaves = stage(numbered(rows, ["doc_id", "leaf", "place"]), "leaves-numbered")
    tiers = _grow(leaves, height)
    ends = [
        b.where(_finished(height)).select(F.lit("").alias("g"), F.col("g").alias("lang"), F.col("root").alias("leaf"))
        for b in tiers
    ]
    whole = reduce(DataFrame.unionByName, ends)
    subroots = stage(numbered(stage(whole, "subroots"), ["lang"]), "subroots-numbered")
    top = _grow(subroots, height)
    last = top[-1].where(_finished(height)).select("root").first()
    return Manifest(leaves, tiers, subroots, top, bytes(last["root"]).hex() if last else None, height)


def prove(manifest: Manifest, whole: bool = False) -> DataFrame:
    """One row per leaf: its siblings up to the root as a digest (`whole`: and as text), and the
    root that the row as it may have been altered gives with them.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified[, proof]); `proof` lists
    `left,right` siblings per level, each level ended by a semicolon.
    """
    height = manifest.height
    ground = manifest.top[-1].where(_finished(height)).select("g", F.lit("").alias("path"), F.lit("").alias("subroot"))
    langs = _descend(manifest.subroots, _hung(manifest.top, ground, height), height).select("pos", "path")
    above = stage(
        manifest.subroots.join(langs, "pos").select(F.col("lang").alias("g"), "path", F.lower(F.hex("leaf")).alias("subroot")),
        "paths-languages",
    )
    hung = _hung(manifest.tiers, above, height)
    leaves_per_block = FAN**height

    def run(own: pa.Table, held: pa.Table) -> pa.Table:
        block = held.to_pylist()[0]
        at = [p % leaves_per_block for p in own.column("pos").to_pylist()]
        paths = [p + block["path"] for p in siblings(block["nodes"], block["count"], block["height"], at)]
        leaf = [x.hex() for x in own.column("leaf").to_pylist()]
        shown = [o if t is None else t.hex() for o, t in zip(leaf, own.column("tampered").to_pylist(), strict=True)]
        out = {
            "doc_id": own.column("doc_id"),
            "leaf": pa.array(leaf, pa.string()),
            "subroot": pa.array([block["subroot"]] * len(at), pa.string()),
            "proof_sha256": pa.array([digest(p.replace(",", "").replace(";", "")) for p in paths], pa.string()),
            "folded_root": pa.array([fold(x, p) for x, p in zip(shown, paths, strict=True)], pa.string()),
        }
        if whole:
            out["proof"] = pa.array(paths, pa.string())
        return pa.table(out)

    kind = manifest.leaves.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string"
    left = manifest.leaves.select("doc_id", "g", "leaf", "tampered", "pos", _block(height).alias("block"))
    found = left.groupBy("g", "block").cogroup(hung.groupBy("g", "block")).applyInArrow(
        run, fields + ", proof string" * whole
    )
    root = F.lit(manifest.root).cast("string")
    return found.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"), *["proof"] * whole,
    )
