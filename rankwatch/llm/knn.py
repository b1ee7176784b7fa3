"""Exact top-k by inner product: a Voronoi kNN join.

Vectors are lifted to one sphere (a data vector gets the component that makes all norms equal,
a query gets 0), so the highest inner product is the nearest neighbour and distances obey the
triangle inequality. Data rows belong to the cell of their nearest pivot. Cell summaries (row
count, smallest and largest distance to the pivot, the distances of the k + 1 nearest rows)
bound how far a query's k-th neighbour can be. A query is first solved in its home cell; the
k-th score found there, or the summary bound if that is better, decides by the radius of
each cell and by the plane between pivots which other cells can hold a neighbour, and only
there is it sent. What is replicated are queries: they are the smaller side, so data rows
move once.

Cells are cut into blocks of bounded size by a hash of the id, and queries that meet in a block
into chunks, so neither a cell that holds a third of the data nor one that all queries need
becomes one task.

Components become floor(scale * x) as double; sums are exact below 2 ** 53. Vectors that are
null, empty, or hold a null or non-finite component take no part, nor do rows without an id.
Vectors of different lengths do not meet: each length is searched on its own, one after the
other. Rows equal in id and vector count once; a query never
finds its own id. Fewer candidates than k give fewer rows. Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwatch.llm.common import stage

K = 20
SCALE = 64
MOST_PIVOTS = 256
BLOCK_ROWS = 4096
CHUNK_QUERIES = 8192


def whole_vectors(df: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) as packed doubles, of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key is None or not vector.is_valid or not len(vector.values):
                    continue
                if vector.values.null_count:
                    continue
                v = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(v).all():
                    ids.append(key)
                    out.append(v.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "v"]
            )

    narrow = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return narrow.mapInArrow(run, "vec_id long, v binary")


def _matrix(column) -> np.ndarray:
    rows = [np.frombuffer(v, np.float64) for v in column]
    return np.stack(rows) if rows else np.zeros((0, 0))


@dataclass
class Cells:
    pivots: np.ndarray
    lift: np.ndarray  # the pivots' added component
    top: float  # the common squared norm
    count: np.ndarray | None = None
    near: np.ndarray | None = None  # distance of the nearest row to its pivot
    far: np.ndarray | None = None
    nearest: np.ndarray | None = None  # the k + 1 smallest distances, infinite where missing

    def data_distances(self, x: np.ndarray) -> np.ndarray:
        added = np.sqrt(np.maximum(self.top - (x**2).sum(axis=1), 0.0))
        inner = x @ self.pivots.T + added[:, None] * self.lift
        return np.sqrt(np.maximum(2 * self.top - 2 * inner, 0.0))

    def query_distances(self, q: np.ndarray) -> np.ndarray:
        square = (q**2).sum(axis=1)[:, None] + self.top - 2 * (q @ self.pivots.T)
        return np.sqrt(np.maximum(square, 0.0))

    def reach(self, d: np.ndarray, k: int) -> np.ndarray:
        """A distance within which k rows other than the query's own surely are."""
        out = np.empty(len(d))
        for i, row in enumerate(d):
            bounds = (row[:, None] + self.nearest).ravel()
            out[i] = np.partition(bounds, k)[k] if len(bounds) > k else np.inf
        return out

    def needed(self, d: np.ndarray, home: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Which cells can hold a row within reach; rounding is allowed for."""
        room = (reach * (1 + 1e-9) + 1e-4)[:, None]
        possible = (self.count > 0) & (d - self.far <= room) & (self.near - d <= room)
        own = d[np.arange(len(d)), home][:, None]
        between = np.sqrt(
            np.maximum(
                2 * self.top - 2 * (self.pivots[home] @ self.pivots.T + np.outer(self.lift[home], self.lift)),
                0.0,
            )
        )
        plane = np.where(between > 1e-9, (d**2 - own**2) / np.maximum(2 * between, 1e-9), 0.0)
        return possible & (plane <= room)


def _summaries(data: DataFrame, cells: Cells, k: int) -> None:
    """Fill in what the bounds need: k + 1 numbers per cell."""
    stats = data.groupBy("cell").agg(F.count("*").alias("n"), F.min("d").alias("near"), F.max("d").alias("far"))
    p = len(cells.pivots)
    cells.count, cells.near, cells.far = np.zeros(p, np.int64), np.full(p, np.inf), np.full(p, -np.inf)
    for r in stats.collect():
        cells.count[r["cell"]], cells.near[r["cell"]], cells.far[r["cell"]] = r["n"], r["near"], r["far"]

    # The k + 1 smallest distances of every cell, per task before they meet.
    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for c in np.unique(cell).tolist():
                both = np.concatenate([best.get(c, np.zeros(0)), d[cell == c]])
                best[c] = np.sort(both)[: k + 1]
        for c, v in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), c, np.int32)), pa.array(v)], ["cell", "d"])

    few = data.select("cell", "d").mapInArrow(smallest, "cell int, d double")
    rank = Window.partitionBy("cell").orderBy("d")
    rows = few.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= k + 1).collect()
    cells.nearest = np.full((p, k + 1), np.inf)
    for r in rows:
        cells.nearest[r["cell"], r["r"] - 1] = r["d"]


def _solve(requests: DataFrame, data: DataFrame, cells: Cells, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the k best rows per query and block, none below the bound.

    `requests` has (query_id, v, cell, bound); it is read twice: stage it first."""
    spark = data.sparkSession
    asked = {r["cell"]: r["n"] for r in requests.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    # One row per cell: bounded by the number of pivots.
    sizes = spark.createDataFrame(
        [
            (c, max(1, -(-int(n) // BLOCK_ROWS)), max(1, -(-asked.get(c, 0) // CHUNK_QUERIES)))
            for c, n in enumerate(cells.count.tolist())
        ],
        "cell int, blocks int, chunks int",
    )
    sizes = F.broadcast(sizes)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        requests.join(sizes, "cell")
        .withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
        .select("query_id", "v", "bound", "cell", "chunk", every("blocks").alias("block"))
    )
    right = (
        data.join(sizes, "cell")
        .where(F.col("cell").isin(list(asked)) if len(asked) < len(cells.count) else F.lit(True))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        .select("vec_id", "v", "cell", "block", every("chunks").alias("chunk"))
    )

    def best(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(rows):
            return pd.DataFrame({n: np.zeros(0, np.int64) for n in names})
        x, ids = _matrix(rows["v"]), rows["vec_id"].to_numpy()
        parts = []
        for at in range(0, len(queries), 1024):
            some = queries.iloc[at : at + 1024]
            own = some["query_id"].to_numpy()
            s = _matrix(some["v"]) @ x.T
            s[own[:, None] == ids] = -np.inf
            low = some["bound"].to_numpy()
            if s.shape[1] > k:
                low = np.maximum(low, np.partition(s, -k, axis=1)[:, -k])
            i, j = np.nonzero((s >= low[:, None]) & (s > -np.inf))
            value = s[i, j]
            order = np.lexsort((ids[j], -value, i))
            i, j, value = i[order], j[order], value[order]
            first = np.searchsorted(i, i)
            keep = np.arange(len(i)) - first < k
            parts.append(
                pd.DataFrame({"query_id": own[i[keep]], "vec_id": ids[j[keep]], "score": value[keep].astype(np.int64)})
            )
        return pd.concat(parts)

    keys = ["cell", "block", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        best, "query_id long, vec_id long, score long"
    )


def search(
    vectors: DataFrame, is_query: Column, k: int = K, most_pivots: int = MOST_PIVOTS, scale: float = SCALE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query row.

    `is_query` is a condition on vec_id."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, scale).dropDuplicates(["vec_id", "v"])
    rows = stage(rows.withColumn("n", F.length("v")), "vectors")
    lengths = [r["n"] for r in rows.groupBy("n").count().collect()]
    found = [_search(rows.where(F.col("n") == n).drop("n"), is_query, k, most_pivots) for n in sorted(lengths)]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, found)


def _search(rows: DataFrame, is_query: Column, k: int, most_pivots: int) -> DataFrame:
    """The answers among vectors of one length."""
    spark = rows.sparkSession

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, n = 0.0, 0
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist())
            if len(x):
                most, n = max(most, float((x**2).sum(axis=1).max())), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([most]), pa.array([n])], ["top", "n"])

    found = rows.select("v").mapInArrow(norms, "top double, n long").agg(
        F.max("top").alias("top"), F.sum("n").alias("n")
    ).first()
    # Pivots: rows drawn by hash, about the root of their number, at most `most_pivots`.
    wanted = int(min(most_pivots, max(4, found["n"] ** 0.5)))
    drawn = rows.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(wanted).collect()
    pivots = np.unique(_matrix([r["v"] for r in drawn]), axis=0)
    top = float(found["top"])
    cells = Cells(pivots, np.sqrt(np.maximum(top - (pivots**2).sum(axis=1), 0.0)), top)
    sent = spark.sparkContext.broadcast(cells)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = sent.value.data_distances(_matrix(batch.column(1).to_pylist()))
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                ["vec_id", "v", "cell", "d"],
            )

    data = stage(rows.select("vec_id", "v").mapInArrow(to_cells, "vec_id long, v binary, cell int, d double"), "cells")
    _summaries(data, cells, k)
    known = spark.sparkContext.broadcast(cells)

    def ask_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column(1).to_pylist())
            d = known.value.query_distances(q)
            reach = known.value.reach(d, k) + 1e-4
            # The score that belongs to the distance, rounded down.
            bound = np.floor(((q**2).sum(axis=1) + known.value.top - reach**2) / 2 - 1)
            occupied = np.where(known.value.count > 0, d, np.inf)
            home = occupied.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home.astype(np.int32)), pa.array(bound)],
                ["query_id", "v", "cell", "bound"],
            )

    kinds = "query_id long, v binary, cell int, bound double"
    queries = data.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    at_home = stage(queries.mapInArrow(ask_home, kinds), "home-requests")
    first = stage(_solve(at_home, data, cells, k), "home-results")

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    kth = (
        first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k)
        .select("query_id", F.col("score").cast("double").alias("kth"))
    )

    def ask_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column(1).to_pylist())
            home, bound = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            d = known.value.query_distances(q)
            square = (q**2).sum(axis=1) + known.value.top - 2 * bound
            reach = np.sqrt(np.maximum(square, 0.0))
            need = known.value.needed(d, home, reach)
            need[np.arange(len(q)), home] = False
            i, j = np.nonzero(need)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(i)), batch.column(1).take(pa.array(i)), pa.array(j.astype(np.int32)), pa.array(bound[i])],
                ["query_id", "v", "cell", "bound"],
            )

    tighter = at_home.join(kth, "query_id", "left").select(
        "query_id", "v", "cell", F.greatest("bound", "kth").alias("bound")
    )
    elsewhere = stage(tighter.mapInArrow(ask_others, kinds), "other-requests")
    both = first.unionByName(_solve(elsewhere, data, cells, k))
    return (
        both.withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
