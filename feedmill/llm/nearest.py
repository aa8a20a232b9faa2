"""Approximate nearest neighbours in a low-dimensional stable projection.

Vectors are projected by Gaussian weights to a few dimensions. The squared projected
distance of two vectors, divided by their squared distance, is chi-square distributed with
as many degrees of freedom. So a search walks the projected neighbours of a query in
ascending order, measures each on the original vectors, and stops as soon as the chance
that a better one still comes is small: when the chi-square probability of the projected
distance reached, over the k-th best distance found, is at least ``confidence``.

The projected vectors are cut into cells of even size by the top of a kd-tree that is
fitted on a bounded sample; every cell indexes its vectors in a kd-tree of its own. A query
first searches its own cell. Its k-th best distance there gives, by the same test, the
projected radius beyond which no other cell need be asked.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmill.session import cut

DIMENSIONS = 12
CONFIDENCE = 0.95
LEAF = 128
# Vectors a cell on average, and vectors of the sample that places the cells.
CELL = 4096
SAMPLE = 20_000
# Queries that one task takes from a cell at once.
QUERY_BLOCK = 512
SEED = 5


# --- projection and test ---------------------------------------------------------

def projection(size: int, dimensions: int, seed: int = SEED) -> np.ndarray:
    """Gaussian weights (size, dimensions)."""
    return np.random.default_rng([seed, size]).standard_normal((size, dimensions))


def chi_square(x: np.ndarray | float, dimensions: int) -> np.ndarray | float:
    """Cumulative probability for an even number of degrees of freedom."""
    half = np.asarray(x, dtype=np.float64) / 2
    term = np.ones_like(half)
    total = np.ones_like(half)
    for k in range(1, dimensions // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_point(probability: float, dimensions: int) -> float:
    """Where the cumulative probability reaches ``probability``."""
    low, high = 0.0, 1.0
    while chi_square(high, dimensions) < probability:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dimensions) < probability else (low, middle)
    return high


# --- kd-trees --------------------------------------------------------------------

class Cells:
    """The top of the tree: boxes of the projected space, from medians of a sample."""

    def __init__(self, sample: np.ndarray, count: int):
        self.dimensions = sample.shape[1]
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, value, below, above; axis -1: cell number in below
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self._build(sample, count, np.full(self.dimensions, -np.inf), np.full(self.dimensions, np.inf))

    def _build(self, points: np.ndarray, count: int, low: np.ndarray, high: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0.0, len(self.boxes), 0))
        axis = int(np.argmax(points.max(axis=0) - points.min(axis=0))) if len(points) > 1 else 0
        value = float(np.median(points[:, axis])) if len(points) > 1 else 0.0
        below = points[:, axis] < value
        if count < 2 or len(points) < 2 or not below.any():
            self.boxes.append((low, high))
            return at
        left_high, right_low = high.copy(), low.copy()
        left_high[axis] = right_low[axis] = value
        left = self._build(points[below], count // 2, low, left_high)
        right = self._build(points[~below], count - count // 2, right_low, high)
        self.nodes[at] = (axis, value, left, right)
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of every point."""
        out = np.zeros(len(points), dtype=np.int64)
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            axis, value, left, right = self.nodes[node]
            if axis < 0:
                out[rows] = left
            elif len(rows):
                below = points[rows, axis] < value
                stack += [(left, rows[below]), (right, rows[~below])]
        return out

    def within(self, point: np.ndarray, radius: float) -> np.ndarray:
        """The cells that a ball touches."""
        low = np.array([b[0] for b in self.boxes])
        high = np.array([b[1] for b in self.boxes])
        gap = np.maximum(0, np.maximum(low - point, point - high))
        return np.nonzero((gap * gap).sum(axis=1) <= radius)[0]


class Tree:
    """A kd-tree over the projected vectors of a cell; equal vectors split by place."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int, np.ndarray, np.ndarray]] = []
        self._build(0, len(points))

    def _build(self, start: int, stop: int) -> int:
        at = len(self.nodes)
        rows = self.order[start:stop]
        low, high = self.points[rows].min(axis=0), self.points[rows].max(axis=0)
        self.nodes.append((start, stop, -1, -1, low, high))
        if stop - start > LEAF:
            axis = int(np.argmax(high - low))
            middle = (stop - start) // 2
            self.order[start:stop] = rows[np.argpartition(self.points[rows, axis], middle)]
            left = self._build(start, start + middle)
            right = self._build(start + middle, stop)
            self.nodes[at] = (start, stop, left, right, low, high)
        return at

    def nearest(self, query: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Groups of rows in ascending projected distance: no later group has a row nearer
        than the last of an earlier one. Yields squared projected distances and rows."""
        def gap(node: int) -> float:
            _, _, _, _, low, high = self.nodes[node]
            d = np.maximum(0, np.maximum(low - query, query - high))
            return float(d @ d)

        heap: list[tuple[float, int]] = [(gap(0), 0)]
        far = np.empty(0)
        rows = np.empty(0, dtype=np.int64)
        while heap:
            _, node = heapq.heappop(heap)
            start, stop, left, right, _, _ = self.nodes[node]
            if left >= 0:
                heapq.heappush(heap, (gap(left), left))
                heapq.heappush(heap, (gap(right), right))
            else:
                own = self.order[start:stop]
                d = self.points[own] - query
                far = np.concatenate([far, (d * d).sum(axis=1)])
                rows = np.concatenate([rows, own])
            bound = heap[0][0] if heap else np.inf
            ready = far <= bound
            if ready.any() and (ready.sum() >= LEAF or not heap or left < 0):
                part = np.argsort(far[ready], kind="stable")
                yield far[ready][part], rows[ready][part]
                far, rows = far[~ready], rows[~ready]


def search(tree: Tree, vectors: np.ndarray, ids: list[np.ndarray], query: np.ndarray, projected: np.ndarray, own: int,
           k: int, confidence: float, bound: float) -> list[tuple[float, int]]:
    """The k best (distance, id) of a cell, walked until the test holds; none farther than
    ``bound``, the k-th best distance known from elsewhere."""
    dimensions = tree.points.shape[1]
    best: list[tuple[float, int]] = []
    limit = bound
    for far, rows in tree.nearest(projected):
        if far[0] > 0 and limit < np.inf and (limit == 0 or chi_square(far[0] / (limit * limit), dimensions) >= confidence):
            break
        delta = vectors[rows] - query
        exact = np.sqrt((delta * delta).sum(axis=1))
        near = exact <= limit
        for d, row in zip(exact[near].tolist(), rows[near].tolist(), strict=True):
            best += [(d, i) for i in ids[row].tolist() if i != own]
        best = sorted(best)[:k]
        if len(best) == k:
            limit = min(limit, best[-1][0])
    return best


# --- the search as Spark jobs ----------------------------------------------------

def clean_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v, in double precision, of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE, cell: int = CELL, sample: int = SAMPLE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query, nearest first.

    ``is_query`` is a condition on ``id``. Distances are Euclidean, in double precision on
    the original vectors; ties go to the smaller id. A query never finds its own id; with
    fewer than k candidates it finds them all. Null vectors, those with a null, infinite or
    NaN component and those of zeros only take no part, nor do rows with a null id; vectors
    of another length are compared with their own kind alone. Repeated rows are candidates
    each, and queries once. An empty table gives no rows.

    Equal vectors are one entry with their k + 1 smallest ids, which loses nothing: so a
    vector that very many rows share is indexed once. Cells hold some thousands of entries
    however many rows there are, and a query reaches only the cells within its radius.
    """
    spark = vectors.sparkSession
    rows = clean_vectors(vectors, id_col, vector_col)
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    entries = rows.withColumn("n", place).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = cut(entries.withColumn("size", F.size("v")), "entries")
    sizes = {r["size"]: r["n"] for r in entries.groupBy("size").agg(F.count("*").alias("n")).collect()}
    out = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], out)
    cells: dict[int, Cells] = {}
    for size, n in sizes.items():
        share = min(1_000_000, 1 + 2 * sample * 1_000_000 // n)
        some = entries.where((F.col("size") == size) & (F.pmod(F.xxhash64("v"), F.lit(1_000_000)) < share)).select("v").limit(sample).collect()
        points = np.array([r["v"] for r in some]) @ projection(size, dimensions)
        cells[size] = Cells(points, max(1, -(-n // cell)))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.zeros(len(batch), dtype=np.int64)
            for size in batch["size"].unique():
                mine = np.nonzero(batch["size"].to_numpy() == size)[0]
                points = np.stack(batch["v"].iloc[mine].to_list()) @ projection(int(size), dimensions)
                at[mine] = cells[int(size)].of(points)
            yield batch.assign(cell=at)

    indexed = cut(entries.mapInPandas(placed, "v array<double>, ids array<long>, size int, cell long"), "cells")
    asked = rows.where(is_query).dropDuplicates(["id", "v"]).withColumn("size", F.size("v"))
    # An id that stands for several vectors is one query for each of them.
    queries = cut(asked.mapInPandas(
        lambda batches: placed(batches), "id long, v array<double>, size int, cell long"), "queries")
    found = "query_id long, v array<double>, size int, cell long, ids array<long>, scores array<double>"

    def searched(key: tuple, index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(asked):
            size = int(asked["size"].iloc[0])
            weights = projection(size, dimensions)
            if len(index):
                stored = np.stack(index["v"].to_list())
                tree = Tree(stored @ weights)
                ids = [np.asarray(x) for x in index["ids"]]
            for query, v, home, bound in zip(asked["id"], asked["v"], asked["cell"], asked["bound"], strict=True):
                best = search(tree, stored, ids, v, v @ weights, int(query), k, confidence, bound) if len(index) else []
                rows.append((query, v, size, home, [i for _, i in best], [d for d, _ in best]))
        return pd.DataFrame(rows, columns=["query_id", "v", "size", "cell", "ids", "scores"])

    def meet(queries: DataFrame, at: str) -> DataFrame:
        # Many queries of one cell are dealt out in blocks, each with the cell's entries.
        blocks = queries.groupBy("size", at).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
        left = indexed.join(blocks.withColumnRenamed(at, "cell"), ["size", "cell"]).select(
            "v", "ids", "size", F.col("cell").alias("at"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        right = queries.join(blocks, ["size", at]).select(
            "id", "v", "size", "cell", "bound", F.col(at).alias("at"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
        return left.groupBy("size", "at", "block").cogroup(right.groupBy("size", "at", "block")).applyInPandas(searched, found)

    first = cut(meet(queries.withColumn("home", F.col("cell")).withColumn("bound", F.lit(float("inf"))), "home"), "first")
    point = chi_square_point(confidence, dimensions)

    def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for query, v, size, home, scores in zip(*(batch[c] for c in ("query_id", "v", "size", "cell", "scores")), strict=True):
                bound = scores[-1] if len(scores) >= k else np.inf
                for other in cells[int(size)].within(v @ projection(int(size), dimensions), point * bound * bound):
                    if other != home:
                        rows.append((query, v, size, home, other, bound))
            yield pd.DataFrame(rows, columns=["id", "v", "size", "cell", "next", "bound"])

    more = meet(first.mapInPandas(further, "id long, v array<double>, size int, cell long, next long, bound double"), "next")
    pairs = first.unionByName(more).select("query_id", "v", F.explode(F.arrays_zip("scores", "ids")).alias("x")).select(
        "query_id", "v", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id", "v").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
