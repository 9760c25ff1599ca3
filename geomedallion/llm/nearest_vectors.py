"""Operator 6: nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

A Gaussian projection to ``m`` dimensions turns a distance ``d`` into ``d * sqrt(chi2_m)``. Vectors are
indexed by a kd-tree over their projections. A query takes tree leaves in the order of their projected
distance ``r`` and verifies their vectors on all dimensions; it stops when ``r**2 / d_k**2`` reaches the
``CONFIDENCE`` quantile of chi-square, ``d_k`` being its k-th best distance: a vector nearer than that
would have shown up with that probability. Every reported distance is exact.

Distribution: the upper levels of the tree, fitted on a bounded sample, cut the projected space into
cells; a cell with more than ``CELL_ROWS`` vectors is split at random into parts, and each (cell, part)
is a group with its own lower tree. Queries first search their own cell, which bounds ``d_k``, and then
go to the cells that the stopping test cannot exclude. Queries too many for one group go in blocks: a cell has as
many as the queries really sent there ask for, and its vectors are copied for those blocks alone.

Of equal vectors only the ``k + 1`` smallest ids can ever be among a query's k nearest, so the rest is
not indexed; Spark applies that limit before the shuffle, so a vector that a third of all rows share is
no hot key. The limit loses nothing: answers are the same as with all rows indexed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomedallion.llm.common import materialise

DIMS = 8  # even, for the closed form of the chi-square distribution
CONFIDENCE = 0.99
CELL_ROWS = 16_384
QUERY_BLOCK = 2_048
SAMPLE = 65_536  # vectors that the upper tree is fitted on, 16 for each of MAX_CELLS cells
MAX_CELLS = 4_096
LEAF = 48
SEED = 20_240_229


def chi2_quantile(p: float, dims: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""
    low, high = 0.0, 1_000.0
    for _ in range(200):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
        low, high = (x, high) if 1 - tail < p else (low, x)
    return high


def projection(dim: int, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, dims))


def top_tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Split dimension and threshold of each inner node (node i has children 2i+1 and 2i+2)."""
    split, at = np.zeros(2**depth - 1, int), np.zeros(2**depth - 1)
    rows = {0: points}
    for i in range(2**depth - 1):
        own = rows.pop(i)
        if len(own):
            split[i] = int((own.max(0) - own.min(0)).argmax())
            at[i] = np.median(own[:, split[i]])
        right = own[:, split[i]] > at[i]
        rows[2 * i + 1], rows[2 * i + 2] = own[~right], own[right]
    return split, at


def cell_of(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    split, at = tree
    node = np.zeros(len(points), int)
    for _ in range(int(math.log2(len(split) + 1))):
        node = 2 * node + 1 + (points[np.arange(len(points)), split[node]] > at[node])
    return node - len(split)


class KdTree:
    """Tree over projections whose leaves hold ranges of a row order."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.low, self.high, self.kids, self.span = [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            own = points[self.order[a:b]]
            node = len(self.kids)
            self.low.append(own.min(0)), self.high.append(own.max(0)), self.kids.append([]), self.span.append((a, b))
            if parent >= 0:
                self.kids[parent].append(node)
            spread = self.high[node] - self.low[node]
            if b - a > LEAF and spread.max() > 0:
                mid = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(own[:, int(spread.argmax())], mid)]
                todo += [(a, a + mid, node), (a + mid, b, node)]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def leaves(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared projected distance, rows) of the leaves, nearest first."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        reach = (gap * gap).sum(1)
        heap = [(reach[0], 0)]
        while heap:
            r, node = heapq.heappop(heap)
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(heap, (reach[kid], kid))
            else:
                yield float(r), self.order[slice(*self.span[node])]


def search_group(queries: pd.DataFrame, rows: pd.DataFrame, k: int, stop: float) -> pd.DataFrame:
    """Each query's k best among ``rows`` that are no farther than its ``bound``."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if len(queries) and len(rows):
        x, ids = np.stack(rows["v"]).astype(float), rows["vec_id"].to_numpy()
        tree = KdTree(np.stack(rows["p"]).astype(float))
        for qid, v, p, bound in zip(queries["vec_id"], queries["v"], queries["p"], queries["bound"]):
            v = np.asarray(v, float)
            best_d, best_i, limit = np.zeros(0), np.zeros(0, ids.dtype), float(bound)
            for reach, own in tree.leaves(np.asarray(p, float)):
                if reach > stop * limit * limit:
                    break
                gap = x[own] - v
                d = np.sqrt((gap * gap).sum(1))
                near = (d <= limit) & (ids[own] != qid)
                if near.any():
                    best_d, best_i = np.concatenate([best_d, d[near]]), np.concatenate([best_i, ids[own][near]])
                    if len(best_d) > k:
                        first = np.lexsort((best_i, best_d))[:k]
                        best_d, best_i = best_d[first], best_i[first]
                    if len(best_d) == k:
                        limit = min(limit, float(best_d.max()))
            out["query_id"] += [qid] * len(best_d)
            out["vec_id"] += best_i.tolist()
            out["score"] += best_d.tolist()
    return pd.DataFrame(out)


def usable(v: Column) -> Column:
    """No null, infinite or missing component, and not the zero vector."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
    dims: int = DIMS, confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest other vectors, exact distances, ties to smaller ids.

    ``is_query`` is a condition on the column ``vec_id``. Vectors that are not usable take no part,
    nor do those of another length than most, nor rows without an id. Of rows that share an id the least vector
    counts. A query with fewer than k candidates gets all of them; an empty table gives no rows.
    Other columns are not read.
    """
    v = F.col(f"`{embedding}`").cast("array<double>")
    base = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    sizes = base.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = int(sizes["n"])
    base = materialise(base.filter(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v")))
    total = base.count()
    matrix = projection(dim, dims)

    depth = max(0, math.ceil(math.log2(max(min(total / cell_rows, MAX_CELLS), 1))))
    sample = base.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("v").collect() if depth else []  # SAMPLE rows
    tree = top_tree(np.array([r["v"] for r in sample]).reshape(-1, dim) @ matrix, depth)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1)
            flat = values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            p = flat @ matrix
            cells = cell_of(p, tree)
            offsets = pa.array(np.arange(len(p) + 1, dtype=np.int32) * dims, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), values, pa.ListArray.from_arrays(offsets, pa.array(p.ravel())), pa.array(cells, pa.int32())], names=["vec_id", "v", "p", "cell"]
            )

    schema = "vec_id long, v array<double>, p array<double>, cell int"
    same = Window.partitionBy("v").orderBy("vec_id")
    indexed = base.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).select("vec_id", "v")
    index = materialise(indexed.mapInArrow(project, schema))
    queries = materialise(base.filter(is_query).select("vec_id", "v").mapInArrow(project, schema))

    bounds = [f(F.col("p")[i]).alias(f"{name}{i}") for i in range(dims) for name, f in (("low", F.min), ("high", F.max))]
    cells = {r["cell"]: r for r in index.groupBy("cell").agg(F.count("*").alias("n"), *bounds).collect()}  # <= MAX_CELLS rows
    parts = {c: -(-r["n"] // cell_rows) for c, r in cells.items()}
    names = sorted(cells)
    low = np.array([[cells[c][f"low{i}"] for i in range(dims)] for c in names])
    high = np.array([[cells[c][f"high{i}"] for i in range(dims)] for c in names])
    stop = chi2_quantile(confidence, dims)

    n_parts = F.broadcast(vectors.sparkSession.createDataFrame(list(parts.items()) or [(0, 1)], "cell int, n_parts int"))  # <= MAX_CELLS rows
    stored = index.join(n_parts, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("n_parts")).cast("int")).drop("n_parts")
    key = ["cell", "part", "block"]

    def search(asked: DataFrame) -> DataFrame:
        """``asked``: queries with the cell to search and the ``bound`` known so far."""
        asked = materialise(asked)
        blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(query_block)).cast("int").alias("blocks"))  # <= MAX_CELLS rows
        sent = asked.join(F.broadcast(blocks), "cell").join(n_parts, "cell").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))).drop("blocks", "n_parts")
        wanted = blocks.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        held = stored.join(F.broadcast(wanted), "cell")  # a vector is copied for the blocks of its cell alone
        run = lambda q, r: search_group(q, r, k, stop)
        return sent.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(run, "query_id long, vec_id long, score double")

    home = F.when(F.array_contains(F.lit(names), F.col("cell")), F.col("cell"))
    first = materialise(search(queries.withColumn("cell", home).filter(F.col("cell").isNotNull()).withColumn("bound", F.lit(float("inf")))))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    kth = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            limit = batch.column(4).to_numpy(zero_copy_only=False)
            row, to = [], []
            for i in range(len(p)):
                gap = np.maximum(np.maximum(low - p[i], p[i] - high), 0)
                for j in np.flatnonzero((gap * gap).sum(1) <= stop * limit[i] * limit[i]):
                    if names[j] != batch.column(3)[i].as_py():
                        row.append(i), to.append(names[j])
            picked = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(picked), batch.column(1).take(picked), batch.column(2).take(picked), pa.array(to, pa.int32()), batch.column(4).take(picked)],
                names=["vec_id", "v", "p", "cell", "bound"],
            )

    known = queries.join(kth, queries["vec_id"] == kth["query_id"], "left").select("vec_id", "v", "p", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    found = first
    if len(names) > 1:
        found = first.union(search(known.mapInArrow(route, schema + ", bound double")))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
