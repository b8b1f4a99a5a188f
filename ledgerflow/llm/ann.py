"""Approximate nearest neighbours by stable projections and kd-trees.

Unit vectors are projected to a few dimensions by a Gaussian (2-stable) matrix,
so that a squared projected distance over the squared true distance follows a
chi-square law. The projected rows are cut into cells of a top kd-tree (fitted
on a bounded sample), and each cell is indexed by a kd-tree of its own. A
query walks projected neighbours outwards, verifies true similarities leaf by
leaf, and stops once the chi-square test says that a nearer row is unlikely to
lie further out.

Two rounds: each query searches its own cell first; its k-th similarity then
decides by the same test which other cells it still has to visit.

Defined cases: null, zero or non-finite vectors (also null components) and
vectors of another length than the most frequent one take no part; equal
vectors are indexed once with their ``k + 1`` smallest ids, which is all a top-k
can name; ties go to the smaller id; fewer candidates than k give fewer rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import stash

PROJECTED = 8
CONFIDENCE = 0.98
LEAF_ROWS = 48
# Rows of the sample that the top of the tree is fitted on, and rows a cell should hold.
SAMPLE_ROWS = 20_000
CELL_ROWS = 20_000
# Queries that meet one cell in one task; more are cut into blocks, each with its own copy of the cell.
BLOCK_QUERIES = 20_000


def stable_matrix(dims: int, projected: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, projected))


def chi_square_bound(confidence: float, degrees: int) -> float:
    """x with P(chi-square of so many degrees <= x) = confidence; even degrees have a closed sum."""
    half = degrees // 2
    def cdf(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, half):
            term *= x / 2 / i
            total += term
        return 1.0 - math.exp(-x / 2) * total
    low, high = 0.0, 200.0 + 10 * degrees
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < confidence else (low, mid)
    return high


def kd_leaves(points: np.ndarray, leaf_rows: int) -> list[np.ndarray]:
    """Row numbers of each leaf: cells are halved at the median of their widest dimension."""
    leaves, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        if len(rows) <= leaf_rows:
            leaves.append(rows)
            continue
        p = points[rows]
        dim = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
        half = len(rows) // 2
        order = np.argpartition(p[:, dim], half)
        stack += [rows[order[:half]], rows[order[half:]]]
    return leaves


class KdIndex:
    """Leaves of a kd-tree over projected points, with their bounding boxes."""

    def __init__(self, ids: np.ndarray, units: np.ndarray, projected: np.ndarray, leaf_rows: int = LEAF_ROWS):
        leaves = kd_leaves(projected, leaf_rows)
        self.low = np.array([projected[r].min(axis=0) for r in leaves])
        self.high = np.array([projected[r].max(axis=0) for r in leaves])
        self.ids = [ids[r] for r in leaves]
        self.units = [units[r] for r in leaves]

    def search(self, unit: np.ndarray, projected: np.ndarray, k: int, bound: float, own: int,
               worst: float = np.inf) -> list[tuple[float, int]]:
        """The k best (similarity, id) found; ``worst``: squared distance that is known to be reachable."""
        gap = np.maximum(np.maximum(self.low - projected, projected - self.high), 0.0)
        reach = np.einsum("ij,ij->i", gap, gap)
        best: list[tuple[float, int]] = []  # heap of (similarity, -id), worst first
        for leaf in np.argsort(reach, kind="stable"):
            if reach[leaf] > bound * worst:
                break  # chi-square test: nothing nearer is likely to lie this far out
            similar = self.units[leaf] @ unit
            for s, i in zip(similar.tolist(), self.ids[leaf].tolist()):
                if i == own:
                    continue
                entry = (s, -i)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                worst = min(worst, max(0.0, 2.0 - 2.0 * best[0][0]) + 1e-12)
        return [(s, -i) for s, i in best]


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector): finite non-zero vectors of the most frequent length, as doubles."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(v.isNotNull() & F.col("vec_id").isNotNull())
            .filter(F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)))
    sizes = good.groupBy(F.size(v).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    top = sizes.orderBy(F.desc("rows"), F.asc("n")).limit(1).collect()
    return good.filter(F.size(v) == (top[0]["n"] if top else 0))


def _top_tree(sample: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Split dimension and value of each inner node (heap order) and the depth of the top tree."""
    depth = max(0, math.ceil(math.log2(max(1, cells))))
    dims, values = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
    parts = {1: sample}
    for node in range(1, 1 << depth):
        p = parts.pop(node)
        if len(p):
            dims[node] = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            values[node] = float(np.median(p[:, dims[node]]))
        right = p[:, dims[node]] > values[node]
        parts[2 * node], parts[2 * node + 1] = p[~right], p[right]
    return dims, values, depth


def _cells_of(projected: np.ndarray, dims: np.ndarray, values: np.ndarray, depth: int) -> np.ndarray:
    node = np.ones(len(projected), np.int64)
    for _ in range(depth):
        node = 2 * node + (projected[np.arange(len(projected)), dims[node]] > values[node])
    return node - (1 << depth)


def nearest_neighbours(index_rows: DataFrame, query_rows: DataFrame, id_col: str = "vec_id",
                       vector_col: str = "embedding", k: int = 5, projected: int = PROJECTED,
                       confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query row by cosine."""
    index, queries = (valid_vectors(r, id_col, vector_col) for r in (index_rows, query_rows))
    # A top-k names at most k + 1 of equal vectors (one may be the query itself).
    same = Window.partitionBy("vector").orderBy("vec_id")
    index = index.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1).drop("n")
    index = stash(index, "ann-index")
    total = index.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return index.sparkSession.createDataFrame([], schema)
    share = min(1.0, SAMPLE_ROWS / total)
    sample = index.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share * 1_000_000)
    vectors = np.array([r["vector"] for r in sample.select("vector").collect() or [index.first()]])
    matrix = stable_matrix(vectors.shape[1], projected)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cells = max(1, round(total / CELL_ROWS))
    dims, values, depth = _top_tree(units @ matrix, cells)
    n_cells = 1 << depth
    bound = chi_square_bound(confidence, projected)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.array(batch.column(1).to_pylist())
            p = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ matrix
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p.tolist(), pa.list_(pa.float64())),
                 pa.array(_cells_of(p, dims, values, depth).astype(np.int32))], ["vec_id", "vector", "projected", "cell"])

    placed_schema = "vec_id long, vector array<double>, projected array<double>, cell int"
    placed = stash(index.mapInArrow(place, placed_schema), "ann-placed")
    asked = stash(queries.mapInArrow(place, placed_schema), "ann-queries")
    axis = range(projected)
    boxes = placed.groupBy("cell").agg(
        *[F.min(F.col("projected")[i]).alias(f"l{i}") for i in axis],
        *[F.max(F.col("projected")[i]).alias(f"h{i}") for i in axis]).collect()  # one row a cell
    box_cell = np.array([b["cell"] for b in boxes], np.int64)
    box_low = np.array([[b[f"l{i}"] for i in axis] for b in boxes])
    box_high = np.array([[b[f"h{i}"] for i in axis] for b in boxes])

    def search(key, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asks):
            v = np.array(rows["vector"].tolist())
            tree = KdIndex(rows["vec_id"].to_numpy(), v / np.linalg.norm(v, axis=1, keepdims=True),
                           np.array(rows["projected"].tolist()))
            for i, q, p, w in zip(asks["vec_id"], asks["vector"], asks["projected"], asks["worst"]):
                q = np.asarray(q)
                out += [(i, j, s) for s, j in tree.search(q / np.linalg.norm(q), np.asarray(p), k, bound, i, w)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found_schema = "query_id long, vec_id long, score double"

    blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    indexed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def visit(asks: DataFrame) -> DataFrame:
        asks = asks.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        return asks.groupBy("cell", "block").cogroup(indexed.groupBy("cell", "block")).applyInPandas(
            lambda key, a, r: search(key, r, a), found_schema)

    first = visit(asked.withColumn("worst", F.lit(float("inf"))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    if n_cells > 1:
        first = stash(first, "ann-first")
        reached = (first.withColumn("n", F.row_number().over(best)).filter(F.col("n") == k)
                   .select(F.col("query_id").alias("vec_id"), (F.greatest(2 - 2 * F.col("score"), F.lit(0.0)) + 1e-12).alias("worst")))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    p = np.array(row.column(2)[0].as_py())
                    gap = np.maximum(np.maximum(box_low - p, p - box_high), 0.0)
                    go = (np.einsum("ij,ij->i", gap, gap) <= bound * row.column(4)[0].as_py()) & (
                        box_cell != row.column(3)[0].as_py())
                    n = int(go.sum())
                    if n:
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(row.column(0)[0], n), pa.array([row.column(1)[0].as_py()] * n, pa.list_(pa.float64())),
                             pa.array([p.tolist()] * n, pa.list_(pa.float64())),
                             pa.array(box_cell[go].astype(np.int32)), pa.repeat(row.column(4)[0], n)],
                            ["vec_id", "vector", "projected", "cell", "worst"])

        onward = (asked.join(reached, "vec_id", "left")
                  .withColumn("worst", F.coalesce(F.col("worst"), F.lit(float("inf"))))
                  .select("vec_id", "vector", "projected", "cell", "worst")
                  .mapInArrow(route, placed_schema + ", worst double"))
        first = first.unionByName(visit(onward))
    # Scores anew from the original vectors, in double precision.
    ranked = first.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 3)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    q, c = F.col("q"), F.col("c")
    exact = (ranked.join(asked.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q")), "query_id")
             .join(placed.select("vec_id", F.col("vector").alias("c")), "vec_id")
             .select("query_id", "vec_id", (dot(q, c) / (F.sqrt(dot(q, q)) * F.sqrt(dot(c, c)))).alias("score")))
    return (exact.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
