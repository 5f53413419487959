"""Approximate nearest neighbours by cosine: stable projections in kd-trees.

Vectors of length one are projected on ``PROJECTED`` random directions with
normal coefficients; the squared projected distance of two vectors, divided by
their squared distance, then follows a chi-square distribution with as many
degrees of freedom.  A query meets the leaves of a kd-tree over the projections
in the order of their distance and verifies the members on the original
vectors.  It stops when the next leaf is so far that a vector nearer than the
current k-th neighbour would be projected that far with a chance of at most
``1 - CONFIDENCE``.

The upper levels of the tree, fitted on a bounded sample, deal all rows over
cells, and every cell's own tree is built by the task that searches it.  A query first
searches the cell that it lies in; the distance found there decides, by the
same test, which other cells it has to visit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm.store import written

K = 5
PROJECTED = 8
CONFIDENCE = 0.95
LEAF = 32
CELL_ROWS = 8192
SAMPLE_ROWS = 20_000
QUERY_BLOCK = 4096


def chi_square_quantile(p: float, degrees: int) -> float:
    """The quantile of the chi-square distribution with an even number of degrees of freedom."""
    def cdf(x: float) -> float:
        term = total = 1.0
        for k in range(1, degrees // 2):
            term *= x / 2 / k
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def directions(size: int, projected: int = PROJECTED) -> np.ndarray:
    return np.random.default_rng(17).standard_normal((size, projected))


@dataclass
class Tree:
    """Leaves of a kd-tree: the rows in order of leaves, where each begins, and their boxes."""

    rows: np.ndarray
    begins: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distances from a point to all boxes."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


def build_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Splits at the median of the widest side until at most ``leaf`` points are left."""
    leaves, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        spread = np.ptp(points[rows], axis=0)
        if len(rows) <= leaf or not spread.any():
            leaves.append(rows)
            continue
        half = len(rows) // 2
        order = np.argpartition(points[rows, int(np.argmax(spread))], half)
        todo += [rows[order[half:]], rows[order[:half]]]
    begins = np.concatenate([[0], np.cumsum([len(r) for r in leaves])])
    return Tree(np.concatenate(leaves), begins, np.stack([points[r].min(axis=0) for r in leaves]), np.stack([points[r].max(axis=0) for r in leaves]))


@dataclass
class Cells:
    """The upper levels: split planes as arrays, leaves are cells."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def find(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        while (inner := at >= 0).any():
            node = at[inner]
            go = points[inner, self.axis[node]] < self.cut[node]
            at[inner] = np.where(go, self.left[node], self.right[node])
        return -at - 1


def fit_cells(sample: np.ndarray, cells: int) -> Cells:
    """Median splits of the sample; a child below 0 is the cell ``-child - 1``."""
    axis, cut, left, right, low, high = [], [], [], [], [], []
    size = sample.shape[1]

    def grow(rows: np.ndarray, depth: int, lo: np.ndarray, hi: np.ndarray) -> int:
        spread = np.ptp(sample[rows], axis=0) if len(rows) else np.zeros(size)
        if 2**depth >= cells or not spread.any():
            low.append(lo)
            high.append(hi)
            return -len(low)
        side = int(np.argmax(spread))
        values = np.unique(sample[rows, side])
        middle = float(values[min(len(values) - 1, max(1, int(np.searchsorted(values, np.median(sample[rows, side])))))])
        node = len(axis)
        for column, value in ((axis, side), (cut, middle), (left, 0), (right, 0)):
            column.append(value)
        below, above = hi.copy(), lo.copy()
        below[side] = above[side] = middle
        inside = sample[rows, side] < middle
        left[node] = grow(rows[inside], depth + 1, lo, below)
        right[node] = grow(rows[~inside], depth + 1, above, hi)
        return node

    grow(np.arange(len(sample)), 0, np.full(size, -np.inf), np.full(size, np.inf))
    if not axis:  # one cell: a plane that everything lies right of
        axis, cut, left, right = [0], [-np.inf], [-1], [-1]
    return Cells(*map(np.array, (axis, cut, left, right, low, high)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosine(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal rows get equal values wherever they stand."""
    return (many * one).sum(axis=1) / (np.sqrt((many * many).sum(axis=1)) * np.sqrt((one * one).sum()))


def _nearest(query: np.ndarray, own: int, seed: float, projected: np.ndarray, tree: Tree, points: np.ndarray, vectors: np.ndarray, ids: np.ndarray, quantile: float, k: int) -> list[tuple[float, int]]:
    """The best of one cell: leaves in order of projected distance, until the test holds."""
    reach = tree.distances(projected)
    order = np.argsort(reach, kind="stable")
    best: list[tuple[float, int]] = []
    worst = seed  # squared distance of the k-th neighbour so far
    for at in range(0, len(order), 8):
        if reach[order[at]] > quantile * worst:
            break
        rows = np.concatenate([tree.rows[tree.begins[i] : tree.begins[i + 1]] for i in order[at : at + 8]])
        rows = rows[ids[rows] != own]
        scores = cosine(query, vectors[rows])
        best = sorted([*best, *zip((-scores).tolist(), ids[rows].tolist())])[:k]
        if len(best) == k:
            worst = min(worst, max(0.0, 2 + 2 * best[-1][0]))
    return best


def usable(vector: Column) -> Column:
    """Not null, and all components given and finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(embeddings: DataFrame, is_query: Column, k: int = K, ident: str = "vec_id", vector: str = "embedding", projected: int = PROJECTED, confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of every query row, its own id left out.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do null ids.  Rows with the same id and vector count once.  All
    vectors need the same length; ties go to the smaller id.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(ident).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"), is_query.alias("query"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    # Of rows with the same vector only the k + 1 smallest ids can be asked for.
    copies = Window.partitionBy("v").orderBy("id")
    kept = written(rows.select("id", "v").distinct().withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1).select("id", "v"), "vectors")
    first = kept.select("v").first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    matrix = directions(len(first["v"]), projected)
    quantile = chi_square_quantile(confidence, projected)
    total = kept.count()
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    sample = kept.where(share * total <= SAMPLE_ROWS).select("v").limit(2 * SAMPLE_ROWS).toArrow()
    cells = fit_cells(unit(_matrix(sample["v"])) @ matrix, max(1, -(-total // CELL_ROWS)))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = cells.find(unit(_matrix(batch.column("v"))) @ matrix) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(found)], ["id", "v", "cell"])

    where = "id long, v array<double>, cell long"
    index = written(kept.mapInArrow(locate, where), "vector-cells")
    queries = rows.where("query").select("id", "v").distinct()
    home = queries.mapInArrow(locate, where).withColumn("seed", F.lit(4.0))

    def search(asked: pa.Table, members: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "v": [], "vec_id": [], "score": []}
        schema = pa.schema([("query_id", pa.int64()), ("v", pa.list_(pa.float64())), ("vec_id", pa.int64()), ("score", pa.float64())])
        if asked.num_rows and members.num_rows:
            vectors, ids = _matrix(members["v"]), members["id"].to_numpy()
            points = unit(vectors) @ matrix
            tree = build_tree(points)
            wanted = _matrix(asked["v"])
            near = unit(wanted) @ matrix
            for i, (own, seed) in enumerate(zip(asked["id"].to_pylist(), asked["seed"].to_pylist())):
                for score, ident_ in _nearest(wanted[i], own, seed, near[i], tree, points, vectors, ids, quantile, k):
                    out["query_id"].append(own)
                    out["v"].append(wanted[i])
                    out["vec_id"].append(ident_)
                    out["score"].append(-score)
        return pa.Table.from_pydict(out, schema)

    found_schema = "query_id long, v array<double>, vec_id long, score double"

    def visit(asked: DataFrame) -> DataFrame:
        """Queries meet their cell in blocks, so that a popular cell is searched by several tasks."""
        blocks = asked.groupBy("cell").agg(F.floor((F.count(F.lit(1)) - 1) / QUERY_BLOCK).alias("most"))
        per_cell = asked.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("most") + 1)).drop("most")
        spread = index.join(blocks, "cell").select("id", "v", "cell", F.explode(F.sequence(F.lit(0).cast("long"), "most")).alias("block"))
        return per_cell.groupBy("cell", "block").cogroup(spread.groupBy("cell", "block")).applyInArrow(search, found_schema)

    at_home = written(visit(home), "at-home")
    known = at_home.groupBy("query_id", "v").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    bound = F.when(F.col("n") >= k, F.greatest(F.lit(0.0), 2 - 2 * F.col("least"))).otherwise(F.lit(4.0))
    seeds = home.join(known, (F.col("id") == F.col("query_id")) & home["v"].eqNullSafe(known["v"]), "left").select("id", home["v"], "cell", F.coalesce(bound, F.lit(4.0)).alias("seed"))

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = unit(_matrix(batch.column("v"))) @ matrix
            rows_, cells_ = [], []
            for i, (point, own, seed) in enumerate(zip(points, batch.column("cell").to_pylist(), batch.column("seed").to_pylist())):
                gap = np.maximum(np.maximum(cells.low - point, point - cells.high), 0)
                go = np.flatnonzero((gap * gap).sum(axis=1) <= quantile * seed)
                go = go[go != own]
                rows_.append(np.full(len(go), i))
                cells_.append(go)
            rows_ = pa.array(np.concatenate(rows_))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows_), batch.column("v").take(rows_), pa.array(np.concatenate(cells_)), batch.column("seed").take(rows_)], ["id", "v", "cell", "seed"])

    elsewhere = visit(seeds.mapInArrow(onward, where + ", seed double"))
    every = at_home.unionByName(elsewhere)
    order = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    best = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
