"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are projected to a few dimensions by a Gaussian (2-stable) matrix. The
square of a projected distance divided by that of the true one follows a
chi-square law, so projected neighbours taken in order can stop as soon as a
point that far out would, with probability ``confidence``, not be nearer than the
k-th neighbour verified so far.

A kd-tree over the projected space cuts the vectors into cells. Its upper part comes
from a sample of all vectors, the lower part of each large cell from a sample of that
cell, made in a task. Each query is answered first in its own cell; its k-th distance
there names the cells that the stopping test still allows, and those are searched
next. Inside a cell a kd-tree of its own gives the neighbours in order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from loadpanel.scale import materialize, row_bound

PROJECTED = 8
CONFIDENCE = 0.995
# Rows wanted in a cell, and at most (on average) in a block.
CELL_ROWS = 4096
BLOCK_ROWS = 8192
# The upper splits come from at most so many rows, the first in a fixed pseudo-random order, the lower ones of a cell from
# about so many of its rows; a split is made of this many sampled rows at least.
SAMPLE_ROWS, CELL_SAMPLE, SPLIT_ROWS = 20_000, 4096, 16
LEAF_ROWS = 64
# Queries that one task answers from one block.
QUERY_ROWS = 4096
SEED = 17


def chi_square(x: float, m: int) -> float:
    """Distribution function of the chi-square law with an even number of degrees of freedom."""
    terms = (math.exp(i * math.log(x / 2) - math.lgamma(i + 1) - x / 2) if x > 0 else float(i == 0) for i in range(m // 2))
    return 1.0 - sum(terms)


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 10.0 * m + 100.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < p else (low, mid)
    return high


def projection(dims: int, m: int = PROJECTED) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dims, m))


def _projected(x: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    # Row by row in the same order, so that equal vectors are projected to equal points.
    return np.einsum("ij,jk->ik", x, matrix)


@dataclass(frozen=True)
class Cells:
    """The upper kd-tree: in node i a point goes left if its ``axis[i]`` is at most ``cut[i]``."""

    axis: np.ndarray
    cut: np.ndarray
    depth: int

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            right = points[np.arange(len(points)), self.axis[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


def split_cells(sample: np.ndarray, depth: int) -> Cells:
    axis, cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    parts = {0: sample}
    for node in range((1 << depth) - 1):
        part = parts.pop(node)
        if len(part):
            axis[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            cut[node] = float(np.median(part[:, axis[node]]))
        right = part[:, axis[node]] > cut[node]
        parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
    return Cells(axis, cut, depth)


def kd_leaves(points: np.ndarray, leaf: int = LEAF_ROWS) -> list[np.ndarray]:
    """The leaves of a kd-tree over the points, as row numbers."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        part = points[rows]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        order = rows[np.argpartition(part[:, axis], len(rows) // 2)]
        todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return out


def box_distances(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of a point from boxes."""
    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
    return (gap * gap).sum(axis=1)


class Block:
    """Vectors of one block with a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        leaves = kd_leaves(points)
        order = np.concatenate(leaves)
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.bounds = np.concatenate([[0], np.cumsum([len(x) for x in leaves])])
        starts = self.bounds[:-1]
        self.low = np.minimum.reduceat(self.points, starts, axis=0)
        self.high = np.maximum.reduceat(self.points, starts, axis=0)

    def search(self, own: int, vector: np.ndarray, point: np.ndarray, k: int, quantile: float, radius: float):
        """The ids and distances of the k nearest that the stopping test lets through, none beyond ``radius``."""
        ids, found = np.zeros(0, np.int64), np.zeros(0)
        away = box_distances(self.low, self.high, point)
        kth = radius
        for leaf in np.argsort(away, kind="stable"):
            # Rounding must not part a point from its equals.
            reach = quantile * kth * kth * (1 + 1e-9) + 1e-12
            if away[leaf] > reach:
                break
            a, b = self.bounds[leaf], self.bounds[leaf + 1]
            gap = self.points[a:b] - point
            rows = a + np.flatnonzero(((gap * gap).sum(axis=1) <= reach) & (self.ids[a:b] != own))
            if not len(rows):
                continue
            gap = self.vectors[rows] - vector
            distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            near = distance <= kth
            ids = np.concatenate([ids, self.ids[rows[near]]])
            found = np.concatenate([found, distance[near]])
            if len(ids) > k:
                best = np.lexsort((ids, found))[:k]
                ids, found = ids[best], found[best]
            if len(ids) == k:
                kth = min(kth, float(found.max()))
        return ids, found


_POINT = "vec_id long, vector array<double>, point array<double>, cell int"
# A cell is named by its place in the upper tree, and in the lower one.
CELL = ["cell", "sub"]


def _lower_splits(cell_rows: int):
    """The lower tree of one cell, from its sampled points."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(pdf["point"].to_numpy())
        wanted = math.ceil(math.log2(pdf["held"].iloc[0] / cell_rows))
        found = split_cells(points, max(0, min(wanted, int(math.log2(max(1, len(points) / SPLIT_ROWS))))))
        return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "axis": [found.axis], "cut": [found.cut], "depth": [found.depth]})

    return run


def _with_sub(points: DataFrame) -> DataFrame:
    """The points with ``sub``, their place in the lower tree of their cell; 0 in cells that are not large."""
    held = points.groupBy("cell").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > BLOCK_ROWS)
    large = materialize(held, "neighbour-large")  # at most a row for each cell of the upper tree
    if not row_bound(large):
        return points.withColumn("sub", F.lit(0))
    every = F.ceil(F.col("held") / CELL_SAMPLE)
    sample = points.join(F.broadcast(large), "cell").filter(F.pmod(F.xxhash64(F.monotonically_increasing_id()), every) == 0)
    splits = sample.groupBy("cell").applyInPandas(_lower_splits(CELL_ROWS), "cell int, axis array<long>, cut array<double>, depth int")
    lower = {r["cell"]: Cells(np.array(r["axis"], np.int64), np.array(r["cut"]), r["depth"]) for r in splits.collect()}

    @F.pandas_udf("int")
    def place(cell: pd.Series, point: pd.Series) -> pd.Series:
        out, cells = np.zeros(len(cell), np.int32), cell.to_numpy()
        for c in np.unique(cells).tolist():
            if c in lower and lower[c].depth:
                rows = np.flatnonzero(cells == c)
                out[rows] = lower[c].of(np.stack(point.to_numpy()[rows]))
        return pd.Series(out)

    return materialize(points.withColumn("sub", place("cell", "point")), "neighbour-points")


def _place(matrix: np.ndarray, cells: Cells):
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
            points = _projected(x, matrix)
            yield pd.DataFrame(
                {"vec_id": pdf["vec_id"], "vector": list(x), "point": list(points), "cell": cells.of(points).astype(np.int32)}
            )

    return run


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a finite vector that is not zero, of the table's usual length."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"))
    return rows.filter(
        F.col("vec_id").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda x: x != 0)
    )


def _boxes(points: DataFrame, m: int) -> list:
    lows = [F.min(F.col("point")[i]).alias(f"l{i}") for i in range(m)]
    highs = [F.max(F.col("point")[i]).alias(f"h{i}") for i in range(m)]
    # One row for each cell of about CELL_ROWS vectors.
    return points.groupBy(*CELL).agg(F.count(F.lit(1)).alias("held"), *lows, *highs).collect()


def _search(k: int, quantile: float):
    def run(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(data) and len(asked):
            block = Block(data["vec_id"].to_numpy(), np.stack(data["vector"]), np.stack(data["point"]))
            for q, v, p, r in zip(asked["query_id"], asked["vector"], asked["point"], asked["radius"]):
                ids, found = block.search(int(q), np.asarray(v), np.asarray(p), k, quantile, float(r))
                out.append(pd.DataFrame({"query_id": np.int64(q), "vec_id": ids, "score": found}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return run


def _answers(blocks: DataFrame, visits: DataFrame, k: int, quantile: float) -> DataFrame:
    """The nearest of each visited block; a block that many queries visit is searched by several tasks."""
    visits = materialize(visits, "neighbour-visits")
    tasks = visits.groupBy(*CELL, "block").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("tasks"))
    tasks = materialize(tasks, "neighbour-tasks")
    data = blocks.join(tasks, [*CELL, "block"]).withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
    asked = visits.join(tasks, [*CELL, "block"]).withColumn("task", F.pmod(F.xxhash64("query_id"), F.col("tasks")).cast("int"))
    asked = asked.select(*[F.col(c).alias(f"to_{c}") for c in (*CELL, "block", "task")], "query_id", "vector", "point", "radius")
    found = (
        data.select(*CELL, "block", "task", "vec_id", "vector", "point")
        .groupBy(*CELL, "block", "task")
        .cogroup(asked.groupBy("to_cell", "to_sub", "to_block", "to_task"))
        .applyInPandas(_search(k, quantile), "query_id long, vec_id long, score double")
    )
    return materialize(found, "neighbour-found")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _allowed(boxes: list, m: int, quantile: float, home: bool):
    """Expands queries to the blocks they visit: all of their own cell, or those of others within reach."""
    low = np.array([[r[f"l{i}"] for i in range(m)] for r in boxes])
    high = np.array([[r[f"h{i}"] for i in range(m)] for r in boxes])
    cell, sub = (np.array([r[c] for r in boxes]) for c in CELL)
    blocks = np.array([-(-r["held"] // BLOCK_ROWS) for r in boxes])

    def run(batches):
        for pdf in batches:
            for q, v, p, own, lower, radius in zip(*(pdf[c] for c in ("query_id", "vector", "point", *CELL, "radius"))):
                own = (cell == own) & (sub == lower)
                if home:
                    rows = np.flatnonzero(own)
                else:
                    away = box_distances(low, high, np.asarray(p))
                    rows = np.flatnonzero((away <= quantile * radius * radius * (1 + 1e-9) + 1e-12) & ~own)
                if not len(rows):
                    continue
                cells, subs = np.repeat(cell[rows], blocks[rows]), np.repeat(sub[rows], blocks[rows])
                numbers = np.concatenate([np.arange(n) for n in blocks[rows]])
                yield pd.DataFrame(
                    {"cell": cells, "sub": subs, "block": numbers, "query_id": q, "vector": [v] * len(cells), "point": [p] * len(cells), "radius": radius}
                )

    return run


_VISIT = "cell int, sub int, block int, query_id long, vector array<double>, point array<double>, radius double"


def nearest_neighbours(
    vectors: DataFrame, asked: Column, k: int = 10, confidence: float = CONFIDENCE, m: int = PROJECTED
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each row for which ``asked`` holds.

    Score is the Euclidean distance of the original vectors; ties go to the smaller
    vec_id. All other rows are candidates. Rows without an id, and vectors that are
    null, empty, zero, of another length than most, or hold a null or a value that
    is not finite take no part. A row that repeats a vec_id is a candidate of its
    own, and never one for its own id; of a repeated query the smallest vector is
    asked. Other columns are not looked at. With fewer candidates than k, all of them.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = _usable(vectors)
    usual = usable.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if usual is None:
        return empty
    usable = usable.filter(F.size("vector") == usual["dims"])
    matrix = projection(usual["dims"], m)
    most = int(math.log2(max(1, SAMPLE_ROWS / SPLIT_ROWS)))
    depth = min(most, max(0, math.ceil(math.log2(usual["count"] / CELL_ROWS))))
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vector").collect()
    cells = split_cells(_projected(np.array([r["vector"] for r in sample]), matrix), depth)
    points = _with_sub(materialize(usable.mapInPandas(_place(matrix, cells), _POINT), "neighbour-points"))
    boxes = _boxes(points, m)
    # Vectors that no cut parts, or of a cell that its sample shows too small, are dealt out inside their cell.
    counts = spark.createDataFrame([(r["cell"], r["sub"], -(-r["held"] // BLOCK_ROWS)) for r in boxes], "cell int, sub int, blocks long")
    number = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    blocks = points.join(F.broadcast(counts), CELL).withColumn("block", number).drop("blocks")

    quantile = chi_square_quantile(confidence, m)
    queries = points.filter(asked).groupBy("vec_id").agg(F.min(F.struct("vector", "point", *CELL)).alias("q"))
    queries = queries.select(F.col("vec_id").alias("query_id"), "q.*", F.lit(float("inf")).alias("radius"))
    queries = materialize(queries, "neighbour-queries")
    if not row_bound(queries):
        return empty
    at_home = _answers(blocks, queries.mapInPandas(_allowed(boxes, m, quantile, home=True), _VISIT), k, quantile)
    # The k-th distance at home bounds the search elsewhere; with fewer than k found there is no bound.
    kth = _nearest(at_home, k).groupBy("query_id").agg(F.max("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    bound = F.when(F.col("n") == k, F.col("kth")).otherwise(F.lit(float("inf")))
    further = queries.drop("radius").join(kth, "query_id", "left").withColumn("radius", bound).drop("kth", "n")
    elsewhere = _answers(blocks, further.mapInPandas(_allowed(boxes, m, quantile, home=False), _VISIT), k, quantile)
    best = _nearest(at_home.unionByName(elsewhere), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
