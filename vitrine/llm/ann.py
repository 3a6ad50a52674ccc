"""Approximate nearest neighbours by largest inner product, over stable random projections.

Vectors are lifted by one coordinate so that the largest inner product is the least distance, and
projected to a few dimensions by a Gaussian matrix.  There the squared distance of two vectors, over
their true squared distance, follows a chi-square law.  The projected points are indexed by a
kd-tree: its upper part, fitted on a bounded sample, deals all vectors to cells; inside a cell a
worker builds the lower part down to leaves.  A query visits leaves by rising projected distance and
verifies their vectors in double precision, until the chi-square test says that a vector as near as
the worst one kept would have shown up before, save with a small chance.  It first visits its own
cell and then all cells that the distance found there cannot rule out by the same test.
"""

from __future__ import annotations

from functools import lru_cache
from math import exp, factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import partitions, stored

#: Projected dimensions (even), chance that a nearer vector is missed, sample that fits the cells.
DIMENSIONS, MISS, SAMPLE = 8, 0.02, 20_000
#: Vectors of a block that a task indexes, queries that visit it at once, and vectors of a leaf.
BLOCK, QUERIES, LEAF = 20_000, 2_000, 128
#: Distances from queries to cells that a task works out at once.
GAPS = 1 << 20


@lru_cache(maxsize=8)
def chi_square_quantile(chance: float, dims: int) -> float:
    """The value that a chi-square variable of an even number of degrees exceeds with ``1 - chance``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        half = middle / 2
        below = 1 - exp(-half) * sum(half**j / factorial(j) for j in range(dims // 2))
        low, high = (middle, high) if below < chance else (low, middle)
    return high


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, all components finite, not zero."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & F.coalesce(good & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(columns: int) -> np.ndarray:
    return np.random.default_rng(6).standard_normal((columns, DIMENSIONS))


def _lift(x: np.ndarray, top: float | None) -> np.ndarray:
    """Vectors with the coordinate that makes all of one length; queries (top None) get a zero."""
    if top is None:
        rest = np.zeros(len(x))
    else:
        rest = np.sqrt(np.maximum(0.0, top - np.einsum("ij,ij->i", x, x)))
    return np.concatenate([x, rest[:, None]], axis=1)


class Cells:
    """Upper part of a kd-tree over projected points: splits at medians, level by level."""

    def __init__(self, points: np.ndarray, count: int):
        #: Of each node of the tree: axis (-1: a cell), cut, and children or the cell's number.
        self.axis, self.cut, self.child = [-1], [0.0], [(0, 0)]
        everywhere = np.full(DIMENSIONS, np.inf)
        groups = [(0, points, -everywhere, everywhere)]
        while len(groups) < count:
            fresh = []
            for node, part, low, high in groups:
                axis = int(np.argmax(np.ptp(part, axis=0))) if len(part) else 0
                cut = float(np.median(part[:, axis])) if len(part) else 0.0
                inside = part[:, axis] < cut
                if not inside.any() or inside.all():
                    fresh.append((node, part, low, high))
                    continue
                first = len(self.axis)
                self.axis[node], self.cut[node], self.child[node] = axis, cut, (first, first + 1)
                self.axis += [-1, -1]
                self.cut += [0.0, 0.0]
                self.child += [(0, 0), (0, 0)]
                left, right = high.copy(), low.copy()
                left[axis] = right[axis] = cut
                fresh += [(first, part[inside], low, left), (first + 1, part[~inside], right, high)]
            if len(fresh) == len(groups):
                break
            groups = fresh
        for cell, (node, _, _, _) in enumerate(groups):
            self.child[node] = (cell, cell)
        self.axis, self.cut, self.child = np.array(self.axis), np.array(self.cut), np.array(self.child)
        self.low, self.high = np.array([g[2] for g in groups]), np.array([g[3] for g in groups])

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance from each point to each cell's box."""
        out = np.zeros((len(points), len(self.low)))
        for axis in range(DIMENSIONS):
            p = points[:, axis, None]
            out += np.maximum(0.0, np.maximum(self.low[:, axis] - p, p - self.high[:, axis])) ** 2
        return out

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point, by descent: boxes are closed below and open above."""
        node = np.zeros(len(points), dtype=np.int64)
        open_ = np.flatnonzero(self.axis[node] >= 0)
        while len(open_):
            at = node[open_]
            side = points[open_, self.axis[at]] >= self.cut[at]
            node[open_] = self.child[at, side.astype(np.int64)]
            open_ = open_[self.axis[node[open_]] >= 0]
        return self.child[node, 0]


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Lower part of the tree: rows of each leaf."""
    stack, out = [np.arange(len(points))], []
    while stack:
        rows = stack.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        axis = int(np.argmax(np.ptp(points[rows], axis=0)))
        half = len(rows) // 2
        order = rows[np.argpartition(points[rows, axis], half)]
        stack += [order[:half], order[half:]]
    return out


def search_block(ids, vectors, projected, queries, query_ids, query_points, limits, k: int, quantile: float, room):
    """The ``k`` best of a block for each query: (query row, vector id, score) arrays.

    ``limits`` are squared distances that a result must reach to matter; ``room`` turns a score
    into a squared distance per query."""
    leaves = _leaves(projected)
    low = np.array([projected[r].min(axis=0) for r in leaves])
    high = np.array([projected[r].max(axis=0) for r in leaves])
    rows, found, scores = [], [], []
    for q in range(len(queries)):
        gap = np.maximum(0.0, np.maximum(low - query_points[q], query_points[q] - high))
        near = (gap**2).sum(axis=1)
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        worst, at, step = limits[q], 0, 2
        order = np.argsort(near, kind="stable")
        while at < len(order):
            # all leaves from here on lie at this projected distance or farther
            if near[order[at]] > quantile * worst:
                break
            take = np.concatenate([leaves[i] for i in order[at : at + step]])
            at, step = at + step, step + 2
            other = ids[take] != query_ids[q]
            take = take[other]
            best_ids = np.concatenate([best_ids, ids[take]])
            best = np.concatenate([best, vectors[take] @ queries[q]])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            if len(best) == k:
                worst = min(limits[q], max(0.0, room[q] - 2 * best[-1]))
        rows.append(np.full(len(best), q))
        found.append(best_ids)
        scores.append(best)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), -1)


def nearest(
    df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
    miss: float = MISS, sample: int = SAMPLE,
) -> DataFrame:
    """``(query_id, rank, <id_col>, score)``: the ``k`` vectors found with the largest inner product
    for each row of ``queries`` (columns as ``df``), other ids only, ties to the smaller id.

    Vectors that are null, zero or hold a null or non-finite component take no part, nor do those
    whose length is not the most common one (ties: the greater).  Fewer than ``k`` candidates give
    as many rows.  Rows that repeat are candidates as often.  An empty table gives no rows.  Other
    columns, whatever their names, are ignored."""
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")

    def clean(frame: DataFrame) -> DataFrame:
        return frame.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v")).where(usable(F.col("v")))

    empty = spark.createDataFrame([], f"query_id bigint, rank int, `{id_col}` bigint, score double")
    base = clean(df)
    lengths = base.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return empty
    width = lengths["n"]
    base = base.where(F.size("v") == width)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = base.agg(F.max(norm).alias("top"), F.count(F.lit(1)).alias("n")).first()
    top, total = float(facts["top"]), int(facts["n"])
    matrix, quantile = _matrix(width + 1), chi_square_quantile(1 - miss, DIMENSIONS)
    picked = base.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
    seen = np.array([r["v"] for r in picked])
    count = max(1, -(-total // BLOCK), min(partitions(spark), total // 1000))
    cells = Cells(_lift(seen, top) @ matrix, 1 << (count - 1).bit_length())

    @F.pandas_udf("int")
    def cell_of(vectors: pd.Series) -> pd.Series:
        points = _lift(np.stack(vectors.to_numpy()).astype(float), top) @ matrix
        return pd.Series(cells.of(points).astype(np.int32))

    indexed = stored(base.withColumn("cell", cell_of("v")), "cells")
    sizes = {r["cell"]: r["count"] for r in indexed.groupBy("cell").count().collect()}
    blocks = np.array([-(-sizes.get(c, 0) // BLOCK) for c in range(len(cells.low))])
    first_block = np.concatenate([[0], np.cumsum(blocks)])

    @F.pandas_udf("int")
    def block_of(cell: pd.Series, spread: pd.Series) -> pd.Series:
        c = cell.to_numpy()
        return pd.Series((first_block[c] + spread.to_numpy() % np.maximum(1, blocks[c])).astype(np.int32))

    # a cell of many vectors, copies for instance, is dealt to several blocks, each visited in turn
    dealt = indexed.select("id", "v", block_of("cell", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("int")).alias("block"))

    def visits(own: bool):
        """Blocks that a query visits: those of the nearest cell, or the others not ruled out."""

        @F.pandas_udf("array<int>")
        def run(vectors: pd.Series, limit: pd.Series) -> pd.Series:
            points = _lift(np.stack(vectors.to_numpy()).astype(float), None) @ matrix
            filled, worst = np.flatnonzero(blocks > 0), limit.to_numpy()
            out, step = [], max(1, GAPS // max(1, len(cells.low)))
            for start in range(0, len(points), step):
                gaps = cells.distances(points[start : start + step])[:, filled]
                nearest_cell = filled[np.argmin(gaps, axis=1)]
                for row, home in enumerate(nearest_cell.tolist()):
                    if own:
                        chosen = [home]
                    else:
                        chosen = filled[(gaps[row] <= quantile * worst[start + row]) & (filled != home)]
                    parts = [np.arange(first_block[c], first_block[c + 1]) for c in chosen]
                    out.append(np.concatenate(parts or [np.empty(0, int)]).astype(np.int32))
            return pd.Series(out)

        return run

    def visit(asking: DataFrame, own: bool) -> DataFrame:
        """``(query_id, id, score)``: the best of each block for each query that visits it."""
        sent = asking.withColumn("block", F.explode(visits(own)("v", "worst")))
        # the queries of a block come in groups of bounded size, each with its own copy of the block
        groups = F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("groups")
        loads = stored(sent.groupBy("block").agg(groups), "loads")
        copies = F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
        left = dealt.join(loads, "block").withColumn("part", copies).drop("groups")
        # both sides read the loads: new names keep them apart
        left = left.select(F.col("block").alias("block"), F.col("part").alias("part"), "id", "v")
        right = sent.join(loads, "block").withColumn("part", F.pmod(F.xxhash64("query_id"), "groups").cast("int")).drop("groups")

        def run(index: pa.Table, asked: pa.Table) -> pa.Table:
            kinds = [("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]
            if not index.num_rows or not asked.num_rows:
                return pa.table({n: pa.array([], t) for n, t in kinds})
            vectors, wanted = _stack(index.column("v")), _stack(asked.column("v"))
            query_ids = asked.column("query_id").to_numpy()
            rows, ids, scores = search_block(
                index.column("id").to_numpy(), vectors, _lift(vectors, top) @ matrix, wanted, query_ids,
                _lift(wanted, None) @ matrix, asked.column("worst").to_numpy(), k, quantile,
                top + np.einsum("ij,ij->i", wanted, wanted),
            )
            return pa.table({"query_id": query_ids[rows], "id": ids, "score": scores})

        pairs = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
        return pairs.applyInArrow(run, "query_id bigint, id bigint, score double")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    asking = clean(queries).where(F.size("v") == width).select(
        F.col("id").alias("query_id"), "v", F.lit(float("inf")).alias("worst")
    ).dropDuplicates(["query_id", "v"])
    own = stored(best(visit(asking, True)).select("query_id", "id", "score"), "own")
    # squared distance of the worst kept, infinite where a query's own cell gave fewer than k
    far = own.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    limit = F.when(F.col("n") >= k, F.greatest(F.lit(0.0), F.lit(top) + size - 2 * F.col("least"))).otherwise(float("inf"))
    again = asking.drop("worst").join(far, "query_id", "left").select("query_id", "v", limit.alias("worst"))
    found = best(own.union(visit(again, False)))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
