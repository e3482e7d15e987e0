"""Nearest neighbours through low-dimensional stable projections and kd-trees.

Unit vectors are projected on a few Gaussian directions; a pair at distance d lies
at a projected distance whose square is d^2 times a chi-square variable. A kd-tree over
the projections yields neighbours in projected order, each is verified by its true
cosine, and the search stops once the next projected distance, set against the k-th best
true one, passes the chi-square quantile: what is left is nearer with small probability.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.llm.vectors import common_size, matrix, sample, valid_vectors


@dataclass(frozen=True)
class SrsPlan:
    """`sample` vectors at most place the top splits; every vector is indexed.

    A true neighbour is passed over with probability 1 - `confidence` at most.
    """

    k: int = 5
    dims: int = 8
    confidence: float = 0.98
    sample: int = 16_384
    cell: int = 8192
    leaf: int = 64
    seed: int = 3


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square of even m degrees <= x) = p, from the closed form, by bisection."""
    low, high = 0.0, 200.0
    for _ in range(100):
        x = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        if 1 - math.exp(-x / 2) * total < p:
            low = x
        else:
            high = x
    return (low + high) / 2


class KdTree:
    """Nested median splits over projections, leaves of at most `leaf` rows with their boxes."""

    def __init__(self, y: np.ndarray, leaf: int):
        order, todo, self.leaves = np.arange(len(y)), [(0, len(y))], []
        while todo:
            a, b = todo.pop()
            rows = order[a:b]
            if b - a <= leaf:
                self.leaves.append((rows, y[rows].min(0), y[rows].max(0)))
                continue
            axis = int(np.ptp(y[rows], axis=0).argmax())
            half = (b - a) // 2
            order[a:b] = rows[np.argpartition(y[rows, axis], half)]
            todo += [(a, a + half), (a + half, b)]
        self.low = np.array([x[1] for x in self.leaves])
        self.high = np.array([x[2] for x in self.leaves])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Squared projected distance of each query to each leaf's box."""
        out = np.zeros((len(q), len(self.low)))
        for d in range(q.shape[1]):
            out += np.maximum(np.maximum(self.low[None, :, d] - q[:, d, None], q[:, d, None] - self.high[None, :, d]), 0) ** 2
        return out


def search(queries: np.ndarray, raw: np.ndarray, q_ids: np.ndarray, q_best: np.ndarray, x: np.ndarray, x_raw: np.ndarray, ids: np.ndarray, directions: np.ndarray, plan: SrsPlan):
    """(query place, vector id, cosine) of each query's `k` nearest of one cell, nearest first, ties to the smaller id.

    Leaves come by projected distance. One whose distance passes the quantile times
    the k-th best squared distance so far ends the query's search; `q_best` are cosines
    known from elsewhere.
    """
    tree = KdTree(x @ directions, plan.leaf)
    q_at = queries @ directions
    bound = tree.bounds(q_at)
    order = np.argsort(bound, axis=1)
    quantile = chi_square_quantile(plan.confidence, plan.dims)
    for i in range(len(queries)):
        best: list[float] = []
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        kth = q_best[i]
        for step in range(0, len(tree.leaves), 8):
            todo = order[i, step:step + 8]
            if bound[i, todo[0]] > quantile * (2 - 2 * kth):
                break
            rows = np.concatenate([tree.leaves[t][0] for t in todo])
            rows = rows[ids[rows] != q_ids[i]]
            cos = x[rows] @ queries[i]
            good = cos >= kth - 1e-9
            if good.any():
                kept.append((rows[good], cos[good]))
                for c in np.sort(cos[good])[::-1][:plan.k]:
                    if len(best) < plan.k:
                        heapq.heappush(best, float(c))
                    elif c > best[0]:
                        heapq.heapreplace(best, float(c))
                if len(best) == plan.k:
                    kth = max(kth, best[0])
        if not kept:
            continue
        rows, cos = np.concatenate([r for r, _ in kept]), np.concatenate([c for _, c in kept])
        rows = rows[cos >= kth - 1e-9]
        # The score proper, from the original vectors, summed alike for equal vectors.
        a, b = raw[i], x_raw[rows]
        score = (b * a).sum(1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(1)))
        for r in np.lexsort((ids[rows], -score))[:plan.k]:
            yield i, int(ids[rows[r]]), float(score[r])


def _splits(y: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Axis and threshold of the top splits, heap order: node i has children 2i + 1 and 2i + 2."""
    out: list[tuple[int, float]] = []
    level = [y]
    for _ in range(depth):
        nxt = []
        for rows in level:
            axis = int(np.ptp(rows, axis=0).argmax()) if len(rows) else 0
            cut = float(np.median(rows[:, axis])) if len(rows) else 0.0
            out.append((axis, cut))
            left = rows[:, axis] < cut
            nxt += [rows[left], rows[~left]]
        level = nxt
    return out


def _cell_of(y: np.ndarray, splits: list[tuple[int, float]], depth: int) -> np.ndarray:
    node = np.zeros(len(y), np.int64)
    axis, cut = (np.array([s[k] for s in splits]) for k in (0, 1)) if splits else (np.zeros(1, int), np.zeros(1))
    for _ in range(depth):
        node = 2 * node + 1 + (y[np.arange(len(y)), axis[node].astype(int)] >= cut[node])
    return node - (2**depth - 1)


def _boxes(splits: list[tuple[int, float]], depth: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = [np.full(dims, -np.inf)], [np.full(dims, np.inf)]
    for level in range(depth):
        lows, highs = [], []
        for i, (a, b) in enumerate(zip(low, high)):
            axis, cut = splits[2**level - 1 + i]
            for side in (0, 1):
                lo, hi = a.copy(), b.copy()
                (hi if side == 0 else lo)[axis] = cut
                lows.append(lo)
                highs.append(hi)
        low, high = lows, highs
    return np.array(low), np.array(high)


def nearest(df: DataFrame, plan: SrsPlan = SrsPlan(), every: int = 50, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest by cosine of each vector whose id `every` divides.

    All other usable vectors are candidates (null, zero, with null or non-finite
    parts, or not of the most common length take no part; rows that repeat an id are
    one vector). Top splits cut the projections into cells, and a cell beyond `cell`
    rows, such as one of many copies, into parts by hash. Queries search their own cell
    first; with the k-th cosine found there they visit the other cells that the
    stopping test leaves, in blocks.
    """
    spark = df.sparkSession
    folder = work_folder(spark)
    vectors = stored(valid_vectors(df, id_column, vector), folder, "vectors")
    size = common_size(vectors)
    vectors = vectors.where(F.size("v") == size)
    total = vectors.count()
    if total < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rng = np.random.default_rng(plan.seed)
    directions = rng.standard_normal((size, plan.dims))
    picked = sample(vectors, plan.sample, size) @ directions
    depth = max(0, min(math.ceil(math.log2(total / plan.cell)), int(math.log2(max(len(picked) // 8, 1)))))
    splits = _splits(picked, depth)
    low, high = _boxes(splits, depth, plan.dims)
    quantile = chi_square_quantile(plan.confidence, plan.dims)

    def place(batches):
        for batch in batches:
            x = matrix(batch.column(1), size)
            y = x / np.linalg.norm(x, axis=1, keepdims=True) @ directions
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_cell_of(y, splits, depth), pa.int64())], names=["vec_id", "v", "cell"])

    placed = stored(vectors.select("vec_id", "v").mapInArrow(place, "vec_id long, v array<double>, cell long"), folder, "placed")
    # A few numbers a cell, of which there are at most an eighth of the sample.
    counts = {r.cell: (r.n, r.m) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("m")).collect()}
    parts = F.array(*[F.lit(max(1, math.ceil(counts.get(c, (0, 0))[0] / plan.cell))) for c in range(2**depth)])
    n_parts = F.get(parts, F.col("cell").cast("int"))
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(2**31)).cast("int")
    data = placed.withColumn("part", (spread % n_parts).cast("int"))
    asks = placed.where(F.col("vec_id") % every == 0).select("vec_id", "v", F.col("cell").alias("home"))

    def visit(rows):
        import pandas as pd

        asked, held = rows[rows.asks], rows[~rows.asks]
        out = []
        if len(asked) and len(held):
            raw_q, raw_x = np.stack(asked.v.to_numpy()), np.stack(held.v.to_numpy())
            q, x = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (raw_q, raw_x))
            ids = asked.vec_id.to_numpy()
            found = search(q, raw_q, ids, asked.kth.to_numpy(), x, raw_x, held.vec_id.to_numpy(), directions, plan)
            out = [(int(ids[i]), v, s) for i, v, s in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    def searched(queries: DataFrame, asked: dict[int, int], name: str) -> DataFrame:
        """Queries (vec_id, v, kth, cell) against all parts of their cells, in blocks of both."""
        n_blocks = F.get(F.array(*[F.lit(max(1, math.ceil(asked.get(c, 0) / 512))) for c in range(2**depth)]), F.col("cell").cast("int"))
        left = queries.withColumn("block", (spread % n_blocks).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
        right = data.where(F.col("cell").isin([c for c, n in asked.items() if n])).withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        columns = ["cell", "part", "block", "vec_id", "v"]
        both = left.select(*columns, "kth", F.lit(True).alias("asks")).union(right.select(*columns, F.lit(-1.0).alias("kth"), F.lit(False).alias("asks")))
        found = both.groupBy("cell", "part", "block").applyInPandas(visit, "query_id long, vec_id long, score double")
        return stored(found, folder, name)

    home = searched(asks.withColumn("cell", F.col("home")).withColumn("kth", F.lit(-1.0)), {c: m for c, (_, m) in counts.items()}, "home")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = home.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == plan.k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))

    def others(batches):
        for batch in batches:
            x = matrix(batch.column(1), size)
            y = x / np.linalg.norm(x, axis=1, keepdims=True) @ directions
            gap = np.zeros((len(y), len(low)))
            for d in range(plan.dims):
                gap += np.maximum(np.maximum(low[None, :, d] - y[:, d, None], y[:, d, None] - high[None, :, d]), 0) ** 2
            near = gap <= (quantile * (2 - 2 * batch.column(3).to_numpy(zero_copy_only=False)))[:, None]
            near[np.arange(len(y)), batch.column(2).to_numpy()] = False
            cells = pa.array([np.flatnonzero(r) for r in near], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), cells], names=["vec_id", "v", "kth", "cells"])

    await_more = asks.join(kth, "vec_id", "left").select("vec_id", "v", "home", F.coalesce("kth", F.lit(-1.0)).alias("kth"))
    more = await_more.mapInArrow(others, "vec_id long, v array<double>, kth double, cells array<long>")
    more = stored(more.select("vec_id", "v", "kth", F.explode("cells").alias("cell")), folder, "more")
    visits = {r.cell: r.n for r in more.groupBy("cell").agg(F.count("*").alias("n")).collect() if r.cell in counts}
    found = home.union(searched(more, visits, "away")) if visits else home
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= plan.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
