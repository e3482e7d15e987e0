"""Shared steps of the vector operators: valid rows, bounded samples, k-means."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v) with v array<double>: one row per id, usable vectors only.

    Null ids, null, empty and zero vectors, and those with null or non-finite
    parts are left out; of rows that repeat an id the least vector counts.
    """
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.where(fine).groupBy("vec_id").agg(F.min("v").alias("v"))


def common_size(vectors: DataFrame) -> int:
    """The most frequent vector length (the smaller on ties), 0 without vectors."""
    row = vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return row.d if row else 0


def matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def sample(vectors: DataFrame, most: int, size: int) -> np.ndarray:
    """Unit vectors of at most `most` rows, the first by hash of the id: what indexes are fitted on."""
    rows = vectors.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).toArrow()
    x = matrix(rows["v"], size)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    k = min(k, len(x))
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = (x @ centre.T - 0.5 * (centre**2).sum(1)).argmax(1)
        count = np.bincount(near, minlength=k)
        for d in range(x.shape[1]):
            centre[:, d] = np.where(count > 0, np.bincount(near, x[:, d], k) / np.maximum(count, 1), centre[:, d])
    return centre
