"""Near-duplicate vectors by product quantisation.

Vectors fall into coarse cells; inside a cell they are kept as codes of their residual's
subspaces. Each vector looks into every cell whose centroid is nearly as close to it as
its own: table lookups give its distance to each code, a bound with the code's own
error drops what cannot reach the threshold, and the exact cosine decides the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.components import components
from hirelake.llm.stored import stored, work_folder
from hirelake.llm.vectors import common_size, kmeans, matrix, sample, valid_vectors


@dataclass(frozen=True)
class PqPlan:
    """`sample` vectors at most fit the index; every vector is coded and compared.

    A vector probes the cells whose centroid's cosine is within `margin` of its best
    one's. Of pairs at cosine 0.9 in 64 dimensions about three in a hundred lie further
    apart than that one way, and less than one in a hundred both ways.
    """

    threshold: float = 0.9
    margin: float = 0.25
    sample: int = 16_384
    subspaces: int = 16
    codes: int = 16
    block: int = 2048
    seed: int = 5


@dataclass(frozen=True)
class PqIndex:
    cells: np.ndarray
    books: np.ndarray
    edges: np.ndarray


def fit(x: np.ndarray, total: int, plan: PqPlan) -> PqIndex:
    """Cells grow with the root of the number of vectors, up to an eighth of the sample."""
    rng = np.random.default_rng(plan.seed)
    n_cells = max(1, min(round(math.sqrt(total) / 3.5), len(x) // 8, 2048))
    cells = kmeans(x, n_cells, 12, rng)
    cells /= np.maximum(np.linalg.norm(cells, axis=1, keepdims=True), 1e-12)
    rest = x - cells[(x @ cells.T).argmax(1)]
    edges = np.linspace(0, x.shape[1], min(plan.subspaces, x.shape[1]) + 1).astype(int)
    width = int(np.diff(edges).max())
    books = np.zeros((len(edges) - 1, plan.codes, width))
    for s, (a, b) in enumerate(zip(edges, edges[1:])):
        book = kmeans(rest[:, a:b], plan.codes, 8, rng)
        books[s, :len(book), :b - a] = book
        books[s, len(book):, :b - a] = book[:1]
    return PqIndex(cells, books, edges)


def encode(x: np.ndarray, index: PqIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cell, cosines to all centroids, codes, error of the code) of unit vectors."""
    near = x @ index.cells.T
    cell = near.argmax(1)
    rest = x - index.cells[cell]
    codes = np.zeros((len(x), len(index.books)), np.uint8)
    error = np.zeros(len(x))
    for s, (a, b) in enumerate(zip(index.edges, index.edges[1:])):
        book = index.books[s, :, :b - a]
        far = ((rest[:, None, a:b] - book[None]) ** 2).sum(2)
        codes[:, s] = far.argmin(1)
        error += far.min(1)
    return cell, near, codes, np.sqrt(error)


def _coded(index: PqIndex, plan: PqPlan, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = matrix(batch.column(2), size)
            x = raw / np.linalg.norm(raw, axis=1, keepdims=True)
            cell, near, codes, error = encode(x, index)
            probe = near >= near.max(1, keepdims=True) - plan.margin
            mask = np.packbits(probe, axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array([np.flatnonzero(p).astype(np.int32) for p in probe], pa.list_(pa.int32())),
                pa.array([m.tobytes() for m in mask], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array([v.tobytes() for v in x], pa.binary()),
            ], names=["vec_id", "copies", "cell", "probes", "mask", "codes", "error", "unit"])

    return run


CODED = "vec_id long, copies long, cell int, probes array<int>, mask binary, codes binary, error double, unit binary"


def _links(index: PqIndex, plan: PqPlan):
    """Within one block of a cell's members and one block of its queries: degrees, and a spanning forest of the links."""
    import pandas as pd

    radius = math.sqrt(2 - 2 * plan.threshold) + 1e-9

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        asked, held = rows[rows.asks], rows[~rows.asks]
        if not len(asked) or not len(held):
            return empty
        cell = int(rows.at_cell.iloc[0])
        q, x = (np.frombuffer(b"".join(r.unit), np.float64).reshape(len(r), -1) for r in (asked, held))
        codes = np.frombuffer(b"".join(held.codes), np.uint8).reshape(len(held), -1)
        rest = q - index.cells[cell]
        # Asymmetric distances: exact query residual against member codes, by table lookup.
        far = np.zeros((len(q), len(x)), np.float32)
        for s, (a, b) in enumerate(zip(index.edges, index.edges[1:])):
            book = index.books[s, :, :b - a]
            table = (rest[:, a:b] ** 2).sum(1)[:, None] - 2 * rest[:, a:b] @ book.T + (book**2).sum(1)[None]
            far += table.astype(np.float32)[:, codes[:, s]]
        bound = (radius + held.error.to_numpy()) ** 2 * (1 + 1e-4) + 1e-4
        i, j = np.nonzero(far <= bound.astype(np.float32)[None, :])
        qi, xj = asked.vec_id.to_numpy(), held.vec_id.to_numpy()
        # A pair that the other one's probe finds as well counts from the smaller id.
        mask = np.unpackbits(np.frombuffer(b"".join(held["mask"]), np.uint8).reshape(len(held), -1), axis=1)
        both = mask[j, asked.cell.to_numpy()[i]] == 1
        use = (qi[i] != xj[j]) & (~both | (qi[i] < xj[j]))
        i, j = i[use], j[use]
        good = np.zeros(len(i), bool)
        for a in range(0, len(i), 200_000):
            good[a:a + 200_000] = np.einsum("ij,ij->i", q[i[a:a + 200_000]], x[j[a:a + 200_000]]) >= plan.threshold
        i, j = i[good], j[good]
        if not len(i):
            return empty
        ids, place = np.unique(np.concatenate([qi[i], xj[j]]), return_inverse=True)
        left, right = place[:len(i)], place[len(i):]
        degree = np.bincount(left, held.copies.to_numpy()[j], len(ids)) + np.bincount(right, asked.copies.to_numpy()[i], len(ids))
        # Smallest member of each local component, by repeated minima over the links.
        root = np.arange(len(ids))
        while True:
            low = root.copy()
            np.minimum.at(low, left, root[right])
            np.minimum.at(low, right, root[left])
            low = low[low]
            if (low == root).all():
                break
            root = low
        return pd.DataFrame({"a": ids[root], "b": ids, "n": degree.astype(np.int64)})

    return run


def near_duplicates(df: DataFrame, plan: PqPlan = PqPlan(), id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `df`.

    Unusable vectors (null, zero, with null or non-finite parts, or not of the most
    common length) link with nothing. Equal vectors are one class, whose size counts
    in its links; rows that repeat an id are one vector; rows without id have no component
    and are kept. Cells with many members or queries are cut into blocks whose pairs are
    compared task by task; a task returns degrees and a forest, not its pairs.
    """
    spark = df.sparkSession
    folder = work_folder(spark)
    vectors = stored(valid_vectors(df, id_column, vector), folder, "vectors")
    size = common_size(vectors)
    keyed = vectors.where(F.size("v") == size).select("vec_id", "v", F.xxhash64("v").alias("h"), F.xxhash64("v", F.lit(1)).alias("g"))
    classes = stored(keyed.groupBy("h", "g").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), folder, "classes")
    member = stored(keyed.select("vec_id", "h", "g").join(classes, ["h", "g"]).select("vec_id", "rep", "copies"), folder, "member")
    reps = keyed.select("vec_id", "v").join(classes.select(F.col("rep").alias("vec_id"), "copies"), "vec_id").select("vec_id", "copies", "v")
    reps = stored(reps, folder, "reps")
    total = reps.count()
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"))
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    index = fit(sample(reps, plan.sample, size), total, plan)
    coded = stored(reps.mapInArrow(_coded(index, plan, size), CODED), folder, "coded")
    # Two numbers a cell, and at most 2,048 cells.
    held = {r.cell: r.n for r in coded.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    asked = {r.cell: r.n for r in coded.select(F.explode("probes").alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    blocks = lambda counts: F.array(*[F.lit(max(1, math.ceil(counts.get(c, 0) / plan.block))) for c in range(len(index.cells))])
    coded = coded.withColumn("hash", F.xxhash64("vec_id"))
    n_held, n_asked = F.get(blocks(held), F.col("at_cell")), F.get(blocks(asked), F.col("at_cell"))
    members = coded.withColumn("at_cell", F.col("cell")).withColumn("j", F.pmod("hash", n_held).cast("int"))
    members = members.withColumn("i", F.explode(F.sequence(F.lit(0), n_asked - 1))).withColumn("asks", F.lit(False))
    queries = coded.withColumn("at_cell", F.explode("probes")).where(F.col("at_cell").isin(list(held)))
    queries = queries.withColumn("i", F.pmod("hash", n_asked).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), n_held - 1))).withColumn("asks", F.lit(True))
    none = F.lit(None).cast("binary")
    columns = ["at_cell", "i", "j", "asks", "vec_id", "copies", "cell", "unit", "error"]
    both = members.select(*columns, "mask", "codes").union(queries.select(*columns, none.alias("mask"), none.alias("codes")))
    found = both.groupBy("at_cell", "i", "j").applyInPandas(_links(index, plan), "a long, b long, n long")
    found = stored(found, folder, "found")
    degree = found.groupBy(F.col("b").alias("rep")).agg(F.sum("n").alias("n"))
    edges = found.select("a", "b").where("a <> b").union(member.where("vec_id <> rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b")))
    comp = components(edges, folder).select(F.col("node").alias("vec_id"), "component")
    linked = member.join(degree, "rep", "left").select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.join(linked, "vec_id", "left").join(comp, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
