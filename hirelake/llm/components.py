"""Connected components by repeated contraction, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.stored import stored


def components(edges: DataFrame, folder: str, name: str = "cc") -> DataFrame:
    """(node, component): the smallest node reachable over `edges` (a, b); only nodes that have an edge.

    Each round every node points to its neighbour (or itself) of lowest
    per-round hash, and edges are redrawn between the nodes pointed to. Hashes
    keep long sorted chains from contracting one node a round. Minima combine
    in the map tasks, so a hub does not gather its neighbours in one task.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    live = stored(edges.select(a.alias("a"), b.alias("b")).where("a <> b").distinct(), folder, f"{name}-e0")
    maps: list[DataFrame] = []
    while live.limit(1).count():
        k = len(maps)
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(k), c).alias("h"), F.col(c).alias("n"))
        points = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("node"), F.least(F.col("m"), F.struct(F.xxhash64(F.lit(k), "a").alias("h"), F.col("a").alias("n")))["n"].alias("to")
        )
        points = stored(points, folder, f"{name}-p{k}")
        left = points.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        live = live.join(left, "a").join(right, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        live = stored(live.where("a <> b").distinct(), folder, f"{name}-e{k + 1}")
        maps.append(points)
    if not maps:
        return edges.select(a.alias("node"), b.alias("component")).limit(0)
    root = maps[0]
    for step in maps[1:]:
        nxt = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        root = root.join(nxt, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    root = stored(root, folder, f"{name}-roots")
    least = root.groupBy("to").agg(F.min("node").alias("component"))
    return root.join(least, "to").select("node", "component")
