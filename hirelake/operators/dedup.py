"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str | Column, order: list[str]) -> DataFrame:
    """Last row per key by `order`.

    `row_number() = 1` lets Spark keep one row per key in every map task before
    the shuffle (WindowGroupLimit), so a key that holds a third of the input
    sends one row per task, not the whole group.
    """
    window = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def fallback_key(*candidates: str) -> Column:
    """First candidate column that is neither null nor ''."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in candidates])


def keep_latest_by_fallback(df: DataFrame, candidates: list[str], order: list[str]) -> DataFrame:
    """`keep_latest` on the first usable key; rows without any key are dropped."""
    keyed = df.withColumn("_key", fallback_key(*candidates)).filter(F.col("_key").isNotNull())
    return keep_latest(keyed, "_key", order).drop("_key")
