"""Join parsed rows back to their source, and array expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_parsed(parsed: DataFrame, source: DataFrame, key: str = "job_id") -> DataFrame:
    """Inner join with one key column in the output; null keys drop.

    No broadcast hint: Spark broadcasts a side only when its measured size is
    below the threshold, and splits skewed partitions of a sort-merge join.
    """
    return source.join(parsed, key, "inner")


def unnest(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per element; rows with a null or empty array drop."""
    return df.withColumn(name, F.explode(array))
