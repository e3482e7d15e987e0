"""Frequency profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_frequency(df: DataFrame, column: str, count_name: str) -> DataFrame:
    """Count of each value, most frequent first; the null group counts 0."""
    return df.groupBy(column).agg(F.count(column).alias(count_name)).orderBy(F.desc(count_name), F.asc(column))


def count_by(df: DataFrame, columns: list[str], count_name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count_name))
