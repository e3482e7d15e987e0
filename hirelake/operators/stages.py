"""Keep computed columns from being computed again by later filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with `columns` fixed at this point of the plan.

    Spark moves a filter on a computed column below the projection that computes
    it and repeats the whole expression there, once per use; for the parsers of
    this package that is dozens of regex calls. A one-row generator stops that:
    a filter on its output stays above it. Not needed on stored tables.
    """
    once = F.inline(F.array(F.struct(*columns)))
    return df.select(*[c for c in df.columns if c not in columns], once)
