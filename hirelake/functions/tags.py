"""Tag lists: text or array to a clean array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions.text import strip


def tags_of_array(tags: Column) -> Column:
    stripped = F.transform(F.coalesce(tags, F.array().cast("array<string>")), strip)
    return F.filter(stripped, lambda t: t != "")


def tags_of_text(tags: Column) -> Column:
    return tags_of_array(F.split(tags, ","))


def normalized_tags(df: DataFrame, column: str) -> Column:
    """Clean tag array of a string or array column; any other type is an error."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return tags_of_text(F.col(column))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return tags_of_array(F.col(column))
    raise TypeError(f"{column} must be a string or an array of strings, not {kind.simpleString()}")
