"""Raw snapshots: one folder per day, appended to by every run."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.sources.folders import names_in


def day_folder(root: str, day: dt.date) -> str:
    """`root/Y-M-D` with month and day unpadded."""
    return f"{root.rstrip('/')}/{day.year}-{day.month}-{day.day}"


def write_snapshot(df: DataFrame, root: str, day: dt.date) -> None:
    """Append one snapshot; existing files of the day stay."""
    df.write.mode("append").parquet(day_folder(root, day))


def read_day(spark: SparkSession, root: str, day: dt.date, schema: T.StructType) -> DataFrame:
    """Every snapshot of one day, with a declared schema."""
    return spark.read.schema(schema).parquet(day_folder(root, day))


def stored_days(spark: SparkSession, root: str) -> list[dt.date]:
    """Days that have a folder, in order; folders of other names are none."""
    found = [re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", n) for n in names_in(spark, root)]
    return sorted(dt.date(*map(int, m.groups())) for m in found if m)


def read_days(spark: SparkSession, root: str, first: dt.date, last: dt.date, schema: T.StructType) -> DataFrame:
    """Every snapshot of the days from `first` to `last`, with the column `day`; only those days' folders are listed and read.

    Days without a folder have no rows.
    """
    out = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("day", T.DateType())]))
    days = [d for d in stored_days(spark, root) if first <= d <= last]
    if not days:
        return out
    # The folder of a row's file is its day: one scan of all chosen folders, however many.
    rows = spark.read.schema(schema).parquet(*[day_folder(root, d) for d in days])
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{1,2}-\d{1,2})/[^/]+$", 1)
    return rows.select("*", F.to_date(folder, "yyyy-M-d").alias("day"))
