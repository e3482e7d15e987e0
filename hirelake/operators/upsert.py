"""Upsert by key: MERGE where the catalog supports it, else a new version."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.dedup import keep_latest
from hirelake.sources.bucketed import WRITTEN, BucketedTable
from hirelake.sources.versioned import VersionedTable


def merge_sql(target: str, source: str, key: str = "job_id") -> str:
    return (
        f"MERGE INTO {target} AS t USING {source} AS s ON t.{key} = s.{key} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def merge_into(spark: SparkSession, target: str, rows: DataFrame, key: str = "job_id") -> None:
    """Row-level MERGE into a catalog table that supports it; keys must be unique."""
    view = f"{target.replace('.', '_')}_new"
    rows.createOrReplaceTempView(view)
    spark.sql(merge_sql(target, view, key))


def upserted(target: DataFrame, rows: DataFrame, key: str = "job_id") -> DataFrame:
    """Target rows whose key is not in `rows`, plus all of `rows` (unique keys).

    As in MERGE, a null key matches nothing and is inserted.
    """
    return target.join(rows.select(key), key, "left_anti").unionByName(rows)


def newest(target: DataFrame, rows: DataFrame, order: list[str], key: str = "job_id") -> DataFrame:
    """Of target and new rows the latest of each key by `order`; a new row wins a tie, null keys all stay."""
    both = target.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    keyed = keep_latest(both.where(F.col(key).isNotNull()), key, [*order, "_new"])
    return keyed.unionByName(both.where(F.col(key).isNull())).drop("_new")


def upsert_version(table: VersionedTable, rows: DataFrame, key: str = "job_id", order: list[str] | None = None) -> DataFrame:
    """Write the upserted rows as the table's next version.

    `rows` is stored first and read back for both sides of the join, so a costly
    or non-deterministic plan (an enrichment) runs once. With `order` a key's row
    is replaced only by one that is as late or later; without, by any, as in MERGE.
    """
    staged = table.stage(rows.select(*table.schema.fieldNames()), uuid.uuid4().hex)
    merged = newest(table.read(), staged, order, key) if order else upserted(table.read(), staged, key)
    out = table.write(merged)
    table.retire()
    return out


def upsert_buckets(table: BucketedTable, rows: DataFrame, order: list[str] | None = None, batch: tuple[str, int] | None = None) -> DataFrame:
    """Upsert into the buckets that the rows' keys fall in; `table.changes()` then has old and new rows.

    As `upsert_version` otherwise. A `batch` (stream, number) that the table has taken
    already changes nothing, so a stream may replay it after a failure.
    """
    key = table.key

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        if order is None:
            return upserted(old, new, key)
        both = old.unionByName(new)
        latest = keep_latest(both.where(F.col(key).isNotNull()), key, [*order, WRITTEN])
        return latest.unionByName(both.where(F.col(key).isNull()))

    return table.replace_buckets(rows, merge, batch)
