"""Upsert each new snapshot file once, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hirelake.operators.dedup import keep_latest
from hirelake.operators.upsert import upsert_buckets, upsert_version
from hirelake.sources.bucketed import BucketedTable
from hirelake.sources.versioned import VersionedTable


def upsert_new_snapshots(
    spark: SparkSession,
    snapshots: str,
    schema: T.StructType,
    table: VersionedTable | BucketedTable,
    checkpoint: str,
    order: list[str],
    key: str = "job_id",
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    files_per_batch: int | None = None,
    compare: bool = True,
) -> DataFrame:
    """Read files not seen by this checkpoint, upsert them, return the table.

    A key's row in the table gives way only to one that is as late by `order`, so
    files may come late or out of turn; `compare=False` lets the last file win, as a
    plain MERGE does (the table then need not have the order's columns). A bucketed table commits the batch's number with
    its version, so that a batch replayed after a failure is skipped; on a versioned one it upserts the same keys again and
    ends in the same state. `prepare` turns raw rows into table rows after the
    dedup (for example `clean_b`'s parsing).
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def upsert_batch(rows: DataFrame, number: int) -> None:
        unique = prepare(keep_latest(rows.where(rows[key].isNotNull()), key, order))
        if isinstance(table, BucketedTable):
            # The checkpoint numbers its batches, and goes on with them after a restart.
            upsert_buckets(table, unique, order if compare else None, (checkpoint, number))
        else:
            upsert_version(table, unique, key, order if compare else None)

    query = (
        reader.parquet(snapshots).writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return table.read()
