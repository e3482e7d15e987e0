"""The daily run: snapshots, cleaned tables, aggregate tables, report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hirelake.operators.upsert import upsert_buckets
from hirelake.plans.clean import clean_a, clean_b
from hirelake.plans.ingest import ingest_day
from hirelake.plans.gold_state import advance, tables_from_state
from hirelake.plans.report import report_text
from hirelake.schemas import CLEAN_A, CLEAN_B, RAW_A, RAW_B
from hirelake.sources.bucketed import BucketedTable
from hirelake.sources.snapshots import read_day, write_snapshot
from hirelake.sources.tables import materialize


@dataclass(frozen=True)
class Layout:
    """Folders of one lake, all on storage shared by the cluster."""

    root: str
    namespace: str = "gold"

    def raw(self, board: str) -> str:
        return f"{self.root}/raw/{board}"

    def work(self, board: str, day: dt.date) -> str:
        return f"{self.root}/work/{board}/{day.isoformat()}"

    def clean(self, board: str) -> str:
        return f"{self.root}/clean/{board}"

    def state(self, board: str) -> str:
        return f"{self.root}/state/{board}"

    def gold(self, alias: str) -> str:
        return f"{self.root}/gold/{alias}"


def run_day(
    spark: SparkSession, layout: Layout, day: dt.date, raw_a: DataFrame | None = None, raw_b: DataFrame | None = None,
    zone: str | None = None, order_a: list[str] | None = None, order_b: list[str] | None = None,
    bodies_a: DataFrame | None = None, bodies_b: DataFrame | None = None, base_urls: tuple[str, str] = ("", ""),
) -> DataFrame:
    """Store the day's rows, upsert both boards, bring the aggregates up to date, report.

    The day's rows come from response bodies (see `ingest`), or are given as rows of the raw tables.
    Every step reads what the step before stored. Running a day again adds a
    snapshot and leaves the same cleaned rows; running an earlier day again takes
    nothing back, since a job's row gives way only to one crawled as late. An upsert writes the
    buckets of the day's jobs, and the aggregates follow from the changed rows.
    """
    for board, bodies, rows, base_url in (("a", bodies_a, raw_a, base_urls[0]), ("b", bodies_b, raw_b, base_urls[1])):
        if bodies is not None:
            ingest_day(spark, bodies, board, layout.raw(board), day, layout.work(board, day), base_url)
        if rows is not None:
            write_snapshot(rows, layout.raw(board), day)
    states = []
    for board, schema, raw, clean, order in (("a", CLEAN_A, RAW_A, clean_a, order_a), ("b", CLEAN_B, RAW_B, clean_b, order_b)):
        table = BucketedTable(spark, layout.clean(board), schema)
        upsert_buckets(table, clean(read_day(spark, layout.raw(board), day, raw), order, zone), ["scraped_at"])
        states.append(advance(table, layout.state(board), board))
    names = {
        alias: materialize(df, alias, layout.namespace, path=layout.gold(alias))
        for alias, df in tables_from_state(*states).items()
    }
    return report_text({alias: spark.table(name) for alias, name in names.items()}, day)
