"""Raw postings to cleaned postings, one row per job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions.salary_freeform import parse_freeform_salary
from hirelake.functions.salary_token import flatten_salary, parse_salary
from hirelake.functions.times import parse_time
from hirelake.operators.classify import classify
from hirelake.operators.dedup import keep_latest
from hirelake.schemas import CLEAN_A, CLEAN_B

LATEST = ["scraped_at", "source_page"]


def total_order(df: DataFrame, order: list[str] | None) -> list[str]:
    """The given order, else crawl time and page with all other columns as tie-breaks.

    Crawl times are compared as instants, unreadable ones before all others. A total order makes the kept row the same when a lost task runs again. Give
    a short one that is unique per job where you have it: fewer columns are read.
    """
    return order or [*LATEST, *[c for c in df.columns if c not in (*LATEST, "job_id")]]


def _timed(df: DataFrame, zone: str | None) -> DataFrame:
    if isinstance(df.schema["scraped_at"].dataType, T.StringType):
        return df.withColumn("scraped_at", parse_time(F.col("scraped_at"), zone))
    return df.withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))


def clean_a(raw: DataFrame, order: list[str] | None = None, zone: str | None = None) -> DataFrame:
    """Board A: latest row per job, free-form salary, 15 columns.

    Rows without job_id cannot be upserted and are left out. Duplicates go
    before the parsing, which then runs once per job.
    """
    timed = _timed(raw.where(F.col("job_id").isNotNull()), zone)
    latest = keep_latest(timed, "job_id", total_order(raw, order))
    return latest.transform(parse_freeform_salary("salary")).select(*CLEAN_A.fieldNames())


def clean_b(raw: DataFrame, order: list[str] | None = None, zone: str | None = None) -> DataFrame:
    """Board B: latest row per job, token salary, classification, 22 columns."""
    keyed = raw.withColumn("job_id", F.col("job_id").cast("string")).where(F.col("job_id").isNotNull())
    latest = keep_latest(_timed(keyed, zone), "job_id", total_order(raw, order))
    parsed = latest.transform(parse_salary("salary")).transform(flatten_salary())
    return classify(parsed).select(*CLEAN_B.fieldNames())
