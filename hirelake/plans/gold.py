"""Aggregate tables over the cleaned postings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import keyword_match
from hirelake.operators.joins import unnest

# The data-engineer title keywords, the rate and the top-k size.
DATA_ENGINEER_KEYWORDS = ["data engineer", "data engineering", "kỹ sư dữ liệu"]
USD_TO_VND = 26_000
TOP_SKILLS = 10


def with_keyword(df: DataFrame, column: str, keywords: list[str]) -> DataFrame:
    return df.filter(keyword_match(F.col(column), keywords))


def career_count(postings_a: DataFrame) -> DataFrame:
    """Number of data-engineer postings."""
    return with_keyword(postings_a, "title", DATA_ENGINEER_KEYWORDS).agg(F.count(F.lit(1)).alias("NumberofDataEngineer"))


def top_skills(postings_a: DataFrame, k: int = TOP_SKILLS) -> DataFrame:
    """Skills of data-engineer postings by number of distinct jobs.

    Distinct (skill, job_id) pairs are merged in the map tasks before the count,
    so a skill on a third of all postings does not gather in one task.
    """
    pairs = unnest(with_keyword(postings_a, "title", DATA_ENGINEER_KEYWORDS), "skills", "skill")
    return (
        pairs.groupBy("skill").agg(F.countDistinct("job_id").alias("job_count"))
        .orderBy(F.desc("job_count"), F.asc("skill")).limit(k)
    )


def seniority_counts(postings_b: DataFrame) -> DataFrame:
    return (
        postings_b.filter(F.col("seniority").isNotNull()).groupBy("seniority")
        .agg(F.count(F.lit(1)).alias("total_jobs"))
    )


def average_salary(postings_b: DataFrame, rate: float = USD_TO_VND) -> DataFrame:
    """Average minimum and maximum in VND, both currencies in one scan."""
    factor = F.when(F.col("salary_currency").contains("USD"), F.lit(float(rate))).when(
        F.col("salary_currency").contains("VND"), F.lit(1.0)
    )
    return postings_b.agg(
        F.avg(F.col("salary_min") * factor).alias("LUONG_TRUNG_BINH_MIN"),
        F.avg(F.col("salary_max") * factor).alias("LUONG_TRUNG_BINH_MAX"),
    )


def city_counts(postings_b: DataFrame) -> DataFrame:
    return postings_b.groupBy("city").agg(F.count("job_id").alias("TongCongViec"))


def rounded_average(value: Column, places: int) -> Column:
    """Average rounded half up on its decimal value, not on its binary one."""
    return F.round(F.avg(value).cast("decimal(18,6)"), places).cast("double")


def data_roles(postings_b: DataFrame) -> DataFrame:
    """Data roles: average experience and number of postings."""
    return (
        postings_b.filter(F.col("experience_years").isNotNull() & F.col("primary_role").isNotNull())
        .filter(F.lower("primary_role").contains("data"))
        .groupBy("primary_role")
        .agg(rounded_average(F.col("experience_years"), 1).alias("avg_experience_years"),
             F.count(F.lit(1)).alias("total_jobs"))
    )


def role_trend(postings_b: DataFrame) -> DataFrame:
    """Postings by role; the null role is a row that counts 0."""
    return postings_b.groupBy("primary_role").agg(F.count("primary_role").alias("TongSoTuyenDung"))


# Table aliases, each with its board and model.
MODELS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "career_data_engineer": ("a", career_count),
    "skil_DE_need": ("a", top_skills),
    "hiring_seniority": ("b", seniority_counts),
    "Luong_trung_binh_IT": ("b", average_salary),
    "phan_bo_viec_lam": ("b", city_counts),
    "TheMostCVinData": ("b", data_roles),
    "Trend_hiring": ("b", role_trend),
}


def build_all(postings_a: DataFrame, postings_b: DataFrame) -> dict[str, DataFrame]:
    boards = {"a": postings_a, "b": postings_b}
    return {alias: model(boards[board]) for alias, (board, model) in MODELS.items()}
