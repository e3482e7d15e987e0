"""Prompt records out, structured replies in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.experience import experience_error
from hirelake.functions.tags import normalized_tags

# The enums of a classification reply.
SENIORITIES = ["Intern", "Fresher", "Junior", "Middle", "Senior", "Lead", "Manager", "Unknown"]
STATUSES = ["success", "ambiguous", "insufficient_information", "error"]
REPLY = (
    "role_group string, primary_role string, secondary_roles array<string>, seniority string, "
    "experience_years double, skills array<string>, is_multi_role boolean, parse_status string, _bad string"
)
# The enums of a salary reply.
CURRENCIES = ["VND", "USD"]
PERIODS = ["year", "month", "week"]
SALARY_REPLY = (
    "min_salary double, max_salary double, currency string, period string, parse_status string, _bad string"
)
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowNonNumericNumbers": "false"}


def prompt_record(df: DataFrame) -> Column:
    """The posting as JSON text, nulls kept, characters not escaped."""
    return F.to_json(
        F.struct(
            "job_id", "title",
            normalized_tags(df, "remaining_tags").alias("remaining_tags"),
            normalized_tags(df, "visible_tags").alias("visible_tags"),
            "experience",
        ),
        {"ignoreNullFields": "false"},
    )


def _unknown(value: Column, allowed: list[str]) -> Column:
    return value.isNotNull() & ~value.isin(allowed)


def decode_classification(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Classification reply to typed columns with defaults for missing keys.

    A reply that cannot be used gives the default row with status `error` and
    the name of the broken rule in `parse_error`.
    """
    kept = [c for c in df.columns if c != reply]
    df = df.withColumn("_r", F.from_json(F.col(reply), REPLY, _OPTIONS))
    keys = F.json_object_keys(reply)
    df = df.withColumn(
        "parse_error",
        F.when(F.col("_r._bad").isNotNull() | F.col("_r").isNull() | keys.isNull(), "not_a_valid_reply")
        .when(~F.array_contains(keys, "experience_years"), "missing_experience_years")
        .otherwise(F.coalesce(
            experience_error(F.col("_r.experience_years")),
            F.when(_unknown(F.col("_r.seniority"), SENIORITIES), "unknown_seniority"),
            F.when(_unknown(F.col("_r.parse_status"), STATUSES), "unknown_parse_status"),
        )),
    )
    good = F.col("parse_error").isNull()
    empty = F.array().cast("array<string>")

    def value(name: str, default: Column) -> Column:
        return F.when(good, F.coalesce(F.col(f"_r.{name}"), default)).otherwise(default).alias(name)

    return df.select(
        *kept,
        value("role_group", F.lit(None).cast("string")),
        value("primary_role", F.lit(None).cast("string")),
        value("secondary_roles", empty),
        value("seniority", F.lit("Unknown")),
        value("experience_years", F.lit(None).cast("double")),
        value("skills", empty),
        value("is_multi_role", F.lit(False)),
        F.when(good, F.coalesce(F.col("_r.parse_status"), F.lit("success"))).otherwise("error").alias("parse_status"),
        "parse_error",
    )


def decode_salary(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Salary reply to typed columns; an unusable one is `failed` with nulls."""
    kept = [c for c in df.columns if c != reply]
    df = df.withColumn("_r", F.from_json(F.col(reply), SALARY_REPLY, _OPTIONS))
    good = F.coalesce(
        F.col("_r._bad").isNull()
        & F.json_object_keys(reply).isNotNull()
        & ~_unknown(F.col("_r.currency"), CURRENCIES)
        & ~_unknown(F.col("_r.period"), PERIODS)
        & F.col("_r.parse_status").isin("success", "failed"),
        F.lit(False),
    )
    names = ["min_salary", "max_salary", "currency", "period"]
    return df.select(
        *kept,
        *[F.when(good, F.col(f"_r.{n}")).alias(n) for n in names],
        F.when(good, F.col("_r.parse_status")).otherwise("failed").alias("parse_status"),
    )
