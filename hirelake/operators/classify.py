"""Posting classification: role, seniority, experience, skills, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.experience import parse_experience
from hirelake.functions.roles import GROUP_PHRASES, ROLES, Role, group_hint, group_of_role, roles_in_text
from hirelake.functions.seniority import seniority
from hirelake.functions.skills import SKILLS, skill_text, skill_text_of_tags, skills
from hirelake.functions.tags import normalized_tags
from hirelake.functions.text import phrase_text, phrase_text_of_tags

SUCCESS, AMBIGUOUS, INSUFFICIENT, ERROR = "success", "ambiguous", "insufficient_information", "error"  # fixed values


def classify(
    df: DataFrame, roles: list[Role] = ROLES, hints: dict[str, list[str]] = GROUP_PHRASES,
    vocabulary: dict[str, str] = SKILLS,
) -> DataFrame:
    """Add the nine classification columns to rows with title, tags and experience.

    Roles come from the title, else from the tags; the first by mapping priority
    is primary, the others of the same text are secondary. Without a role, a
    group hint makes the posting ambiguous, nothing makes it insufficient.
    """
    kept = df.columns
    df = df.withColumn(
        "_tags", F.concat(normalized_tags(df, "remaining_tags"), normalized_tags(df, "visible_tags"))
    )
    df = df.withColumns({
        "_title_text": phrase_text(F.col("title")),
        "_tag_text": phrase_text_of_tags(F.col("_tags")),
        "_skill_title": skill_text(F.col("title")),
        "_skill_tags": skill_text_of_tags(F.col("_tags")),
    }).transform(parse_experience("experience", "_exp_years"))
    df = df.withColumns({
        "_title_roles": roles_in_text(F.col("_title_text"), roles),
        "_tag_roles": roles_in_text(F.col("_tag_text"), roles),
        "_hint": F.coalesce(group_hint(F.col("_title_text"), hints), group_hint(F.col("_tag_text"), hints)),
        "_level": seniority(F.col("_title_text"), F.col("_tag_text"), F.col("_exp_years")),
        "_skills": skills(F.col("_skill_title"), F.col("_skill_tags"), vocabulary),
    })
    group = group_of_role(F.get(chosen_roles(), F.lit(0)), roles)
    return classification(df, kept, group)


def chosen_roles() -> Column:
    """Roles of the title, else of the tags."""
    return F.when(F.size("_title_roles") > 0, F.col("_title_roles")).otherwise(F.col("_tag_roles"))


def classification(df: DataFrame, kept: list[str], group: Column) -> DataFrame:
    """The nine columns from _title_roles, _tag_roles, _hint, _level, _exp_years, _skills and the primary role's group."""
    df = df.withColumns({"_roles": chosen_roles(), "_group": group})
    df = df.withColumn("_primary", F.get("_roles", F.lit(0)))
    df = df.withColumn(
        "_status",
        F.when(F.col("_primary").isNotNull(), SUCCESS).when(F.col("_hint").isNotNull(), AMBIGUOUS).otherwise(INSUFFICIENT),
    )
    return df.select(
        *kept,
        F.coalesce("_group", "_hint").alias("role_group"),
        F.col("_primary").alias("primary_role"),
        F.slice("_roles", F.lit(2), F.greatest(F.size("_roles") - 1, F.lit(0))).alias("secondary_roles"),
        F.col("_level").alias("seniority"),
        F.col("_exp_years").alias("experience_years"),
        F.when(F.col("_status") == INSUFFICIENT, F.array().cast("array<string>")).otherwise(F.col("_skills")).alias("skills"),
        (F.size("_roles") > 1).alias("is_multi_role"),
        F.col("_status").alias("parse_status"),
        F.lit(None).cast("string").alias("parse_error"),
    )
