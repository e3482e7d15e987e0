"""Seniority from keywords in title, then tags, else from years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import any_phrase, has_phrase

# Level keywords, as whole phrases with punctuation removed.
LEVEL_PHRASES = {
    "Intern": ["intern", "internship", "thực tập sinh"],
    "Fresher": ["fresher", "mới tốt nghiệp"],
    "Junior": ["junior", "jr"],
    "Middle": ["middle", "mid level", "intermediate"],
    "Senior": ["senior", "sr", "cao cấp", "cấp cao"],
    "Lead": ["lead", "team leader", "technical leader", "trưởng nhóm"],
    "Manager": ["manager", "quản lý", "phó phòng", "trưởng phòng", "head of"],
}
# Lower bound of years for each level, highest first.
LEVEL_BY_YEARS = [(5.0, "Senior"), (3.0, "Middle"), (1.0, "Junior"), (0.0, "Fresher")]
UNKNOWN_LEVEL = "Unknown"


def level_in_text(padded: Column) -> Column:
    """First level, in the order listed, whose keyword occurs in the text."""
    level = F.coalesce(*[F.when(has_phrase(padded, p), F.lit(level)) for level, p in LEVEL_PHRASES.items()])
    # Most texts name no level: one search for all keywords tells so, instead of one search for each.
    return F.when(padded.rlike(any_phrase(p for phrases in LEVEL_PHRASES.values() for p in phrases)), level)


def level_by_years(years: Column) -> Column:
    return F.coalesce(*[F.when(years >= low, F.lit(level)) for low, level in LEVEL_BY_YEARS])


def seniority(title: Column, tags: Column, years: Column) -> Column:
    """`title` and `tags` come from `phrase_text` and `phrase_text_of_tags`."""
    return F.coalesce(level_in_text(title), level_in_text(tags), level_by_years(years), F.lit(UNKNOWN_LEVEL))
