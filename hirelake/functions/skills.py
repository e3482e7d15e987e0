"""Canonical skills mentioned in a title or in tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import null_to_blank

# Mention (lower case, '/' as space) to canonical skill.
SKILLS = {
    "reactjs": "React",
    "react.js": "React",
    "react": "React",
    "nodejs": "Node.js",
    "node.js": "Node.js",
    "dotnet": ".NET",
    ".net": ".NET",
    "postgres": "PostgreSQL",
    "postgresql": "PostgreSQL",
    "sql": "SQL",
    "python": "Python",
    "java": "Java",
    "spark": "Spark",
    "power bi": "Power BI",
    "aws": "AWS",
    "bim": "BIM",
    "data labeling": "Data Labeling",
    "ui ux design": "UI/UX Design",
}
# Words are separated by single spaces, tags by this mark, in the texts searched.
_BORDER = "\x01"


def plain_words(text: Column) -> Column:
    """Lower-cased text in which one space stands for what separates words."""
    return F.regexp_replace(F.lower(text), r"[\s,/()|]+", " ")


def skill_text(title: Column) -> Column:
    """Title as ' word word '."""
    return F.concat(F.lit(" "), plain_words(null_to_blank(title)), F.lit(" "))


def skill_text_of_tags(tags: Column) -> Column:
    """Tags with a border on both sides of each."""
    joined = F.array_join(F.coalesce(tags, F.array().cast("array<string>")), _BORDER)
    return F.regexp_replace(F.concat(F.lit(_BORDER), plain_words(joined), F.lit(_BORDER)), f" *{_BORDER} *", _BORDER)


def _mentions(text: Column, border: str, vocabulary: dict[str, str]) -> Column:
    """Every skill standing between two borders, longest first at each place, in order."""
    names = "|".join(rf"\Q{k}\E" for k in sorted(vocabulary, key=len, reverse=True))
    return F.regexp_extract_all(text, F.lit(rf"(?<={border})(?=({names}){border})"), 1)


def skills(title_text: Column, tag_text: Column, vocabulary: dict[str, str] = SKILLS) -> Column:
    """Distinct canonical skills: title mentions first, then whole tags, in order.

    The texts come from `skill_text` and `skill_text_of_tags`; the keys of
    `vocabulary` are lower case with '/' written as a space.
    """
    found = F.concat(_mentions(title_text, " ", vocabulary), _mentions(tag_text, _BORDER, vocabulary))
    table = F.create_map(*[F.lit(x) for pair in vocabulary.items() for x in pair])
    return F.array_distinct(F.transform(found, lambda k: F.try_element_at(table, k)))
