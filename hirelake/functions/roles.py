"""Roles named in a text, by whole-phrase match against a mapping."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import has_phrase

class Role(NamedTuple):
    name: str
    group: str
    phrases: list[str]


# The role groups.
ROLE_GROUPS = [
    "Data", "Software Engineering", "Information Technology", "Design", "Product", "Sales",
    "Marketing", "Human Resources", "Accounting", "Construction & Engineering", "Other",
]
# Role, group and the phrases that name it, by priority.
ROLES = [
    Role("Data Engineer", "Data", ["data engineer", "data engineering", "kỹ sư dữ liệu"]),
    Role("Data Analyst", "Data", ["data analyst"]),
    Role("Data Labeler", "Data", ["data labeler", "data labeling", "content labeler", "gán nhãn dữ liệu"]),
    Role("Backend Developer", "Software Engineering", ["backend developer", "backend", "back end"]),
    Role("Frontend Developer", "Software Engineering",
         ["frontend developer", "front end developer", "lập trình viên frontend", "frontend", "front end"]),
    Role("Mobile Developer", "Software Engineering", ["mobile developer"]),
    Role("Network Engineer", "Information Technology", ["network engineer"]),
    Role("IT Support Specialist", "Information Technology", ["it support", "it helpdesk", "nhân viên hỗ trợ it"]),
    Role("System Administrator", "Information Technology", ["system administrator"]),
    Role("Bridge System Engineer", "Information Technology", ["brse", "bridge system engineer", "kỹ sư cầu nối"]),
    Role("Business Analyst", "Information Technology", ["business analyst", "bridge ba"]),
    Role("Graphic Designer", "Design", ["graphic designer", "thiết kế đồ họa"]),
    Role("UI/UX Designer", "Design", ["ui ux designer", "ui ux design", "thiết kế giao diện"]),
    Role("Product Owner", "Product", ["product owner"]),
    Role("Product Manager", "Product", ["product manager"]),
    Role("BIM Specialist", "Construction & Engineering", ["bim"]),
]
# Words that show a group without naming a role.
GROUP_PHRASES = {
    "Data": ["data"],
    "Software Engineering": ["software engineering"],
    "Information Technology": ["information technology", "it"],
    "Design": ["design", "thiết kế"],
    "Product": ["product"],
    "Sales": ["sales"],
    "Marketing": ["marketing"],
    "Human Resources": ["human resources"],
    "Accounting": ["accounting"],
    "Construction & Engineering": ["construction"],
}


def _distinct_present(values: list[Column]) -> Column:
    return F.array_except(F.array(*values), F.array(F.lit(None).cast("string")))


def roles_in_text(padded: Column, roles: list[Role] = ROLES) -> Column:
    """Distinct role names in the text, by mapping priority.

    One test a phrase, whatever their number; a mapping of thousands is faster as
    a table, see hirelake.operators.phrases.roles_from_table.
    """
    return _distinct_present([F.when(has_phrase(padded, r.phrases), F.lit(r.name)) for r in roles])


def group_hint(padded: Column, hints: dict[str, list[str]] = GROUP_PHRASES) -> Column:
    return F.coalesce(*[F.when(has_phrase(padded, p), F.lit(group)) for group, p in hints.items()])


def group_of_role(role: Column, roles: list[Role] = ROLES) -> Column:
    """Group of a role name; 'Other' for a role outside the mapping, null for null."""
    by_group: dict[str, list[str]] = {}
    for r in roles:
        by_group.setdefault(r.group, []).append(r.name)
    known = F.coalesce(*[F.when(role.isin(names), F.lit(group)) for group, names in by_group.items()])
    return F.when(role.isNotNull(), F.coalesce(known, F.lit("Other")))
