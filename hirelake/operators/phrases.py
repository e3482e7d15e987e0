"""Role lookup against a mapping table of any size, as an equi-join.

Each distinct text is cut into its word runs, and the runs are joined to the
phrases. Nothing compares every text with every phrase, so both sides may grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import phrase_text
from hirelake.operators.stages import evaluated_once


def word_runs(words, lengths: list[int]):
    """Distinct runs of the given numbers of words of an array of words."""
    return F.array_distinct(F.flatten(F.array(*[
        F.when(F.size(words) >= n, _runs_of(words, n)).otherwise(F.array().cast("array<string>"))
        for n in lengths
    ])))


def _runs_of(words, n: int):
    return F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))


def roles_from_table(df: DataFrame, text: str, mapping: DataFrame) -> DataFrame:
    """Roles of each distinct text: (text, roles) with roles by priority.

    `mapping` has phrase (as in `phrase_text`, trimmed), role and priority.
    Only runs of as many words as some phrase has are made, whatever that number
    is (the distinct numbers, a few integers, are read first). The text is made distinct
    first, so a title shared by a third of all postings is looked up once; the
    grouping is by text and merges partial sets before its shuffle.
    """
    texts = df.select(text).where(F.col(text).isNotNull()).distinct()
    lengths = [r.n for r in mapping.select(F.size(F.split(F.trim("phrase"), " +")).alias("n")).distinct().collect()]
    if not lengths:
        return texts.limit(0).withColumn("roles", F.array().cast("array<string>"))
    # Fixed before the runs' lambdas read it, which would else split the text for each.
    words = evaluated_once(texts.withColumn("_words", F.split(F.trim(phrase_text(F.col(text))), " ")), "_words")
    runs = words.select(text, F.explode(word_runs(F.col("_words"), sorted(lengths))).alias("phrase"))
    found = runs.join(mapping.select("phrase", "role", "priority"), "phrase")
    ranked = found.groupBy(text, "role").agg(F.min("priority").alias("priority"))
    return ranked.groupBy(text).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("priority", "role"))), lambda r: r["role"]).alias("roles")
    )


def group_from_table(df: DataFrame, groups: DataFrame, role: str = "primary_role") -> DataFrame:
    """Add role_group from a (role, role_group) table; unknown roles get 'Other'."""
    # Null roles match nothing; keys of their own keep them from meeting in one task, and the row is computed once.
    own = F.concat(F.lit("\x00"), F.pmod(F.monotonically_increasing_id(), F.lit(256)).cast("string"))
    keyed = df.withColumn("_role_key", F.coalesce(F.col(role), own))
    found = keyed.join(groups.select(F.col("role").alias("_role_key"), "role_group"), "_role_key", "left").drop("_role_key")
    return found.withColumn("role_group", F.when(F.col(role).isNotNull(), F.coalesce("role_group", F.lit("Other"))))
