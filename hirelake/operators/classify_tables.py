"""Posting classification with mapping tables of any size.

All phrases go into one index, each under the rarest of its words and with that word's
place in it. The words of each different title and tag list meet the index in one
equi-join, a hit is compared with the words around it, and what is found comes back with
its place, so that order and longest match are those of the inline path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.experience import parse_experience
from hirelake.functions.seniority import seniority
from hirelake.functions.skills import plain_words, skill_text
from hirelake.functions.tags import normalized_tags
from hirelake.functions.text import phrase_text, phrase_text_of_tags
from hirelake.operators.classify import chosen_roles, classification
from hirelake.operators.stages import evaluated_once

_ENTRY = ["form", "kind", "words", "priority", "value", "grp"]
_NONE = "array<struct<value:string,grp:string>>"


def _split(text: Column) -> Column:
    return F.split(F.trim(text), " +")


def phrase_index(roles: DataFrame, hints: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(form, anchor, before, words, kind, priority, value, grp): a phrase under its rarest word, which `before` words precede.

    Forms: p for words of titles and tags, s for a title's skill words, t for whole tags. The rarest
    word is the one that fewest phrases of the form have, so common words lead to few candidates.
    """
    none = F.lit(None).cast("string")
    entry = lambda df, form, kind, words, priority, value, grp: df.select(
        F.lit(form).alias("form"), F.lit(kind).alias("kind"), words.alias("words"), priority.cast("long").alias("priority"), value.alias("value"), grp.alias("grp"))
    no_rank = F.lit(0)
    every = (
        entry(roles, "p", "role", _split(F.col("phrase")), F.col("priority"), F.col("role"), F.col("role_group"))
        .unionByName(entry(hints, "p", "hint", _split(F.col("phrase")), F.col("priority"), F.col("role_group"), none))
        .unionByName(entry(vocabulary, "s", "skill", _split(F.col("mention")), no_rank, F.col("skill"), none))
        .unionByName(entry(vocabulary, "t", "skill", F.array(F.trim("mention")), no_rank, F.col("skill"), none))
    ).distinct()
    placed = every.select(*_ENTRY, F.posexplode("words").alias("before", "anchor"))
    rarity = placed.groupBy("form", "anchor").agg(F.count("*").alias("n"))
    return placed.join(rarity, ["form", "anchor"]).groupBy(*_ENTRY).agg(
        F.min_by(F.struct("anchor", "before"), F.struct("n", "before")).alias("at")
    ).select(*_ENTRY, "at.anchor", "at.before")


def _tokens(texts: DataFrame, key: str, forms: dict[str, Column]) -> DataFrame:
    """(key, form, at, word, words) of every word of every form of the texts."""
    formed = F.array(*[F.struct(F.lit(form).alias("form"), words.alias("words")) for form, words in forms.items()])
    rows = evaluated_once(texts.withColumn("_f", F.explode(formed)).select(key, "_f.form", "_f.words"), "words")
    return rows.select(key, "form", "words", F.posexplode("words").alias("at", "word"))


def found_phrases(tokens: DataFrame, key: str, index: DataFrame) -> DataFrame:
    """(key, roles, hints, skills): arrays of (value, grp), roles and hints by priority, skills by place, each once."""
    entries = index.withColumnRenamed("words", "phrase").withColumnRenamed("anchor", "word")
    start = F.col("at") - F.col("before")
    length = F.size("phrase")
    here = (start >= 0) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, length) == F.col("phrase"))
    hits = tokens.join(entries, ["form", "word"]).where(here)
    # Of several skills that begin at a place, the longest; roles and hints all count.
    is_skill = F.col("kind") == "skill"
    longest = hits.groupBy(key, "kind", F.when(is_skill, start).alias("place"), F.when(~is_skill, F.col("value")).alias("one")).agg(
        F.max_by(F.struct("value", "grp"), F.struct(length, "value")).alias("best"), F.min("priority").alias("priority"))
    rank = F.coalesce(F.col("place").cast("long"), F.col("priority"))
    once = longest.groupBy(key, "kind", "best.value").agg(F.min(rank).alias("rank"), F.min_by("best.grp", rank).alias("grp"))
    found = once.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "value", "grp", "kind"))).alias("all"))
    of = lambda kind: F.transform(F.filter("all", lambda x: x["kind"] == kind), lambda x: F.struct(x["value"].alias("value"), x["grp"].alias("grp")))
    return found.select(key, of("role").alias("roles"), of("hint").alias("hints"), of("skill").alias("skills"))


def classify_from_tables(df: DataFrame, roles: DataFrame, hints: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """`classify` with its mappings as tables.

    roles (phrase, role, role_group, priority), hints (phrase, role_group, priority), vocabulary
    (mention, skill); phrases as in `phrase_text`, trimmed, mentions in lower case with '/' as a
    space. A role with several priorities has its least, a mention with several skills the last by name. Each different title and
    tag list is looked up once; rows join what was found by that text, so no row is matched twice.
    """
    kept = df.columns
    tags = F.concat(normalized_tags(df, "remaining_tags"), normalized_tags(df, "visible_tags"))
    df = df.withColumn("_tags", tags).withColumns({
        "_title_key": F.coalesce("title", F.lit("")), "_tags_key": F.array_join("_tags", "\x01"),
        "_title_text": phrase_text(F.col("title")), "_tag_text": phrase_text_of_tags(F.col("_tags")),
    }).transform(parse_experience("experience", "_exp_years"))
    index = phrase_index(roles, hints, vocabulary)
    # The lists are taken apart again from their keys, so that distinct works on plain text.
    titles = df.select("_title_key").distinct()
    lists = df.select("_tags_key").distinct().withColumn("_list", F.split("_tags_key", "\x01"))
    title_words = _tokens(titles, "_title_key", {"p": _split(phrase_text(F.col("_title_key"))), "s": _split(skill_text(F.col("_title_key")))})
    tag_words = _tokens(lists, "_tags_key", {"p": _split(phrase_text_of_tags(F.col("_list"))), "t": F.transform("_list", lambda t: F.trim(plain_words(t)))})
    for key, words, name in (("_title_key", title_words, "_of_title"), ("_tags_key", tag_words, "_of_tags")):
        found = found_phrases(words, key, index).select(key, F.struct("roles", "hints", "skills").alias(name))
        # Unhinted: broadcast only if small enough; a text of a third of all rows is split by skew handling.
        df = df.join(found, key, "left")
    part = lambda side, what: F.coalesce(F.col(f"{side}.{what}"), F.array().cast(_NONE))
    names = lambda found: F.transform(found, lambda x: x["value"])
    df = df.withColumns({
        "_title_roles": names(part("_of_title", "roles")), "_tag_roles": names(part("_of_tags", "roles")),
        "_groups": F.concat(part("_of_title", "roles"), part("_of_tags", "roles")),
        "_hint": F.coalesce(F.get(part("_of_title", "hints"), F.lit(0))["value"], F.get(part("_of_tags", "hints"), F.lit(0))["value"]),
        "_level": seniority(F.col("_title_text"), F.col("_tag_text"), F.col("_exp_years")),
        "_skills": F.array_distinct(F.concat(names(part("_of_title", "skills")), names(part("_of_tags", "skills")))),
    })
    primary = F.get(chosen_roles(), F.lit(0))
    group = F.get(F.filter("_groups", lambda x: x["value"] == primary), F.lit(0))["grp"]
    return classification(df, kept, F.when(primary.isNotNull(), F.coalesce(group, F.lit("Other"))))
