"""Classification from mapping tables: equal to the inline path, and at home with very many phrases."""

import random

import pytest
from pyspark.sql import functions as F

from hirelake.functions.roles import GROUP_PHRASES, ROLES
from hirelake.functions.skills import SKILLS
from hirelake.operators.classify import classify
from hirelake.operators.classify_tables import classify_from_tables, phrase_index
from hirelake.operators.phrases import group_from_table
from tests.conftest import plan_of

POSTS = "job_id string, title string, visible_tags array<string>, remaining_tags string, experience string, roles string, phrase string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def tables(spark):
    roles = spark.createDataFrame([(p, r.name, r.group, i) for i, r in enumerate(ROLES) for p in r.phrases], "phrase string, role string, role_group string, priority int")
    hints = spark.createDataFrame([(p, g, i) for i, (g, ps) in enumerate(GROUP_PHRASES.items()) for p in ps], "phrase string, role_group string, priority int")
    return roles, hints, spark.createDataFrame(list(SKILLS.items()), "mention string, skill string")


def posts(spark, n):
    rng = random.Random(9)
    words = ["Data", "Engineer", "engineering", "Analyst", "Backend", "back end", "IT", "support", "SQL,Python", "React.js/NodeJS", "react", "Power  BI", "power", "BrSE", "UI", "UX", "designer", "thiết kế", "Sales", "|", "(Spark)", "kỹ sư dữ liệu", ""]
    pick = lambda k: " ".join(rng.choices(words, k=rng.randint(0, k)))
    out = [(str(i), rng.choice([pick(6), pick(6), None]), rng.choice([[pick(3) for _ in range(rng.randint(0, 4))], None]), rng.choice([None, "", pick(2) + "," + pick(2)]), rng.choice(["3 năm", None]), "own", "own") for i in range(n)]
    # One title on a third of the rows.
    return spark.createDataFrame(out + [(f"h{i}", "Data Engineer", ["SQL"], None, None, "own", "own") for i in range(n // 2)], POSTS).repartition(4)


def test_equal_to_the_inline_path(spark, tables):
    df = posts(spark, 400)
    got, want = classify_from_tables(df, *tables), classify(df)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_empty_tables(spark, tables):
    df = posts(spark, 10)
    assert classify_from_tables(df.limit(0), *tables).collect() == []
    none = [t.limit(0) for t in tables]
    assert {r.parse_status for r in classify_from_tables(df, *none).collect()} == {"insufficient_information"}


def test_a_hundred_thousand_phrases(spark, tables):
    roles, hints, skills = tables
    more = spark.range(100_000).select(F.concat(F.lit("senior engineer of thing"), F.col("id").cast("string")).alias("phrase"), F.concat(F.lit("Role "), F.col("id").cast("string")).alias("role"), F.lit("Other").alias("role_group"), F.lit(500).alias("priority"))
    index = phrase_index(roles.unionByName(more), hints, skills)
    # Each phrase stands under the word that no other has, not under those that all have.
    assert index.groupBy("form", "anchor").count().agg(F.max("count")).first()[0] < 10
    df = spark.createDataFrame([("1", "A senior engineer of thing777 and data engineer", [], None, None, "", ""), ("2", "senior engineer of", ["senior engineer of thing5"], None, None, "", "")], POSTS)
    got = {r.job_id: (r.primary_role, r.secondary_roles, r.role_group) for r in classify_from_tables(df, roles.unionByName(more), hints, skills).collect()}
    assert got == {"1": ("Data Engineer", ["Role 777"], "Data"), "2": ("Role 5", [], "Other")}


def test_group_lookup_reads_its_rows_once(spark):
    df = spark.createDataFrame([("1", "X"), ("2", None), ("3", "Y")], "job_id string, primary_role string").withColumn("up", F.upper("primary_role"))
    out = group_from_table(df, spark.createDataFrame([("X", "G")], "role string, role_group string"))
    assert rows(out.select("job_id", "role_group")) == [("1", "G"), ("2", None), ("3", "Other")]
    assert plan_of(out).count("upper(") == 1
