import pytest

from hirelake.functions.experience import experience_error, parse_experience
from hirelake.functions.replies import decode_classification, decode_salary, prompt_record
from hirelake.functions.roles import ROLES
from hirelake.functions.seniority import LEVEL_PHRASES, level_in_text
from hirelake.functions.tags import normalized_tags
from hirelake.functions.text import SPACE_CHARS, squeeze
from hirelake.operators.classify import classify
from hirelake.operators.phrases import group_from_table, roles_from_table
from pyspark.sql import functions as F
from tests.conftest import plan_of

SCHEMA = "title string, remaining_tags array<string>, visible_tags array<string>, experience string"
# (title, tags, visible, experience) -> (group, primary, secondary, seniority, years, skills, multi, status)
GOLDEN = [
    (("Network Engineer", ["Network Engineer"], [], "1 năm"),
     ("Information Technology", "Network Engineer", [], "Junior", 1.0, [], False, "success")),
    (("Nhân Viên IT Support", ["IT Helpdesk/IT Support"], [], "1 năm"),
     ("Information Technology", "IT Support Specialist", [], "Junior", 1.0, [], False, "success")),
    (("BrSE - Bridge BA", ["Kỹ sư cầu nối BrSE", "Business Analyst"], [], "1 năm"),
     ("Information Technology", "Bridge System Engineer", ["Business Analyst"], "Junior", 1.0, [], True, "success")),
    (("Senior Graphic Designer", ["Thiết kế đồ họa"], [], "2 năm"),
     ("Design", "Graphic Designer", [], "Senior", 2.0, [], False, "success")),
    (("Nhân Viên Thiết Kế", ["UI/UX Design"], [], "Không yêu cầu"),
     ("Design", "UI/UX Designer", [], "Fresher", 0.0, ["UI/UX Design"], False, "success")),
    (("Nhân Viên IT", [], ["1 năm kinh nghiệm"], "1 năm"),
     ("Information Technology", None, [], "Junior", 1.0, [], False, "ambiguous")),
    (("Tuyển Gấp", [], ["1 năm kinh nghiệm"], "1 năm"),
     (None, None, [], "Junior", 1.0, [], False, "insufficient_information")),
]
FIELDS = [
    "role_group", "primary_role", "secondary_roles", "seniority", "experience_years", "skills", "is_multi_role", "parse_status",
]


@pytest.mark.parametrize("row,expected", GOLDEN, ids=[g[0][0] for g in GOLDEN])
def test_worked_examples(spark, row, expected):
    got = classify(spark.createDataFrame([row], SCHEMA)).select(*FIELDS).first()
    assert tuple(got) == expected


def test_level_and_skill_rules(spark):
    rows = [
        ("BIM Team Leader", None, None, "1 năm"), ("Backend Developer", ["Jr."], [], None),
        ("Head of Sales", [], [], "2 năm"), ("ReactJS / Node.js dev (.NET, Power BI)", [" react ", "Python"], ["nodejs"], "5 năm"),
        (None, None, None, None),
    ]
    got = classify(spark.createDataFrame(rows, SCHEMA)).select("primary_role", "role_group", "seniority", "skills").collect()
    assert [tuple(r) for r in got[:3]] == [
        ("BIM Specialist", "Construction & Engineering", "Lead", ["BIM"]),
        ("Backend Developer", "Software Engineering", "Junior", []),
        (None, "Sales", "Manager", []),
    ]
    assert got[3].seniority == "Senior" and got[3].skills == []
    assert tuple(got[4]) == (None, None, "Unknown", [])


def test_skills_keep_title_order_then_tags(spark):
    row = ("Data Engineer Python/ReactJS, Power BI", ["react", " Postgres ", "PYTHON"], ["AWS"], None)
    got = classify(spark.createDataFrame([row], SCHEMA)).first()
    assert got.skills == ["Python", "React", "Power BI", "PostgreSQL", "AWS"]


def test_classification_stays_in_the_jvm(spark):
    plan = plan_of(classify(spark.createDataFrame([GOLDEN[0][0]], SCHEMA)))
    assert not any(w in plan for w in ("EvalPython", "InArrow", "InPandas", "Exchange"))


EXPERIENCE = {
    "Không yêu cầu": 0.0, "Không yêu cầu kinh nghiệm": 0.0, "3 năm": 3.0, "Trên 3 năm": 3.5, "Dưới 3 năm": 2.5,
    "Dưới 0 năm": 0.0, "3-4 năm": 3.5, "3 – 4 năm": 3.5, "Từ 2 đến 4 năm": 3.0, "Từ 2 năm đến 4 năm": 3.0,
    "1 năm 6 tháng": 1.5, "1 năm 3 tháng": 1.5, "1 năm 2 tháng": 1.0, "Ít nhất 2 năm": 2.0, "Tối thiểu 5 năm": 5.0,
    "Từ 1 năm": 1.0, "Kinh nghiệm trên 5 năm": 5.5, "nhiều năm": None, "": None, None: None, "6 tháng": None,
}


def test_experience_years(spark):
    df = spark.createDataFrame([(t,) for t in EXPERIENCE], "experience string").transform(parse_experience())
    assert {r.experience: r.experience_years for r in df.collect()} == EXPERIENCE


def test_experience_error(spark):
    values = {0.0: None, 1.5: None, -0.5: "not_finite_or_negative", 0.3: "not_half_step", float("inf"): "not_finite_or_negative"}
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.e for r in df.select("v", experience_error(F.col("v")).alias("e")).collect()}
    assert got == values
    assert spark.range(1).select(experience_error(F.lit(float("nan"))).alias("e")).first().e == "not_finite_or_negative"


def test_tags(spark):
    df = spark.createDataFrame([(" a , ,b,", ["x ", None, ""]), (None, None)], "t string, a array<string>")
    got = df.select(normalized_tags(df, "t").alias("t"), normalized_tags(df, "a").alias("a")).collect()
    assert [tuple(r) for r in got] == [(["a", "b"], ["x"]), ([], [])]
    numbers = spark.range(1)
    with pytest.raises(TypeError):
        normalized_tags(numbers, "id")


def test_mapping_table_agrees_with_inline_rules(spark):
    titles = [(g[0][0],) for g in GOLDEN] + [("Front-end / Backend developer",), ("BIM",), (None,)]
    df = spark.createDataFrame(titles, "title string")
    mapping = spark.createDataFrame(
        [(p, r.name, i) for i, r in enumerate(ROLES) for p in r.phrases], "phrase string, role string, priority int"
    )
    table = {r.title: r.roles for r in roles_from_table(df, "title", mapping).collect()}
    inline = classify(df.selectExpr("title", "null as remaining_tags", "null as visible_tags", "'' as experience").selectExpr(
        "title", "cast(remaining_tags as string) remaining_tags", "cast(visible_tags as string) visible_tags", "experience"))
    for r in inline.collect():
        expected = [r.primary_role, *r.secondary_roles] if r.primary_role else None
        assert table.get(r.title) == expected, r.title
    assert "Cartesian" not in plan_of(roles_from_table(df, "title", mapping))


def test_group_from_table(spark):
    groups = spark.createDataFrame([("A", "G")], "role string, role_group string")
    df = spark.createDataFrame([("A",), ("B",), (None,)], "primary_role string")
    assert {r.primary_role: r.role_group for r in group_from_table(df, groups).collect()} == {"A": "G", "B": "Other", None: None}


def test_decode_classification(spark):
    replies = {
        '{"experience_years": 2, "skills": ["SQL"], "parse_status": "ambiguous"}': ("Unknown", 2.0, ["SQL"], "ambiguous", None),
        '{"experience_years": null}': ("Unknown", None, [], "success", None),
        '{"skills": []}': ("Unknown", None, [], "error", "missing_experience_years"),
        '{"experience_years": "2"}': ("Unknown", None, [], "error", "not_a_valid_reply"),
        '{"experience_years": true}': ("Unknown", None, [], "error", "not_a_valid_reply"),
        '{"experience_years": 2, "seniority": "Boss"}': ("Unknown", None, [], "error", "unknown_seniority"),
        '{"experience_years": 2, "parse_status": "?"}': ("Unknown", None, [], "error", "unknown_parse_status"),
        "not json": ("Unknown", None, [], "error", "not_a_valid_reply"),
        None: ("Unknown", None, [], "error", "not_a_valid_reply"),
    }
    df = spark.createDataFrame([(r,) for r in replies], "reply string").withColumn("raw", F.col("reply"))
    for r in decode_classification(df).collect():
        assert (r.seniority, r.experience_years, r.skills, r.parse_status, r.parse_error) == replies[r.raw], r.raw


def test_decode_salary(spark):
    replies = {
        '{"min_salary": 800, "max_salary": 1500.5, "currency": "USD", "period": null, "parse_status": "success"}': (800.0, 1500.5, "USD", "success"),
        '{"min_salary": 1, "currency": "EUR", "parse_status": "success"}': (None, None, None, "failed"),
        '{"min_salary": 1}': (None, None, None, "failed"),
        "x": (None, None, None, "failed"),
    }
    df = spark.createDataFrame([(r,) for r in replies], "reply string").withColumn("raw", F.col("reply"))
    for r in decode_salary(df).collect():
        assert (r.min_salary, r.max_salary, r.currency, r.parse_status) == replies[r.raw], r.raw


def test_prompt_record_keeps_nulls_and_characters(spark):
    df = spark.createDataFrame([("1", "Kỹ sư", " a ,", None, None)], "job_id string, title string, remaining_tags string, visible_tags array<string>, experience string")
    assert df.select(prompt_record(df).alias("r")).first().r == (
        '{"job_id":"1","title":"Kỹ sư","remaining_tags":["a"],"visible_tags":[],"experience":null}'
    )


def test_mapping_phrases_of_any_length_and_number(spark):
    long = "chuyên viên phân tích dữ liệu cao cấp"
    many = [(f"phrase {i}", f"Role {i}", i) for i in range(5_000)] + [(long, "Analyst", 9_000)]
    mapping = spark.createDataFrame(many, "phrase string, role string, priority int")
    df = spark.createDataFrame([("Tuyển " + long.upper() + " gấp",), ("a phrase 4999 here",), ("nothing",), (None,)], "title string")
    assert {r.title: r.roles for r in roles_from_table(df, "title", mapping).collect()} == {
        "Tuyển " + long.upper() + " gấp": ["Analyst"], "a phrase 4999 here": ["Role 4999"]}
    assert roles_from_table(df, "title", mapping.limit(0)).collect() == []


def test_a_text_without_level_is_searched_once(spark):
    """The level of every keyword, between other words and inside one; the search for all keywords comes before those for each."""
    phrases = [(level, p) for level, of in LEVEL_PHRASES.items() for p in of]
    texts = [(f" a {p} b ", level) for level, p in phrases] + [(f" a{p}b ", None) for _, p in phrases] + [(" senior intern ", "Intern"), (" ", None)]
    found = spark.createDataFrame(texts, "text string, level string").select("level", level_in_text(F.col("text")).alias("found"))
    assert all(r.level == r.found for r in found.collect())
    assert "RLIKE" in found._jdf.queryExecution().analyzed().toString()


def test_squeeze_knows_every_whitespace(spark):
    texts = [f"{a}x{b}y{a}" for a in ("", " ", "  ", *SPACE_CHARS) for b in ["", *SPACE_CHARS, *[c + " " for c in SPACE_CHARS], *[" " + c for c in SPACE_CHARS], "   "]]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select("text", squeeze(F.col("text")).alias("out"))
    assert all(r.out == " ".join(r.text.split()) for r in frame.collect())
