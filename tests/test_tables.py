import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions.times import parse_time
from hirelake.operators.crawl import crawl_ledger, crawl_violations, running_total
from hirelake.operators.dedup import keep_latest, keep_latest_by_fallback
from hirelake.operators.enrich import enrich
from hirelake.operators.joins import join_parsed, unnest
from hirelake.operators.stages import evaluated_once
from hirelake.operators.profile import value_frequency
from hirelake.operators.upsert import merge_sql, upsert_version, upserted
from hirelake.plans import gold, report
from hirelake.plans.clean import clean_a
from hirelake.plans.daily import Layout, run_day
from hirelake.schemas import CLEAN_A, RAW_A, RAW_B
from hirelake.sources.csv_export import read_csv, write_csv
from hirelake.sources.snapshots import day_folder, read_day, write_snapshot
from hirelake.sources.tables import create_table, materialize, register, target_namespace
from hirelake.sources.versioned import VersionedTable
from hirelake.sources.workspace import shared_folder
from hirelake.streaming.incremental import upsert_new_snapshots
from tests.conftest import plan_of

KV = "job_id string, v int"
DAY = dt.date(2024, 3, 7)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def skewed(spark):
    """A third of all rows carry one key."""
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(200)}", i) for i in range(3_000)]
    return spark.createDataFrame(data, KV).repartition(6), data


def test_keep_latest_matches_brute_force_and_prunes_before_the_shuffle(skewed):
    df, data = skewed
    expected = {}
    for k, v in data:
        expected[k] = max(v, expected.get(k, -1))
    latest = keep_latest(df, "job_id", ["v"])
    assert dict(rows(latest)) == expected
    plan = plan_of(latest)
    partial, exchange = plan.rfind("Partial"), plan.rfind("Exchange hashpartitioning(job_id")
    assert "WindowGroupLimit" in plan and exchange < partial


def test_keep_latest_by_fallback(spark):
    df = spark.createDataFrame([("1", "u1", 1), (None, "u2", 2), ("", "u2", 3), ("", None, 4), (None, "", 5), ("1", "u9", 6)], "a string, b string, v int")
    assert sorted(r.v for r in keep_latest_by_fallback(df, ["a", "b"], ["v"]).collect()) == [3, 6]


def test_upsert_keeps_keys_unique_and_is_idempotent(spark):
    table = VersionedTable(spark, shared_folder(spark), spark.createDataFrame([], KV).schema)
    assert table.read().count() == 0 and table.current_version() is None
    upsert_version(table, spark.createDataFrame([("a", 1), ("b", 2)], KV))
    new = spark.createDataFrame([("b", 20), ("c", 30)], KV)
    upsert_version(table, new)
    once = rows(table.read())
    assert once == [("a", 1), ("b", 20), ("c", 30)]
    upsert_version(table, new)
    assert rows(table.read()) == once and table.current_version() == 3


def test_unfinished_version_is_not_read(spark):
    root = shared_folder(spark)
    table = VersionedTable(spark, root, spark.createDataFrame([], KV).schema)
    table.write(spark.createDataFrame([("a", 1)], KV))
    spark.createDataFrame([("x", 9)], KV).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v00000002")
    assert table.current_version() == 1 and rows(table.read()) == [("a", 1)]
    table.write(spark.createDataFrame([("b", 2)], KV))
    assert table.current_version() == 3


def test_null_key_is_inserted(spark):
    target, new = spark.createDataFrame([(None, 1)], KV), spark.createDataFrame([(None, 2)], KV)
    assert rows(upserted(target, new)) == [(None, 1), (None, 2)]


def test_merge_statement_parses(spark):
    sql = merge_sql("lake.clean_b", "new_rows")
    spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)


def test_snapshots_append_and_day_folder_is_unpadded(spark):
    root = shared_folder(spark)
    df = spark.createDataFrame([("a", 1)], KV)
    write_snapshot(df, root, DAY)
    write_snapshot(df, root, DAY)
    assert day_folder(root + "/", DAY) == f"{root}/2024-3-7"
    assert read_day(spark, root, DAY, df.schema).count() == 2


def test_csv_round_trip(spark):
    base = {f.name: "" for f in RAW_A} | {"skills": [], "benefits": [], "source_page": 1}
    odd = base | {"job_id": "1", "title": ' Kỹ sư "dữ liệu", C\\D ', "skills": ["a,b", 'x"y', "đ"], "extra": "no"}
    df = spark.createDataFrame([base, odd], T.StructType([*RAW_A.fields, T.StructField("extra", T.StringType())]))
    path = shared_folder(spark)
    write_csv(df, path)
    first = spark.read.format("binaryFile").load(path + "/*.csv").first().content
    assert bytes(first).startswith(b"\xef\xbb\xbfjob_id,slug,title")
    got = {r.job_id: r.asDict() for r in read_csv(spark, path).collect()}
    odd.pop("extra")
    assert got == {"": base, "1": odd}


def test_named_tables(spark):
    assert (target_namespace("  mart ", "gold"), target_namespace(None, "gold")) == ("mart", "gold")
    create_table(spark, "lake_t.clean_a", CLEAN_A, properties={"k": "v"})
    create_table(spark, "lake_t.clean_a", CLEAN_A)
    assert spark.table("lake_t.clean_a").schema.fieldNames() == CLEAN_A.fieldNames()
    name = materialize(spark.createDataFrame([("a", 1)], KV), "some_alias", " mart_t ", path=shared_folder(spark))
    assert name == "mart_t.some_alias" and rows(spark.table(name)) == [("a", 1)]
    register(spark.table(name), "a_view")
    assert spark.sql("select count(*) c from a_view").first().c == 1


def test_enrich_isolates_bad_rows(spark):
    schema = T.StructType.fromDDL("job_id string, n double, status string, message string")

    def double(row, session):
        session.append(row["job_id"])
        if row["v"] == 1:
            raise ValueError("bad one")
        return {"n": "text" if row["v"] == 2 else row["v"] * 2.0, "status": "success"}

    df = spark.createDataFrame([(f"j{i}", i) for i in range(6)], KV)
    got = {r.job_id: r for r in enrich(df, double, schema, defaults={"status": "error"}, error_column="message", open_session=list, partitions=3).collect()}
    assert [got[f"j{i}"].n for i in range(6)] == [0.0, None, None, 6.0, 8.0, 10.0]
    assert got["j1"].status == "error" and got["j1"].message == "bad one"
    assert got["j2"].status == "error" and got["j2"].message


def test_join_drops_null_keys_and_keeps_one_key(spark):
    joined = join_parsed(spark.createDataFrame([("a", 1), (None, 2)], KV), spark.createDataFrame([("a", 5), (None, 6)], "job_id string, w int"))
    assert joined.columns == ["job_id", "w", "v"] and rows(joined) == [("a", 5, 1)]


def test_unnest_drops_empty(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", None)], "job_id string, skills array<string>")
    assert rows(unnest(df, "skills", "skill").select("job_id", "skill")) == [("a", "x"), ("a", "y")]


def test_running_total_and_ledger_against_brute_force(spark):
    rng = random.Random(3)
    data = [("c1" if rng.random() < 0.7 else "c2", rng.randrange(60), rng.choice(["hot", None, *map(str, range(40))])) for _ in range(2_000)]
    df = spark.createDataFrame(data, "crawl string, page int, key string")
    expected = []
    for crawl in ("c1", "c2"):
        seen = set()
        for page in sorted({p for c, p, _ in data if c == crawl}):
            on_page = [k for c, p, k in data if (c, p) == (crawl, page)]
            new = {k for k in on_page if k is not None} - seen
            seen |= new
            expected.append((crawl, page, len(on_page), len(new), len(seen)))
    assert rows(crawl_ledger(df, "crawl", "page", "key", width=7)) == sorted(expected, key=str)
    simple = running_total(spark.createDataFrame([("g", i, 1) for i in range(25)], "g string, o int, v int"), "g", "o", "v", "s", width=4)
    assert sorted((r.o, r.s) for r in simple.collect()) == [(i, i + 1) for i in range(25)]


def test_crawl_violations(spark):
    pages = spark.createDataFrame(
        [("ok", 1, 1, 2, 2), ("ok", 2, 2, 2, None), ("bad", 1, 2, 3, 4), ("bad", 2, 5, 9, None)],
        "crawl_id string, asked_page int, current_page int, total_page int, shown_pages int",
    )
    got = sorted((r.crawl_id, r.asked_page, r.violation) for r in crawl_violations(pages).collect())
    assert got == [
        ("bad", 1, "first_page_not_1"), ("bad", 1, "shown_pages_differ"),
        ("bad", 2, "total_page_changed"), ("bad", 2, "wrong_page_returned"),
    ]


def test_filter_stays_above_evaluated_columns(spark):
    df = evaluated_once(spark.range(10).withColumn("x", F.regexp_replace(F.col("id").cast("string"), "1", "2")), "x").where("x = '2'")
    plan = plan_of(df)
    assert plan.find("Filter") < plan.find("Generate") and [r.id for r in df.collect()] in ([1, 2], [2, 1])


def test_times(spark):
    texts = ["2024-01-02T03:04:05.5+00:00", "2024-01-02T03:04:05", "2024-01-02", "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.m for r in df.select("i", F.unix_micros(parse_time(F.col("t"), "Asia/Ho_Chi_Minh")).alias("m")).orderBy("i").collect()]
    assert got == [1704164645500000, 1704139445000000, 1704128400000000, None, None]


def test_gold_edge_cases(spark):
    b = spark.createDataFrame(
        [("1", None, None, "A", 1.0, 2.0, "USD", 1.05, "Data Engineer"), ("2", "HN", "Unknown", None, None, 3.0, "VND", None, None)],
        "job_id string, city string, seniority string, primary_role string, salary_min double, salary_max double, salary_currency string, experience_years double, other string",
    )
    assert rows(gold.city_counts(b)) == [("HN", 1), (None, 1)]
    assert rows(gold.role_trend(b)) == [("A", 1), (None, 0)]
    assert rows(gold.seniority_counts(b)) == [("Unknown", 1)]
    assert rows(gold.average_salary(b)) == [(26000.0, (52000.0 + 3.0) / 2)]
    assert rows(gold.average_salary(b.limit(0))) == [(None, None)]
    assert rows(gold.data_roles(b)) == []
    assert rows(value_frequency(b, "city", "n")) == [("HN", 1), (None, 0)]


def test_report_without_data(spark):
    a = spark.createDataFrame([], CLEAN_A)
    b = spark.createDataFrame([], "job_id string, city string, seniority string, primary_role string, salary_min double, salary_max double, salary_currency string, experience_years double")
    text = report.report_text(gold.build_all(a, b), DAY).first().report
    assert "07/03/2024" in text and text.count(report.NO_DATA) == 6 and "**0**" in text
    assert "CartesianProduct" not in plan_of(report.report_text(gold.build_all(a, b), DAY))


def raw(spark, schema, **values):
    given = {f.name: [] if isinstance(f.dataType, T.ArrayType) else False if isinstance(f.dataType, T.BooleanType) else None for f in schema}
    return spark.createDataFrame([{**given, **values, "source_page": 1}], schema)


def test_daily_run_twice_leaves_the_same_rows(spark):
    layout = Layout(shared_folder(spark), "gold_twice")
    a = raw(spark, RAW_A, job_id="1", title="Data Engineer", salary="Up to $2200", skills=["SQL"], scraped_at="2024-03-07T01:00:00+00:00")
    b = raw(spark, RAW_B, job_id="9", title="Data Analyst", salary="10 - 20 triệu", experience="2 năm", city="HN", scraped_at="2024-03-07T01:00:00")
    first = run_day(spark, layout, DAY, a, b).first().report
    second = run_day(spark, layout, DAY, a, b).first().report
    assert first == second
    for part in ("**1**", "1. SQL — 1 tin", "• Junior: 1 tin", "10,000,000 — 20,000,000", "1. HN — 1 tin", "1. Data Analyst — 1 tin (KN TB: 2.0 năm)"):
        assert part in first


def test_incremental_reads_each_file_once(spark):
    folder = shared_folder(spark)
    schema = spark.createDataFrame([], KV).schema
    table = VersionedTable(spark, folder + "/t", schema)
    seen = []

    def prepare(df):
        seen.append(df.count())
        return df

    def run(compare=True):
        return rows(upsert_new_snapshots(spark, folder + "/raw", schema, table, folder + "/c", ["v"], prepare=prepare, compare=compare))

    write_snapshot(spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], KV), folder + "/raw", DAY)
    assert run() == [("a", 2)]
    # A file that comes late does not take back a later row, unless asked to win as in MERGE.
    write_snapshot(spark.createDataFrame([("a", 1), ("b", 1)], KV), folder + "/raw", DAY + dt.timedelta(days=1))
    assert run() == [("a", 2), ("b", 1)]
    assert run() == [("a", 2), ("b", 1)] and seen == [1, 2]
    write_snapshot(spark.createDataFrame([("a", 0)], KV), folder + "/raw", DAY - dt.timedelta(days=1))
    assert run(compare=False) == [("a", 0), ("b", 1)]


def test_upsert_runs_a_costly_source_once_and_retires_versions(spark):
    calls = spark.sparkContext.accumulator(0)

    def answer(row, _):
        calls.add(1)
        return {"v": row["v"] + 1}

    folder = shared_folder(spark)
    schema = spark.createDataFrame([], KV).schema
    table = VersionedTable(spark, folder, schema)
    for day in range(4):
        given = spark.createDataFrame([(f"k{i}", day) for i in range(50)], KV)
        upsert_version(table, enrich(given, answer, schema))
    assert calls.value == 200 and {r[1] for r in rows(table.read())} == {4}
    left = sorted(p.name for p in pathlib.Path(folder.removeprefix("file:")).iterdir() if p.is_dir())
    assert left == ["v00000003", "v00000004"]


def test_a_null_in_a_required_field_becomes_an_error_row(spark):
    out_schema = T.StructType([T.StructField("job_id", T.StringType(), False), T.StructField("v", T.LongType(), False), T.StructField("e", T.StringType())])
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], KV)
    got = enrich(df, lambda row, _: {"v": None if row["v"] == 2 else row["v"]}, out_schema, defaults={"v": -1}, error_column="e").collect()
    assert sorted((r.job_id, r.v, r.e is None) for r in got) == [("a", 1, True), ("b", -1, False), ("c", 3, True)]


def test_latest_is_by_instant_not_by_text(spark):
    times = ["2024-03-07T09:00:00+07:00", "2024-03-07T05:00:00+00:00", "not a time", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "scraped_at string, i int").withColumn("job_id", F.lit("j"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_A if f.name not in ("job_id", "scraped_at", "source_page")]
    raw = df.select("job_id", "scraped_at", F.col("i").cast("bigint").alias("source_page"), *blank)
    row = clean_a(raw).first()
    assert str(row.scraped_at) == "2024-03-07 05:00:00"
