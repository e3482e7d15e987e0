import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from verification.compare import connect, differences
from verification.fixture import POSTINGS_SQL, TABLES, joined_rows, made_postings, postings
from verification.oracles import ORACLES
from verification.queries import QUERIES, crawled_pages, in_batches

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    n, problems = differences(spark, duck, SF, name)
    assert not problems and n > 0


@pytest.mark.parametrize("name", ["silver_a", "silver_b", "crawl_ledger", "join_parsed", "gold_top_skills", "role_group"])
def test_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["gold_city"](spark, SF))
    lineitem = next(line for line in plan.splitlines() if "FileScan parquet [l_" in line)
    assert "l_quantity" not in lineitem and "l_suppkey" not in lineitem


def test_join_parsed_parses_one_row_a_job(spark):
    """The parser's projections stand above the window that keeps the latest row."""
    plan = plan_of(QUERIES["join_parsed"](spark, SF)).splitlines()
    tokens = next(i for i, line in enumerate(plan) if "_tokens" in line)
    assert any("WindowGroupLimit" in line or "Window [" in line for line in plan[tokens:])
    assert not any("_tokens" in line for line in plan[max(i for i, line in enumerate(plan) if "WindowGroupLimit" in line):])


def joins_of(df) -> list[str]:
    """The joins of a plan without broadcasts, the last one first."""
    return [line for line in plan_of(df).splitlines() if "SortMergeJoin" in line]


def test_lines_meet_their_orders_last(spark):
    """Lines of an order lie together when a dedup by job begins, however large the tables are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "l_orderkey" in joins_of(postings(spark, SF))[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_postings_are_those_of_the_given_joins(spark, tmp_path):
    """Keys that repeat, are null or have no partner, in every table."""
    given = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz", [
            (o, p, 3, i, 7.0, None) for i, (o, p) in enumerate([(1, 5), (1, 5), (2, 5), (3, 6), (None, 5), (2, None), (9, 5), (4, 5), (5, 8)])]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1), (1, 2), (2, 1), (3, None), (None, 1), (4, 7), (5, 3)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(1, "a", 1), (2, "b", 1), (2, "c", 2), (None, "d", 1), (3, "e", None)]),
        "nation": ("n_nationkey int, n_name string", [(1, "x"), (2, "y"), (2, "z"), (None, "w")]),
        "part": ("p_partkey long, p_type string, p_brand string", [(5, "t", "u"), (5, "v", None), (6, None, None), (None, "t", "u"), (8, "t", "u")]),
    }
    for name, (schema, values) in given.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    as_written = spark.sql(POSTINGS_SQL, **{name: spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in TABLES})
    made = postings(spark, str(tmp_path))
    assert made.columns == as_written.columns
    assert sorted(map(str, made.collect())) == sorted(map(str, as_written.collect())) != []


def test_no_window_holds_the_cards_of_a_month(spark):
    plan = plan_of(crawled_pages(spark, SF, F.col("title"))).splitlines()
    at = lambda *names: [i for i, line in enumerate(plan) if any(n in line for n in names)]
    assert max(at("ObjectHashAggregate")) < min(at(" Window ", "- Window"))


def test_texts_of_crawled_pages_are_made_after_the_shuffle_by_month(spark):
    plan = plan_of(crawled_pages(spark, SF, F.col("job_url"))).splitlines()
    made = [i for i, line in enumerate(plan) if "jobs.example.com" in line]
    assert made and max(made) < min(i for i, line in enumerate(plan) if "Window " in line)
    rows = joined_rows(spark, SF)
    assert sorted(made_postings(rows).columns) == sorted(postings(spark, SF).columns)
    assert made_postings(rows).exceptAll(postings(spark, SF)).count() == postings(spark, SF).exceptAll(made_postings(rows)).count() == 0


def test_batches_are_stored_once(spark, tmp_path):
    days = ["1899-12-31", "1900-01-01", "1996-12-31", "1997-01-01", "1998-03-01", "9998-12-31", "9999-01-01", None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "position long, day string")
    other = spark.range(8).withColumnRenamed("id", "position")
    rows = rows.join(other.hint("merge"), "position").select("position", F.col("day").cast("date").alias("scraped_at"))
    bounds = ["1900-01-01", "1997-01-01", "1998-03-01", "9999-01-01"]
    parts = in_batches(rows, f"{tmp_path}/postings", bounds)
    assert [sorted(r.position for r in p.collect()) for p in parts] == [[1, 2], [3], [4, 5]]
    for p, low, high in zip(parts, bounds, bounds[1:]):
        assert p.schema == rows.schema and "Join" not in plan_of(p)
        assert sorted(p.collect()) == sorted(rows.where((F.col("scraped_at") >= low) & (F.col("scraped_at") < high)).collect())


def test_gold_from_changes_stores_what_postings_are_derived_from(spark, monkeypatch):
    from verification import queries

    class Seen(Exception):
        pass

    def seen(rows, folder, bounds):
        raise Seen(rows)

    monkeypatch.setattr(queries, "in_batches", seen)
    with pytest.raises(Seen) as found:
        QUERIES["gold_from_changes"](spark, SF)
    [rows] = found.value.args
    assert set(rows.columns) == {"scraped_at", "l", "c", "n", "p"}
    assert queries.made_postings(rows).exceptAll(postings(spark, SF)).count() == 0
