"""Ingest of response bodies: accounts of what is left out, crawls that end at a broken rule, the day from bodies."""

import datetime as dt
import json

from hirelake.plans.daily import Layout, run_day
from hirelake.plans.ingest import ingest, ingest_day
from hirelake.schemas import RAW_A, RAW_B
from hirelake.sources.snapshots import read_day
from hirelake.sources.workspace import shared_folder

DAY = dt.date(2024, 3, 7)
BODIES = "crawl_id string, asked_page int, scraped_at string, body string, page_text string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def listing(ids, page, pages, status="success"):
    cards = "".join(f'<div class="job-item-search-result" data-job-id="{i}"><h3 class="title"><a href="/j/{i}"><span title="Data Engineer {page}">x</span></a></h3></div>' for i in ids)
    html = f'<div class="job-list-search-result">{cards}</div>'
    return json.dumps({"status": status, "data": {"html_job": html, "total": 9, "total_page": pages, "current_page": page}})


def bodies(spark, *given):
    return spark.createDataFrame([(c, p, f"2024-03-07T01:00:0{c[-1]}", b, t) for c, p, b, t in given], BODIES)


def test_every_body_is_accounted_for(spark):
    given = bodies(
        spark, ("c1", 1, listing("ab", 1, 3), "1 / 3 trang"), ("c1", 2, listing("bc", 2, 3), None), ("c1", 3, listing("d", 3, 3, "error"), None), ("c1", 4, listing("e", 4, 3), None),
        ("c2", 1, listing("ab", 1, 3), None), ("c2", 2, listing("f", 7, 3), None), ("c2", 3, listing("g", 3, 3), None),
        ("c3", 1, None, None), ("c3", 2, "{", None), ("c4", 1, listing("", 1, 1), "1 / 2 trang"),
    )
    done = ingest(spark, given, "b", shared_folder(spark), "https://x.example/")
    assert rows(done.rejects) == [("c1", 3, "status_not_success"), ("c3", 1, "not_json"), ("c3", 2, "not_json")]
    assert [(r.crawl_id, r.asked_page, r.violation) for r in done.violations.orderBy("crawl_id").collect()] == [("c2", 2, "wrong_page_returned"), ("c4", 1, "shown_pages_differ")]
    assert rows(done.held) == [("c2", 2), ("c4", 1)] and rows(done.beyond) == [("c1", 4)]
    # Job b of the first crawl comes from its last page; the second crawl has its own b.
    assert rows(done.rows.select("job_id", "source_page", "scraped_at")) == [
        ("a", 1, "2024-03-07T01:00:01"), ("a", 1, "2024-03-07T01:00:02"), ("b", 1, "2024-03-07T01:00:02"), ("b", 2, "2024-03-07T01:00:01"), ("c", 2, "2024-03-07T01:00:01")]
    assert rows(done.ledger) == [("2024-03-07T01:00:01", 1, 2, 2, 2), ("2024-03-07T01:00:01", 2, 2, 1, 3), ("2024-03-07T01:00:02", 1, 2, 2, 2)]


def test_page_limit_and_links_of_board_a(spark):
    card = '<div class="job-card" data-job-key="{}"><h3><a href="/j/{}">Data Engineer</a></h3></div>'
    body = lambda ids: json.dumps({"jobs_html": "".join(card.format(i, i) for i in ids), "pagination_html": '<a href="?page=3">3</a>'})
    given = bodies(spark, *[("c1", p, body(f"{p}x"), None) for p in range(1, 6)])
    for limit, last in ((None, 3), (2, 2), (9, 3)):
        done = ingest(spark, given, "a", shared_folder(spark), "https://x.example/", limit=limit)
        assert [r.asked_page for r in done.beyond.orderBy("asked_page").collect()] == list(range(last + 1, 6))
        assert {r.job_id: r.source_page for r in done.rows.collect()} == {str(p): p for p in range(1, last + 1)} | {"x": last}
        assert done.violations.count() == 0


def test_no_bodies(spark):
    given = bodies(spark, ("c1", 1, listing("a", 1, 1), None)).limit(0)
    for board in "ab":
        done = ingest(spark, given, board, shared_folder(spark), "https://x.example/")
        assert all(df.count() == 0 for df in (done.rejects, done.violations, done.held, done.beyond, done.ledger, done.rows))


def test_day_starts_from_bodies(spark):
    root = shared_folder(spark)
    layout = Layout(root, "gold_ingest_test")
    card = '<div class="job-card" data-job-key="1"><h3><a href="/j/1">Data Engineer</a></h3></div>'
    body_a = json.dumps({"jobs_html": card, "pagination_html": ""})
    report = run_day(
        spark, layout, DAY, bodies_a=bodies(spark, ("c1", 1, body_a, None)), bodies_b=bodies(spark, ("c1", 1, listing("ab", 1, 1), None)), base_urls=("https://a.example/", "https://b.example/"),
    ).collect()
    assert len(report) == 1 and "**1**" in report[0].report
    assert read_day(spark, layout.raw("a"), DAY, RAW_A).count() == 1 and read_day(spark, layout.raw("b"), DAY, RAW_B).count() == 2
    # The same bodies once more: another snapshot, the same cleaned rows.
    ingest_day(spark, bodies(spark, ("c1", 1, listing("ab", 1, 1), None)), "b", layout.raw("b"), DAY, layout.work("b", DAY), "https://b.example/")
    assert read_day(spark, layout.raw("b"), DAY, RAW_B).count() == 4
    assert run_day(spark, layout, DAY).collect() == report


def test_plan_of_crawls_is_stored_before_the_markup_meets_it(spark):
    """Its size is then known, so markup is not shuffled to the few rows of a plan."""
    folder = shared_folder(spark)
    done = ingest(spark, bodies(spark, ("c1", 1, listing("ab", 1, 1), None), ("c1", 2, listing("c", 2, 1), None)), "b", folder, "https://x.example/")
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/plan").select("crawl_id", "last", "held_from").collect()] == [("c1", 1, None)]
    assert "BroadcastHashJoin" in done.beyond._jdf.queryExecution().executedPlan().toString()
    assert rows(done.beyond) == [("c1", 2)]


def test_markup_is_stored_in_small_files_and_not_kept(spark, monkeypatch):
    """A reader of whole pages holds thousands of rows of one file; all results come from the paging and the cards."""
    from hirelake.plans import ingest as plan
    from hirelake.sources.folders import names_in

    monkeypatch.setattr(plan, "FILE_PAGES", 2)
    given = bodies(spark, *[("c1", p, listing([f"j{p}"], p, 7), None) for p in range(1, 8)]).coalesce(1)
    folder = shared_folder(spark)
    whole = plan.decode_crawls(given, "b", f"{folder}/alone")
    files = [n for n in names_in(spark, f"{folder}/alone/decoded") if n.endswith(".parquet")]
    assert whole.count() == 7 and len(files) == 4 and all(".zstd" in n for n in files)
    done = ingest(spark, given, "b", f"{folder}/run", "https://x.example/")
    assert names_in(spark, f"{folder}/run") == ["cards", "paging", "plan"]
    assert [r.job_id for r in done.rows.orderBy("source_page").collect()] == [f"j{p}" for p in range(1, 8)]
    assert done.ledger.count() == 7 and done.rejects.count() == done.beyond.count() == done.violations.count() == 0
