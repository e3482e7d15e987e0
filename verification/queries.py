"""One query per operator, each over the whole given tables."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import urls
from hirelake.functions.experience import experience_error, parse_experience
from hirelake.functions.replies import decode_classification, decode_salary, prompt_record
from hirelake.functions.roles import GROUP_PHRASES, ROLES
from hirelake.functions.salary_freeform import parse_freeform_salary
from hirelake.functions.skills import SKILLS
from hirelake.functions.salary_token import flatten_salary, parse_salary
from hirelake.functions.tags import normalized_tags
from hirelake.functions.text import clean_or_blank, clean_or_null, drop_prefix_ci, first_present
from hirelake.functions.times import parse_time
from hirelake.operators import html_columns
from hirelake.operators.answers import CallPlan, answers_schema, enrich_known
from hirelake.operators.board_cards import cards_a, cards_b, classes_of, first_class_with_prefix, nonempty_texts
from hirelake.operators.classify import classify
from hirelake.operators.classify_tables import classify_from_tables
from hirelake.operators.crawl import crawl_ledger, crawl_violations
from hirelake.operators.dedup import keep_latest, keep_latest_by_fallback
from hirelake.operators.enrich import enrich
from hirelake.operators.joins import join_parsed
from hirelake.operators.phrases import group_from_table, roles_from_table
from hirelake.operators.profile import count_by, value_frequency
from hirelake.operators.stages import evaluated_once
from hirelake.operators.upsert import upsert_buckets, upsert_version
from hirelake.plans import gold, gold_state, ingest, report
from hirelake.plans.clean import clean_a, clean_b
from hirelake.plans.daily import Layout, run_day
from hirelake.plans.gold import build_all
from hirelake.schemas import CLEAN_A, CLEAN_B, RAW_A
from hirelake.sources.bucketed import BucketedTable
from hirelake.sources.csv_export import read_csv, write_csv
from hirelake.sources.responses import decode_fragments, decode_listing
from hirelake.sources.snapshots import read_day, read_days, write_snapshot
from hirelake.sources.tables import materialize
from hirelake.sources.versioned import VersionedTable
from hirelake.sources.workspace import shared_folder
from hirelake.streaming.incremental import upsert_new_snapshots
from verification.fixture import LINE_IDENTITY, ORDER, joined_rows, made_postings, postings, spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BASE_URL = "https://jobs.example.com/"
DAY = dt.date(2024, 3, 7)
ROW = ["job_id", "source_page", "position", "scraped_at"]


def named(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def query(fn: Query) -> Query:
    return named(fn.__name__)(fn)


def joined(array: Column | str) -> Column:
    """Array as text, so that both engines compare plain strings."""
    return F.array_join(array, "|")


def as_text(df: DataFrame) -> DataFrame:
    """Arrays joined, times as text."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.ArrayType):
            out.append(joined(f.name).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.col(f.name).cast("timestamp_ntz").cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def raw_a(df: DataFrame) -> DataFrame:
    """The postings in board A's raw columns (missing text is '')."""
    return df.select(
        "job_id", F.concat(F.lit("job-"), "job_id").alias("slug"), "title", "job_url", "company_name",
        F.lit("").alias("company_url"), F.lit("").alias("company_logo"),
        F.coalesce("salary_freeform", F.lit("")).alias("salary"),
        F.lit("").alias("job_category"), F.lit("Hybrid").alias("working_model"),
        F.col("city").alias("location"), F.col("visible_tags").alias("skills"),
        F.split(F.coalesce("remaining_tags", F.lit("")), ",").alias("benefits"), F.lit("").alias("label"),
        "posted_at", F.col("source_page").cast("bigint").alias("source_page"), "scraped_at", "position",
    )


def raw_b(df: DataFrame) -> DataFrame:
    """The postings with board B's link and verification columns."""
    return df.withColumns({
        "apply_url": F.concat(F.lit(BASE_URL + "apply/"), "job_id"),
        "verification_level": F.concat(F.lit("level-"), F.col("source_page").cast("string")),
    })


def cleaned_a(spark: SparkSession, sf: str) -> DataFrame:
    return clean_a(raw_a(postings(spark, sf)), ORDER)


def cleaned_b(spark: SparkSession, sf: str) -> DataFrame:
    return clean_b(raw_b(postings(spark, sf)), ORDER)


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"), "page_id")


# --- scans, sources, sinks -------------------------------------------------


@query
def scan_day_snapshot(spark, sf):
    rows = postings(spark, sf).withColumn("scraped_at", F.col("scraped_at").cast("string"))
    root = shared_folder(spark)
    write_snapshot(rows.where("position % 2 = 0"), root, DAY)
    write_snapshot(rows.where("position % 2 = 1"), root, DAY)
    return as_text(read_day(spark, root, DAY, rows.schema))


@query
def scan_day_range(spark, sf):
    """Snapshots of seven days, of which the middle ones are read."""
    rows = as_small(postings(spark, sf)).withColumn("scraped_at", F.col("scraped_at").cast("string"))
    root = shared_folder(spark)
    for i in range(7):
        write_snapshot(rows.where(F.year("scraped_at") == 1992 + i), root, dt.date(2024, 2, 27) + dt.timedelta(days=i))
    read = read_days(spark, root, dt.date(2024, 2, 28), dt.date(2024, 3, 1), rows.schema)
    return as_text(read.withColumn("day", F.col("day").cast("string")))


@query
def page_response_decode(spark, sf):
    """Bodies of eight kinds made from `pages`, then decoded and validated."""
    kind = F.col("page_id") % 8
    html = F.regexp_replace(F.to_json(F.struct("html")), r'^\{"html":|\}$', "")
    body = F.concat(
        F.lit('{"status":'), F.when(kind == 1, F.lit('"error"')).otherwise(F.lit('"success"')),
        F.lit(',"data":'),
        F.when(kind == 2, F.lit("null")).otherwise(F.concat(
            F.lit('{"html_job":'), F.when(kind == 3, F.lit("12")).otherwise(html),
            F.when(kind == 7, F.lit("")).otherwise(F.concat(F.lit(',"total":'), F.col("page_id").cast("string"))),
            F.lit(',"total_page":'), F.when(kind == 4, F.lit("0")).otherwise(F.lit('" 12 "')),
            F.lit(',"current_page":'), F.when(kind == 5, F.lit('"x"')).otherwise(F.lit("3.7")), F.lit("}"),
        )),
        F.when(kind == 6, F.lit("")).otherwise(F.lit("}")),
    )
    decoded = decode_listing(pages(spark, sf).select("page_id", body.alias("body")))
    return decoded.select("page_id", F.md5("html").alias("html_md5"), "total", "total_page", "current_page", "reject_reason")


@query
def page_fragments_decode(spark, sf):
    """Board A envelopes of five kinds made from `pages`, then decoded and validated."""
    kind = F.col("page_id") % 5
    html = F.regexp_replace(F.to_json(F.struct("html")), r'^\{"html":|\}$', "")
    body = F.when(kind == 1, F.lit("[1]")).when(kind == 2, F.lit('{"jobs_html":')).otherwise(F.concat(
        F.lit('{"jobs_html":'), F.when(kind == 3, F.lit("null")).otherwise(html),
        F.lit(',"pagination_html":'), F.when(kind == 4, F.lit("7")).otherwise(F.concat(F.lit('"p'), F.col("page_id").cast("string"), F.lit('"'))), F.lit("}"),
    ))
    decoded = decode_fragments(pages(spark, sf).select("page_id", body.alias("body")))
    return decoded.select("page_id", F.md5("jobs_html").alias("jobs_md5"), "pagination_html", "reject_reason")


@query
def csv_export_roundtrip(spark, sf):
    path = shared_folder(spark) + "/csv"
    rows = raw_a(postings(spark, sf))
    write_csv(rows.withColumn("scraped_at", F.col("scraped_at").cast("string")), path)
    return as_text(read_csv(spark, path))


@query
def upsert_merge(spark, sf):
    """Latest old rows, then latest new rows upserted on top."""
    rows = as_small(postings(spark, sf))
    target = BucketedTable(spark, shared_folder(spark), rows.schema, bucket_rows=20_000)
    for side in (F.col("scraped_at") < "1998-01-01", F.col("scraped_at") >= "1998-01-01"):
        upsert_buckets(target, keep_latest(rows.where(side), "job_id", ORDER))
    return as_text(target.read())


@query
def upsert_versions(spark, sf):
    """The same on a table of whole versions."""
    rows = as_small(postings(spark, sf))
    target = VersionedTable(spark, shared_folder(spark), rows.schema)
    for side in (F.col("scraped_at") < "1998-01-01", F.col("scraped_at") >= "1998-01-01"):
        upsert_version(target, keep_latest(rows.where(side), "job_id", ORDER))
    return as_text(target.read())


@query
def upsert_changes(spark, sf):
    """Rows taken away and put in by the last of three upserts, late rows among them."""
    rows = as_small(postings(spark, sf))
    target = BucketedTable(spark, shared_folder(spark), rows.schema, bucket_rows=20_000)
    for low, high in (("1900-01-01", "1995-01-01"), ("1997-01-01", "9999-01-01"), ("1995-01-01", "1997-01-01")):
        part = rows.where((F.col("scraped_at") >= low) & (F.col("scraped_at") < high))
        upsert_buckets(target, keep_latest(part, "job_id", ORDER), ORDER)
    return as_text(target.changes())


def as_small(df: DataFrame) -> DataFrame:
    return df.select("job_id", "title", "salary", "visible_tags", "city", "source_page", "position", "scraped_at")


@query
def incremental_upsert(spark, sf):
    """Three snapshot drops, read incrementally; the final state is the latest row per job."""
    rows = as_small(postings(spark, sf))
    folder = shared_folder(spark)
    target = BucketedTable(spark, folder + "/table", rows.schema, bucket_rows=20_000)
    bounds = ["1900-01-01", "1996-01-01", "1999-01-01", "9999-01-01"]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = rows.where((F.col("scraped_at") >= low) & (F.col("scraped_at") < high))
        write_snapshot(part, folder + "/raw", DAY + dt.timedelta(days=i))
        upsert_new_snapshots(spark, folder + "/raw", rows.schema, target, folder + "/checkpoint", ORDER)
    return as_text(target.read())


@query
def incremental_late_file(spark, sf):
    """The same drops, the newest first: files that come late take nothing back."""
    rows = as_small(postings(spark, sf))
    folder = shared_folder(spark)
    target = VersionedTable(spark, folder + "/table", rows.schema)
    bounds = ["9999-01-01", "1996-01-01", "1900-01-01"]
    for i, (high, low) in enumerate(zip(bounds, bounds[1:])):
        part = rows.where((F.col("scraped_at") >= low) & (F.col("scraped_at") < high))
        write_snapshot(part, folder + "/raw", DAY - dt.timedelta(days=i))
        upsert_new_snapshots(spark, folder + "/raw", rows.schema, target, folder + "/checkpoint", ORDER)
    return as_text(target.read())


@query
def silver_mixed_times(spark, sf):
    """Crawl times with offsets, without, and unreadable: the latest instant of a job wins, not the largest text."""
    t = F.col("scraped_at").cast("timestamp")
    shifted = F.concat(F.date_format(t + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))
    text = F.when(F.col("position") % 3 == 0, shifted).when(F.col("position") % 3 == 1, F.lit("not a time")).otherwise(
        F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")))
    rows = raw_a(postings(spark, sf)).withColumn("scraped_at", text)
    return as_text(clean_a(rows, ORDER).select("job_id", "title", F.unix_seconds("scraped_at").alias("seconds")))


@query
def gold_materialize(spark, sf):
    """Cleaned tables stored, seven aggregates stored from them, all read back."""
    folder = shared_folder(spark)
    saved = {
        alias: spark.table(materialize(model, alias, f" {namespace_of(folder)} ", path=f"{folder}/gold/{alias}"))
        for alias, model in build_all(*stored_boards(spark, sf, folder)).items()
    }
    return as_cells(saved)


def as_cells(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of all aggregate tables as (model, row); averages of salaries are compared as whole numbers."""
    parts = []
    for alias, df in tables.items():
        whole = [F.col(c).cast("bigint") if c.startswith("LUONG") else F.col(c) for c in df.columns]
        cells = [F.coalesce(c.cast("string"), F.lit("-")) for c in whole]
        parts.append(df.select(F.lit(alias).alias("model"), F.concat_ws("|", *cells).alias("row")))
    return reduce(DataFrame.unionByName, parts)


def in_batches(rows: DataFrame, folder: str, bounds: list[str]) -> list[DataFrame]:
    """The rows from each bound to the next by crawl time, stored in one pass, so that no batch joins them anew."""
    time = F.col("scraped_at")
    upto = reduce(lambda c, b: c.when(time < b, F.lit(b)), bounds[1:], F.when(time < bounds[0], F.lit(None)))
    dealt = rows.withColumn("upto", upto.cast("string")).where(F.col("upto").isNotNull())
    dealt.write.partitionBy("upto").parquet(folder)
    stored = rows.sparkSession.read.schema(dealt.schema).parquet(folder)
    return [stored.where(F.col("upto") == b).drop("upto") for b in bounds[1:]]


@query
def gold_from_changes(spark, sf):
    """Seven aggregates that follow three upserts of each board by their changed rows alone."""
    folder, states, lines = shared_folder(spark), [], joined_rows(spark, sf)
    # What postings are derived from is stored; their texts are longer, and each batch makes those it asks for.
    timed = made_postings(lines, *lines.columns).select("scraped_at", *lines.columns)
    batches = in_batches(timed, f"{folder}/postings", ["1900-01-01", "1997-01-01", "1998-03-01", "9999-01-01"])
    for board, schema, raw, clean in (("a", CLEAN_A, raw_a, clean_a), ("b", CLEAN_B, raw_b, clean_b)):
        table = BucketedTable(spark, f"{folder}/{board}", schema, bucket_rows=50_000)
        for part in batches:
            upsert_buckets(table, clean(raw(made_postings(part)), ORDER))
            state = gold_state.advance(table, f"{folder}/state/{board}", board)
        states.append(state)
    return as_cells(gold_state.tables_from_state(*states))


def namespace_of(folder: str) -> str:
    """A namespace of its own for each run."""
    return "gold_" + folder.rpartition("-")[2].lower().replace("_", "x")


# --- projections -----------------------------------------------------------


@query
def silver_a(spark, sf):
    return as_text(cleaned_a(spark, sf))


@query
def silver_b(spark, sf):
    return as_text(cleaned_b(spark, sf))


@query
def scraped_at_parse(spark, sf):
    """Offset text, local text in a zone, and text that is no time."""
    t = F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("position") % 3 == 0, F.concat(t, F.lit(".250000+00:00"))).when(
        F.col("position") % 3 == 1, t).otherwise(F.lit("not a time"))
    rows = postings(spark, sf).select(*ROW, text.alias("text"))
    return as_text(rows.select(*ROW, "text", F.unix_micros(parse_time(F.col("text"), "Asia/Ho_Chi_Minh")).alias("micros")))


# --- HTML ------------------------------------------------------------------


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit("<"), F.lit("&lt;"))


def full_card() -> Column:
    """A posting as board B shows it."""
    e = lambda c: escaped(F.coalesce(F.col(c).cast("string"), F.lit("")))
    tags = F.array_join(F.transform("visible_tags", lambda t: F.concat(F.lit('<a class="item-tag"> '), t, F.lit("</a>"))), "")
    page_class = F.element_at(
        F.array(*map(F.lit, ["", " bg-highlight", " bg-flash-job", " bg-diamond-employer"])),
        (F.col("position") % 4 + 1).cast("int"),
    )
    return F.concat(
        F.lit('<div class="job-item-search-result'), page_class, F.lit('" data-job-id="'), e("job_id"),
        F.lit('" data-job-position="'), e("position"), F.lit('" data-u-sr-id="'), F.lpad(F.col("position").cast("string"), 12, "0"), F.lit('" data-box="list">'),
        F.lit('<div class="avatar"><a href="/logo"><img data-src=" /img/'), e("job_id"), F.lit('.png" src="/x.png" alt="none"></a></div>'),
        F.lit('<div class="box-label-top"><span class="label"> Tin&nbsp; mới </span><span class="label"> </span></div>'),
        F.lit('<h3 class="title"><a href="'), e("job_url"), F.lit('"><span title=" '), e("title"), F.lit(' "><b>x</b></span></a></h3>'),
        F.lit('<a class="company" href="/cong-ty/'), e("job_id"), F.lit('?a=1&amp;b=2"><span class="company-name">'), e("company_name"), F.lit("</span></a>"),
        F.lit('<div class="info"><label class="salary"><span>'), e("salary"), F.lit('</span></label><label class="address"><span class="city-text">\n '),
        e("city"), F.lit('</span></label><label class="exp"><span>'), e("experience"), F.lit("</span></label></div>"),
        F.lit('<div class="tag">'), tags, F.lit('<span class="remaining-items" title="'), e("remaining_tags"), F.lit('">+2</span></div>'),
        F.lit('<label class="label-update" title="hôm nay">'), e("posted_at"), F.lit("<br></label>"),
        F.lit('<button class="btn btn-apply-now" data-apply-url="" data-redirect-to="/apply/'), e("job_id"), F.lit('">Ứng tuyển</button>'),
        F.when(F.col("source_page") % 2 == 0, '<i class="icon-verified-employer big level-2 level-3"></i>').otherwise(""),
        F.when(F.col("source_page") == 3, '<i class="is-urgent"></i><i class="is-hot-job"></i>').otherwise(""),
        F.when(F.col("source_page") == 5, '<i class="job-pro-icon"></i><i class="tag-diamond-employer"></i>').otherwise(""),
        F.lit("</div>"),
    )


def card_markup(df: DataFrame) -> DataFrame:
    """A listing page per posting: a full card, for every third also a bare one, and a decoy.

    Each page is built from its own row, so no page collects a hot group.
    """
    e = lambda c: escaped(F.coalesce(F.col(c).cast("string"), F.lit("")))
    full = full_card()
    bare = F.concat(
        F.lit('<div class="job-item-search-result" data-job-id="bare-'), e("job_id"),
        F.lit('"><div class="avatar"><a href="'), e("job_url"), F.lit('" aria-label="'), e("title"),
        F.lit('"><img src="/s.png" alt="'), e("company_name"), F.lit('"></a></div><span class="title-salary">'), e("salary"),
        F.lit("</span></div>"),
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><script>var t='<div class=\"job-list-search-result\">';</script></head><body>"),
        F.lit('<!-- list --><div class="job-list-search-result">'), full,
        F.when(F.col("position") % 3 == 0, bare).otherwise(F.lit("")),
        F.lit('</div><div class="other"><div class="job-item-search-result" data-job-id="decoy"></div></div></body></html>'),
    )
    return df.select(html.alias("html"), "source_page", F.col("scraped_at").cast("string").alias("scraped_at"))


@query
def html_cards(spark, sf):
    return as_text(cards_b(card_markup(postings(spark, sf)), BASE_URL))


def card_of_a() -> Column:
    """A posting as board A shows it, with a card that has no key after it."""
    e = lambda c: escaped(F.coalesce(F.col(c).cast("string"), F.lit("")))
    tags = F.array_join(F.transform("visible_tags", lambda t: F.concat(
        F.lit('<a data-responsive-tag-list-target="tag"><span>'), t, F.lit(" </span></a>"))), "\n")
    return F.concat(
        F.lit('<div class="job-card" data-job-key="'), e("job_id"), F.lit('" data-search--job-selection-job-slug-value="s-'),
        F.lpad(F.col("position").cast("string"), 12, "0"),
        F.lit('"><span class="small-text text-dark-grey">'), e("posted_at"), F.lit('</span><h3><a href="'), e("job_url"), F.lit('#top">'),
        e("title"), F.lit('</a></h3><a href="/companies/a"> </a><a href="/companies/b?x=1">'), e("company_name"),
        F.lit('</a><a class="logo-employer-card"><img src="/a.png"></a><div class="salary"><span>'), e("salary_freeform"),
        F.lit('</span></div><a class="text-decoration-dot-underline">IT</a><div><div class="text-rich-grey flex-shrink-0">At office</div>'),
        F.lit('<div class="text-rich-grey" title="'), e("city"), F.lit('">x</div></div><div class="text-rich-grey flex-shrink-0">Remote</div>'),
        tags, F.when(F.col("position") % 2 == 0, '<div class="small-text text-it-black fw-500"><ul><li>Lunch<li> <li>Gym</ul></div>').otherwise(""),
        F.lit('</div><div class="job-card">no key</div>'),
    )


def card_markup_a(df: DataFrame) -> DataFrame:
    return df.select(card_of_a().alias("html"), "source_page", F.col("scraped_at").cast("string").alias("scraped_at"))


@query
def html_cards_a(spark, sf):
    return as_text(cards_a(card_markup_a(postings(spark, sf)), BASE_URL))


@query
def html_nav_links(spark, sf):
    nav = html_columns.inner_html(F.col("html"), "nav")
    found = html_columns.links(nav)
    return pages(spark, sf).select(
        "page_id",
        joined(nonempty_texts(F.transform(found, lambda l: l["href"]))).alias("hrefs"),
        joined(nonempty_texts(F.transform(found, lambda l: l["text"]))).alias("texts"),
        F.size(found).alias("n_links"),
    )


@query
def html_text_normalize(spark, sf):
    html = F.col("html")
    return pages(spark, sf).select(
        "page_id",
        html_columns.element_text(html, "h1").alias("heading"),
        F.md5(clean_or_blank(html_columns.visible_text(html_columns.inner_html(html, "body")))).alias("body_md5"),
        clean_or_null(html_columns.inner_html(html, "table")).alias("missing_or_null"),
        clean_or_blank(html_columns.inner_html(html, "table")).alias("missing_or_blank"),
    )


@query
def html_attr(spark, sf):
    html = F.col("html")
    return pages(spark, sf).select(
        "page_id",
        html_columns.attribute(html, "html", "lang").alias("lang"),
        html_columns.attribute(html, "meta", "charset").alias("charset"),
        html_columns.attribute(html, "a", "href").alias("first_href"),
        html_columns.attribute(html, "img", "src").alias("missing"),
    )


@query
def html_fallback(spark, sf):
    html = F.col("html")
    kind = F.col("page_id") % 3
    return pages(spark, sf).select(
        "page_id",
        first_present(
            F.when(kind == 0, html_columns.attribute(html, "html", "lang")), F.when(kind == 1, F.lit("  ")),
            html_columns.element_text(html, "title"),
        ).alias("label"),
        F.coalesce(html_columns.attribute(html, "img", "data-src"), html_columns.attribute(html, "img", "src"),
                   html_columns.attribute(html, "a", "href")).alias("link"),
    )


@query
def html_flags(spark, sf):
    """Class flags and the first class with a prefix, on class attributes made from lineitem."""
    cls = F.concat(
        F.lit(" job\n"), F.when(F.col("l_partkey") % 3 == 0, " bg-highlight ").otherwise(" bg-highlights "),
        F.when(F.col("l_partkey") % 5 == 0, " level-").otherwise(" no-level-"), F.col("l_linenumber").cast("string"),
        F.when(F.col("l_suppkey") % 7 == 0, "\tlevel-9").otherwise(""),
    )
    rows = spread(table(spark, sf, "lineitem"), *LINE_IDENTITY).withColumn("class", cls)
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("string").alias("l_shipdate"),
        F.array_contains(classes_of(F.col("class")), "bg-highlight").alias("is_highlight"),
        F.array_contains(classes_of(F.col("class")), "bg-diamond-employer").alias("is_diamond_employer"),
        first_class_with_prefix(F.col("class"), "level-").alias("verification_level"),
    )


@query
def html_first_nonempty_link(spark, sf):
    """First nav link whose text is not empty, with the first links emptied on some pages."""
    nav = html_columns.inner_html(F.col("html"), "nav")
    emptied = F.when(F.col("page_id") % 2 == 0, F.regexp_replace(nav, r"^(<ul><li><a [^>]*>)[^<]*", "$1 &nbsp; ")).otherwise(nav)
    found = F.get(F.filter(html_columns.links(emptied), lambda l: l["text"] != ""), F.lit(0))
    return pages(spark, sf).select("page_id", found["href"].alias("href"), found["text"].alias("text"))


@query
def posted_prefix_strip(spark, sf):
    upper = F.when(F.col("position") % 2 == 0, F.upper("posted_at")).otherwise(F.col("posted_at"))
    return as_text(postings(spark, sf).select(*ROW, drop_prefix_ci(upper, "posted ").alias("posted")))


# --- URLs and paging -------------------------------------------------------


@query
def url_canonical(spark, sf):
    u = F.col("url")
    relative = F.when(F.col("page_id") % 4 == 1, F.regexp_replace(u, "^https?://[^/]+", "")).when(
        F.col("page_id") % 4 == 2, F.regexp_replace(u, "^https?:", "")).when(F.col("page_id") % 4 == 3, F.lit("")).otherwise(u)
    return pages(spark, sf).select("page_id", relative.alias("url"), urls.canonical_url(relative, BASE_URL).alias("canonical"))


@query
def url_absolute(spark, sf):
    u = F.col("url")
    path = F.regexp_replace(u, "^https?://[^/]+", "")
    relative = F.when(F.col("page_id") % 4 == 1, path).when(
        F.col("page_id") % 4 == 2, F.concat(F.lit("/a/.."), path)).when(F.col("page_id") % 4 == 3, F.lit("")).otherwise(u)
    return pages(spark, sf).select("page_id", relative.alias("url"), urls.absolute_url(relative, BASE_URL).alias("absolute"))


@query
def url_set_param(spark, sf):
    page = (F.col("page_id") % 50 + 1).cast("int")
    extra = F.when(F.col("page_id") % 3 == 0, "?page=7&q=a%20b~*&page=9&e=").when(F.col("page_id") % 3 == 1, "?q=đ&&x").otherwise("")
    base = F.regexp_replace("url", r"[?#].*$", "")
    hash_ = F.when(F.col("page_id") % 2 == 0, "#top").otherwise("")
    full = F.concat(base, extra, hash_)
    return pages(spark, sf).select("page_id", full.alias("url"), urls.set_page(full, page).alias("paged"))


@query
def url_build(spark, sf):
    built = urls.build_url(BASE_URL + "search", {
        "type_keyword": F.lit("1"), "page": F.col("source_page").cast("string"), "q": F.col("title"),
        "city": F.concat("city", F.lit(" & (~*)")),
    })
    return as_text(postings(spark, sf).select(*ROW, built.alias("url")))


@query
def url_match(spark, sf):
    n = F.col("position") % 8
    query_text = (
        F.when(n == 0, "type=1&page=1&u=abc").when(n == 1, "u=a%20b&page=1&type=1").when(n == 2, "type=1&page=2&u=abc")
        .when(n == 3, "type=1&page=1&u=%20").when(n == 4, "type=1&page=1&u=abc&exp=2").when(n == 5, "type=1&type=1&u=abc")
        .when(n == 6, "type=1&page=1").otherwise("type=1&page=1&page=1&u=abc")
    )
    url = F.concat(F.lit("https://jobs.example.com/search"), F.when(F.col("source_page") == 1, "/").when(F.col("source_page") == 2, "/x").otherwise(""),
                   F.lit("?"), query_text)
    rows = postings(spark, sf).select(*ROW, url.alias("url"))
    return as_text(rows.withColumn("matched", urls.url_matches(F.col("url"), "/search", {"type": "1", "page": "1"}, ["u"])))


@query
def page_count(spark, sf):
    """Paging markup made from each posting; the limit applied to the count found."""
    n, m = F.col("source_page").cast("string"), (F.col("position") % 90 + 1).cast("string")
    q = F.when(F.col("position") % 3 == 0, F.lit("'")).otherwise(F.lit('"'))
    # Quotes of both kinds, encoded values, a comment, a script, more class names, values with a '>'.
    html = F.concat(
        F.lit("<nav><!-- <a href='?page=999'>999</a> --><span class="), q, F.lit("page-item page current"), q, F.lit("> "), n, F.lit("</span><script>var a = '<a href=\"?page=998\">';</script><a title="), q,
        F.lit("a > b"), q, F.lit(" href="), q, F.lit("/j?q=1&amp;page="), F.when(F.col("position") % 4 == 0, F.concat(F.lit("%3"), F.substring(m, 1, 1), F.substring(m, 2, 9))).otherwise(m), q,
        F.lit('>next</a><a class="p" href="/j?page=x"> <b>'), n, F.lit('</b> </a><a href="/j">'),
        F.when(F.col("position") % 5 == 0, "95").otherwise("more"), F.lit("</a></nav>"),
    )
    rows = postings(spark, sf).withColumn("total_pages", urls.page_count_from_links(html))
    limit = F.when(F.col("position") % 2 == 0, F.lit(40))
    return as_text(rows.select(*ROW, "total_pages", urls.last_page(limit, F.col("total_pages")).alias("last_page")))


@query
def page_count_text(spark, sf):
    text = F.when(F.col("position") % 3 == 0, F.concat(F.lit("Xem 1 / "), F.col("position").cast("string"), F.lit(" TRANG"))).when(
        F.col("position") % 3 == 1, F.concat(F.lit("2/"), F.col("position").cast("string"), F.lit("trang, 3/9 trang"))).otherwise(F.lit("trang 4"))
    return as_text(postings(spark, sf).select(*ROW, urls.page_count_from_text(text).alias("pages")))


def crawl_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page responses of one crawl per supplier, with planted violations."""
    li = spread(table(spark, sf, "lineitem"), *LINE_IDENTITY)
    asked = F.col("l_partkey") + 1
    return li.select("l_suppkey", asked.alias("asked_page")).distinct().select(
        F.col("l_suppkey").alias("crawl_id"), "asked_page",
        F.when(F.col("asked_page") % 97 == 0, F.col("asked_page") + 1).when(F.col("asked_page") < 50, F.lit(1)).otherwise(F.col("asked_page")).alias("current_page"),
        F.when(F.col("asked_page") % 89 == 0, 11).otherwise(10).alias("total_page"),
        F.when(F.col("l_suppkey") % 3 == 0, 10).when(F.col("l_suppkey") % 3 == 1, 9).alias("shown_pages"),
    )


@query
def crawl_consistency(spark, sf):
    return crawl_violations(crawl_pages(spark, sf))


@named("crawl_ledger")
def crawl_ledger_query(spark, sf):
    rows = postings(spark, sf).select(
        F.date_format("scraped_at", "yyyy").alias("crawl"), F.col("position").alias("page"), "job_id"
    )
    return crawl_ledger(rows, "crawl", "page", "job_id")


PAGE_CARDS = 30


def crawled_pages(spark: SparkSession, sf: str, card: Column) -> DataFrame:
    """Listing pages of 30 cards, of one crawl per month: (month, page, pages, cards)."""
    lines = joined_rows(spark, sf)
    rows = made_postings(lines, *lines.columns).select(F.date_format("scraped_at", "yyyy-MM").alias("month"), "job_id", "source_page", "position", *lines.columns)
    turn = F.row_number().over(Window.partitionBy("month").orderBy("job_id", "source_page", "position"))
    page_of = lambda n: F.floor((n - 1) / PAGE_CARDS).cast("int") + 1
    # The number of pages is told by the rows before their cards are made, so no window holds a month's markup. What
    # postings are derived from is shuffled, their texts are made after it.
    pages = page_of(F.count(F.lit(1)).over(Window.partitionBy("month")))
    rows = made_postings(rows.select("month", *lines.columns, turn.alias("turn"), pages.alias("pages")), "month", "turn", "pages")
    rows = rows.select("month", "turn", "pages", card.alias("card")).withColumn("page", page_of(F.col("turn")))
    cards = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "card"))), lambda c: c["card"]), "")
    return rows.groupBy("month", "page").agg(cards.alias("cards"), F.max("pages").alias("pages"))


def sinks_of(done: ingest.Ingested, *columns: str) -> DataFrame:
    """All results of an ingest as (sink, row)."""
    def lines(name: str, df: DataFrame, *of: str) -> DataFrame:
        return df.select(F.lit(name).alias("sink"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in of]).alias("row"))

    return reduce(DataFrame.unionByName, [
        lines("row", done.rows, *columns), lines("reject", done.rejects, "crawl_id", "asked_page", "reject_reason"),
        lines("violation", done.violations, "crawl_id", "asked_page", "violation"), lines("beyond", done.beyond, "crawl_id", "asked_page"),
        lines("ledger", done.ledger, "scraped_at", "source_page", "page_rows", "new_keys", "distinct_so_far"),
    ])


@query
def ingest_b(spark, sf):
    """Bodies of board B, some of them errors, some crawls breaking a rule midway, to rows and accounts."""
    month, page = F.col("month"), F.col("page")
    m = F.substring("month", 6, 2).cast("int")
    html = F.concat(F.lit('<div class="job-list-search-result">'), F.col("cards"), F.lit("</div>"))
    current = F.when((m == 5) & (page == 3), F.lit(9)).otherwise(page)
    body = F.to_json(F.struct(
        F.when(page % 5 == 2, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.struct(html.alias("html_job"), F.lit(7).alias("total"), F.when((m == 9) & (page == 4), F.lit(1)).otherwise(F.col("pages")).alias("total_page"), current.alias("current_page")).alias("data"),
    ))
    text = F.when(page == 1, F.concat(F.lit("1 / "), (F.col("pages") + F.when(m == 11, 1).otherwise(0)).cast("string"), F.lit(" trang")))
    bodies = crawled_pages(spark, sf, full_card()).select(
        month.alias("crawl_id"), page.alias("asked_page"), F.concat(month, F.lit("-28T01:02:03+00:00")).alias("scraped_at"), body.alias("body"), text.alias("page_text"))
    done = ingest.ingest(spark, bodies, "b", shared_folder(spark), BASE_URL, order=["source_page", "tracking_id", "posted_time"])
    return sinks_of(done, "job_id", "tracking_id", "title", "city", "job_url", "source_page", "scraped_at")


@query
def ingest_a(spark, sf):
    """Bodies of board A, some of them broken, whose links tell fewer pages than were asked, to rows and accounts."""
    month, page = F.col("month"), F.col("page")
    links = F.concat(F.lit('<span class="page current">1</span><a href="?page='), F.greatest(F.col("pages") - 2, F.lit(1)).cast("string"), F.lit('">last</a>'))
    whole = F.to_json(F.struct(F.col("cards").alias("jobs_html"), links.alias("pagination_html")))
    body = F.when(page % 7 == 3, F.lit("[]")).when(page % 7 == 5, F.lit("{")).otherwise(whole)
    bodies = crawled_pages(spark, sf, card_of_a()).select(
        month.alias("crawl_id"), page.alias("asked_page"), F.concat(month, F.lit("-28T01:02:03+00:00")).alias("scraped_at"), body.alias("body"))
    done = ingest.ingest(spark, bodies, "a", shared_folder(spark), BASE_URL, limit=20, order=["source_page", "slug", "posted_at"])
    return sinks_of(done, "job_id", "slug", "title", "location", "job_url", "source_page", "scraped_at")


# --- salaries --------------------------------------------------------------


def with_salary(spark: SparkSession, sf: str) -> DataFrame:
    return postings(spark, sf).transform(parse_salary()).transform(flatten_salary())


SALARY_COLUMNS = [
    "salary_min", "salary_max", "salary_currency", "salary_period", "salary_type",
    "salary_parse_status", "salary_parser_version", "salary_parse_error",
]


@query
def salary_token_parse(spark, sf):
    return as_text(with_salary(spark, sf).select(*ROW, "salary", *SALARY_COLUMNS))


@query
def salary_range(spark, sf):
    ranges = evaluated_once(with_salary(spark, sf), *SALARY_COLUMNS).where("salary_type = 'range'")
    return as_text(ranges.select(*ROW, "salary_min", "salary_max", "salary_currency", "salary_parse_error"))


@query
def salary_type_counts(spark, sf):
    return count_by(with_salary(spark, sf), ["salary_type"])


@query
def salary_error_profile(spark, sf):
    return count_by(with_salary(spark, sf), ["salary_type", "salary_parse_status", "salary_parse_error"])


@query
def salary_freeform(spark, sf):
    parsed = postings(spark, sf).transform(parse_freeform_salary("salary_freeform"))
    return as_text(parsed.select(*ROW, "salary_freeform", "min_salary", "max_salary", "currency", "period", "parse_status"))


# --- classification --------------------------------------------------------


@query
def tags_normalize(spark, sf):
    df = postings(spark, sf)
    return as_text(df.select(
        *ROW, normalized_tags(df, "remaining_tags").alias("remaining"), normalized_tags(df, "visible_tags").alias("visible"),
        F.size(normalized_tags(df, "remaining_tags")).alias("n_remaining"),
    ))


@named("experience_years")
def experience_years_query(spark, sf):
    return as_text(postings(spark, sf).select(*ROW, "experience").transform(parse_experience(output="years")))


@query
def experience_validate(spark, sf):
    value = (
        F.when(F.col("position") % 5 == 0, F.lit(None).cast("double")).when(F.col("position") % 5 == 1, F.lit("NaN").cast("double"))
        .when(F.col("position") % 5 == 2, F.lit(-1.0)).when(F.col("position") % 5 == 3, F.col("source_page") / 2)
        .otherwise(F.col("source_page") / 4)
    )
    return as_text(postings(spark, sf).select(*ROW, experience_error(value).alias("error")))


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify(postings(spark, sf))


@query
def seniority(spark, sf):
    return as_text(classified(spark, sf).select(*ROW, "title", "seniority"))


@query
def role_group(spark, sf):
    """Group looked up in a mapping table by the primary role."""
    groups = spark.createDataFrame([(r.name, r.group) for r in ROLES], "role string, role_group string")
    rows = classified(spark, sf).select(*ROW, "primary_role")
    return as_text(group_from_table(rows, groups).select(*ROW, "primary_role", "role_group"))


@query
def primary_role(spark, sf):
    return as_text(classified(spark, sf).select(*ROW, "title", "primary_role"))


@query
def title_roles_from_table(spark, sf):
    """All roles of each distinct title-and-city text, by an equi-join with the phrase table."""
    phrases = [(p, r.name, i) for i, r in enumerate(ROLES) for p in r.phrases]
    mapping = spark.createDataFrame(phrases, "phrase string, role string, priority int")
    texts = postings(spark, sf).select(F.concat_ws(" / ", "title", "city").alias("text"))
    return as_text(roles_from_table(texts, "text", mapping))


@query
def secondary_roles(spark, sf):
    return as_text(classified(spark, sf).select(*ROW, "secondary_roles", "is_multi_role"))


@query
def skills_normalize(spark, sf):
    return as_text(classified(spark, sf).select(*ROW, "skills"))


@query
def classify_status(spark, sf):
    return as_text(classified(spark, sf).select(*ROW, "role_group", "parse_status", F.size("skills").alias("n_skills")))


def mapping_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Role, hint and skill tables: the fixed ones, and as many phrases again as there are parts and customers."""
    roles = spark.createDataFrame([(p, r.name, r.group, i) for i, r in enumerate(ROLES) for p in r.phrases], "phrase string, role string, role_group string, priority int")
    named = table(spark, sf, "part").select(F.concat(F.lower(F.trim(F.regexp_replace("p_name", "[^A-Za-z ]+", " "))), F.lit(" engineer")).alias("phrase"))
    more = named.distinct().select("phrase", F.concat(F.lit("Maker of "), "phrase").alias("role"), F.lit("Other").alias("role_group"), F.lit(1000).alias("priority"))
    hints = spark.createDataFrame([(p, g, i) for i, (g, ps) in enumerate(GROUP_PHRASES.items()) for p in ps], "phrase string, role_group string, priority int")
    skills = spark.createDataFrame(list(SKILLS.items()), "mention string, skill string")
    brands = table(spark, sf, "part").select(F.lower("p_brand").alias("mention"), F.concat(F.lit("Brand "), F.substring("p_brand", 7, 2)).alias("skill")).distinct()
    return roles.unionByName(more), hints, skills.unionByName(brands)


@named("classify_from_tables")
def classify_from_tables_query(spark, sf):
    """Roles, groups and skills by mapping tables that grow with the data, every column of the result."""
    rows = classify_from_tables(postings(spark, sf), *mapping_tables(spark, sf))
    return as_text(rows.select(*ROW, "primary_role", "secondary_roles", "role_group", "skills", "seniority", "parse_status"))


# --- enrichment ------------------------------------------------------------

YEARS = T.StructType([
    T.StructField("row_key", T.StringType()), T.StructField("years", T.DoubleType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
])


def keyed_experience(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat_ws("/", "job_id", "source_page", "position", F.col("scraped_at").cast("string"))
    return postings(spark, sf).select(key.alias("row_key"), "position", "experience")


def years_of(row: dict, _session) -> dict:
    """A stand-in for a remote model: the largest number in the text."""
    numbers = [float(w) for w in (row["experience"] or "").replace("-", " ").split() if w.isdigit()]
    return {"years": max(numbers, default=None), "status": "success"}


def failing_years_of(row: dict, session) -> dict:
    if row["position"] % 7 == 0:
        raise ValueError(f"no answer for {row['position']}")
    return years_of(row, session)


@query
def enrich_partitions(spark, sf):
    return enrich(keyed_experience(spark, sf), years_of, YEARS, key="row_key", partitions=8)


@query
def enrich_error_rows(spark, sf):
    return enrich(keyed_experience(spark, sf), failing_years_of, YEARS, key="row_key",
                  defaults={"status": "error"}, error_column="message")


@query
def enrich_required_fields(spark, sf):
    """An answer without a required field becomes an error row."""
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name != "years") for f in YEARS])
    return enrich(keyed_experience(spark, sf), years_of, schema, key="row_key", defaults={"years": -1.0, "status": "error"}, error_column="message")


def years_of_prompt(prompt: str, _session) -> dict:
    """A stand-in for a remote model that is given the record as text."""
    record = json.loads(prompt)
    if record["title"].startswith("BrSE"):
        raise ValueError("no answer for " + record["title"])
    return years_of(record, None)


@query
def enrich_known_answers(spark, sf):
    """Two runs: the second calls only for the prompts that the first, on every fifth row, did not ask."""
    fields = T.StructType([f for f in YEARS if f.name in ("years", "status")])
    answers = BucketedTable(spark, shared_folder(spark), answers_schema(fields), key="prompt_hash")
    rows = postings(spark, sf).select(*ROW, "title", "experience", "city")
    prompt = F.to_json(F.struct("title", "experience", "city"), {"ignoreNullFields": "false"})
    plan = CallPlan(tries=1)
    for part in (rows.where("position % 5 = 0"), rows):
        out = enrich_known(part, prompt, years_of_prompt, answers, defaults={"status": "error"}, error_column="message", known_column="known", plan=plan)
    return as_text(out)


@query
def salary_reply_decode(spark, sf):
    n = F.col("position") % 6
    reply = (
        F.when(n == 0, F.lit('{"min_salary":10.5,"max_salary":20,"currency":"USD","period":"month","parse_status":"success"}'))
        .when(n == 1, F.lit('{"min_salary":null,"max_salary":null,"currency":null,"period":null,"parse_status":"failed"}'))
        .when(n == 2, F.lit('{"min_salary":1,"currency":"gold","parse_status":"success"}'))
        .when(n == 3, F.lit('{"min_salary":"much","parse_status":"success"}'))
        .when(n == 4, F.lit("no json"))
        .otherwise(F.lit('{"min_salary":1}'))
    )
    return as_text(decode_salary(postings(spark, sf).select(*ROW, reply.alias("reply"))))


@query
def reply_decode(spark, sf):
    n = F.col("position") % 9
    years = F.when(n == 0, "1.5").when(n == 1, "null").when(n == 2, "-1").when(n == 3, "0.3").when(n == 4, '"two"').otherwise("3")
    reply = (
        F.when(n == 5, F.lit("{broken"))
        .when(n == 6, F.lit('{"role_group":"Data","skills":["SQL"]}'))
        .when(n == 7, F.lit('{"experience_years":2,"seniority":"Boss"}'))
        .when(n == 8, F.lit('{"experience_years":2}'))
        .otherwise(F.concat(
            F.lit('{"role_group":"Data","primary_role":"Data Engineer","secondary_roles":["A","B"],"seniority":"Junior","experience_years":'),
            years, F.lit(',"skills":["SQL","Python"],"is_multi_role":true,"parse_status":"ambiguous"}'),
        ))
    )
    return as_text(decode_classification(postings(spark, sf).select(*ROW, reply.alias("reply"))))


@named("prompt_record")
def prompt_record_query(spark, sf):
    df = postings(spark, sf)
    return as_text(df.select(*ROW, prompt_record(df).alias("record")))


# --- joins and dedup -------------------------------------------------------


@named("join_parsed")
def join_parsed_query(spark, sf):
    """Latest parsed salary per job joined back to every row of the job."""
    latest = keep_latest(postings(spark, sf), "job_id", ORDER).transform(parse_salary()).transform(flatten_salary())
    latest = latest.select("job_id", "salary_min", "salary_type")
    return as_text(join_parsed(latest, postings(spark, sf).select(*ROW, "title")))


@query
def dedup_latest(spark, sf):
    return as_text(keep_latest(as_small(postings(spark, sf)), "job_id", ORDER))


@query
def dedup_fallback_key(spark, sf):
    url = F.when(F.col("source_page") == 1, F.lit(None)).when(F.col("source_page") == 2, F.lit("")).otherwise(F.col("job_url"))
    rows = postings(spark, sf).select("job_id_raw", url.alias("job_url"), "title", "source_page", "position", "scraped_at", "job_id")
    return as_text(keep_latest_by_fallback(rows, ["job_id_raw", "job_url"], [*ORDER, "job_id"]))


# --- aggregate tables ------------------------------------------------------


@query
def gold_career_count(spark, sf):
    return gold.career_count(cleaned_a(spark, sf))


@query
def gold_top_skills(spark, sf):
    return gold.top_skills(cleaned_a(spark, sf))


@query
def gold_seniority(spark, sf):
    return gold.seniority_counts(cleaned_b(spark, sf))


@query
def gold_avg_salary(spark, sf):
    return gold.average_salary(cleaned_b(spark, sf))


@query
def gold_city(spark, sf):
    return gold.city_counts(cleaned_b(spark, sf))


@query
def gold_data_roles(spark, sf):
    return gold.data_roles(evaluated_once(cleaned_b(spark, sf), "primary_role", "experience_years"))


@query
def gold_role_trend(spark, sf):
    return gold.role_trend(cleaned_b(spark, sf))


@named("value_frequency")
def value_frequency_query(spark, sf):
    return value_frequency(postings(spark, sf), "salary", "n")


# --- report ----------------------------------------------------------------


@query
def report_top_skills(spark, sf):
    return report.top(gold_top_skills(spark, sf), "job_count", "skill", report.SKILL_ROWS)


@query
def report_top_cities(spark, sf):
    return report.top(gold_city(spark, sf), "TongCongViec", "city", report.CITY_ROWS)


@query
def report_top_data_roles(spark, sf):
    return report.top(gold_data_roles(spark, sf), "total_jobs", "primary_role", report.DATA_ROLE_ROWS)


@query
def report_top_roles(spark, sf):
    return report.top(gold_role_trend(spark, sf), "TongSoTuyenDung", "primary_role", report.TREND_ROWS)


@query
def report_seniority(spark, sf):
    return report.top(gold_seniority(spark, sf), "total_jobs", "seniority")


def stored_boards(spark: SparkSession, sf: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both cleaned tables, stored once, so that the models on top do not parse again."""
    return (
        VersionedTable(spark, folder + "/a", CLEAN_A).write(cleaned_a(spark, sf)),
        VersionedTable(spark, folder + "/b", CLEAN_B).write(cleaned_b(spark, sf)),
    )


@query
def report_lines(spark, sf):
    """The five lists as text, and an empty list."""
    tables = build_all(*stored_boards(spark, sf, shared_folder(spark)))
    nothing = tables["phan_bo_viec_lam"].where("TongCongViec < 0")
    listed = {
        "skills": report.skill_lines(tables["skil_DE_need"]), "seniority": report.seniority_lines(tables["hiring_seniority"]),
        "cities": report.city_lines(tables["phan_bo_viec_lam"]), "data_roles": report.data_role_lines(tables["TheMostCVinData"]),
        "trend": report.trend_lines(tables["Trend_hiring"]), "nothing": report.city_lines(nothing),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("list"), "text") for name, df in listed.items()])


@query
def report_text(spark, sf):
    return report.report_text(build_all(*stored_boards(spark, sf, shared_folder(spark))), DAY)


@query
def daily_run(spark, sf):
    """Pages to report: cards read, stored by day, upserted, aggregated, written as text."""
    rows = postings(spark, sf)
    folder = shared_folder(spark)
    return run_day(
        spark, Layout(folder, namespace_of(folder)), DAY,
        raw_a=cards_a(card_markup_a(rows), BASE_URL),
        raw_b=cards_b(card_markup(rows), BASE_URL),
        order_a=["scraped_at", "source_page", "slug"], order_b=["scraped_at", "source_page", "tracking_id"],
    )
