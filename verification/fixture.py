"""Postings derived from the given tables; the same text runs in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["lineitem", "orders", "customer", "nation", "part"]
LINE_IDENTITY = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
ORDER = ["scraped_at", "source_page", "position"]  # unique within a job_id

POSTINGS_SQL = """
SELECT
  CAST(l.l_orderkey AS string)                       AS job_id,
  CASE l.l_partkey % 8
    WHEN 0 THEN 'Data Engineer'
    WHEN 1 THEN 'Senior DATA Engineer (Spark)'
    WHEN 2 THEN 'KỸ SƯ DỮ LIỆU'
    WHEN 3 THEN 'Junior Backend Developer'
    WHEN 4 THEN 'Data Analyst'
    WHEN 5 THEN 'Frontend Team Leader'
    WHEN 6 THEN 'BrSE - Bridge BA'
    ELSE 'Tuyển Gấp' END                             AS title,
  CASE l.l_partkey % 13
    WHEN 0 THEN 'Thoả thuận'
    WHEN 1 THEN 'Thỏa thuận theo năng lực'
    WHEN 2 THEN CAST(CAST(l.l_quantity AS int) AS string) || ' - ' || CAST(CAST(l.l_quantity AS int) + 10 AS string) || ' triệu'
    WHEN 3 THEN CAST(CAST(l.l_quantity AS int) AS string) || ' – ' || CAST(CAST(l.l_quantity AS int) + 5 AS string) || ' Tr'
    WHEN 4 THEN 'Tới ' || CAST(CAST(l.l_quantity AS int) AS string) || ' triệu'
    WHEN 5 THEN 'Từ ' || CAST(CAST(l.l_quantity AS int) AS string) || ' triệu'
    WHEN 6 THEN '1,000 - ' || CAST(CAST(l.l_quantity AS int) + 1 AS string) || ',000 USD'
    WHEN 7 THEN 'Tới ' || CAST(CAST(l.l_quantity AS int) AS string) || ',500 USD'
    WHEN 8 THEN '10,5 - 12 triệu'
    WHEN 9 THEN CAST(CAST(l.l_quantity AS int) AS string) || ' triệu'
    WHEN 10 THEN '60 - ' || CAST(CAST(l.l_quantity AS int) AS string) || ' triệu'
    WHEN 11 THEN '10 - 20 triệu/tháng'
    ELSE NULL END                                    AS salary,
  CASE l.l_suppkey % 8
    WHEN 0 THEN 'Không yêu cầu'
    WHEN 1 THEN '1 năm'
    WHEN 2 THEN 'Trên 5 năm'
    WHEN 3 THEN 'Dưới 1 năm'
    WHEN 4 THEN '3-4 năm'
    WHEN 5 THEN 'Từ 2 đến 4 năm'
    WHEN 6 THEN '1 năm 6 tháng'
    ELSE NULL END                                    AS experience,
  split(CASE l.l_partkey % 4
    WHEN 0 THEN 'ReactJS,NodeJS,' || p.p_type
    WHEN 1 THEN 'SQL,Python'
    WHEN 2 THEN 'postgres,dotnet,SQL'
    ELSE p.p_type END, ',')                          AS visible_tags,
  CASE WHEN l.l_partkey % 3 = 0 THEN NULL
       ELSE ' Data , ' || p.p_brand || ',,SQL ' END  AS remaining_tags,
  CASE l.l_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN ''
    ELSE CAST(l.l_orderkey AS string) END            AS job_id_raw,
  CASE l.l_partkey % 16
    WHEN 0 THEN CAST(CAST(l.l_quantity AS int) AS string) || ' - ' || CAST(CAST(l.l_quantity AS int) + 10 AS string) || 'm'
    WHEN 1 THEN CAST(CAST(l.l_quantity AS int) AS string) || ' triệu – ' || CAST(CAST(l.l_quantity AS int) + 10 AS string) || ' triệu'
    WHEN 2 THEN 'Up to $' || CAST(CAST(l.l_quantity AS int) AS string) || '00'
    WHEN 3 THEN 'Upto ' || CAST(CAST(l.l_quantity AS int) AS string) || 'm/month'
    WHEN 4 THEN 'From $1300'
    WHEN 5 THEN 'Từ ' || CAST(CAST(l.l_quantity AS int) AS string) || 'tr đến ' || CAST(CAST(l.l_quantity AS int) + 10 AS string) || 'tr /tháng'
    WHEN 6 THEN 'Up to ' || CAST(CAST(l.l_quantity AS int) AS string) || ',000$ /year'
    WHEN 7 THEN 'Vnd ' || CAST(CAST(l.l_quantity AS int) AS string) || '.000.000 per month'
    WHEN 8 THEN 'Approximately $230'
    WHEN 9 THEN 'Negotiable (' || CAST(CAST(l.l_quantity AS int) AS string) || 'm – ' || CAST(CAST(l.l_quantity AS int) + 10 AS string) || 'm)'
    WHEN 10 THEN 'You''ll love it'
    WHEN 11 THEN 'Thỏa thuận theo năng lực'
    WHEN 12 THEN '800 - 1,500 USD'
    WHEN 13 THEN 'call 42'
    WHEN 14 THEN ''
    ELSE NULL END                                    AS salary_freeform,
  CASE l.l_linenumber % 2 WHEN 0 THEN 'Posted ' ELSE '' END
    || CAST(l.l_linenumber AS string) || ' days ago' AS posted_at,
  n.n_name                                           AS city,
  c.c_name                                           AS company_name,
  'https://jobs.example.com/j/' || CAST(l.l_orderkey AS string)
    || '?ta_source=x&page=' || CAST(l.l_linenumber AS string) AS job_url,
  l.l_linenumber                                     AS source_page,
  l.l_partkey                                        AS position,
  l.l_shipdate                                       AS scraped_at
FROM {lineitem} l
JOIN {orders}   o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey  = c.c_custkey
JOIN {nation}   n ON c.c_nationkey = n.n_nationkey
JOIN {part}     p ON l.l_partkey  = p.p_partkey
"""


# The same joins, in the order that shuffles least: what an order names is joined to the orders, of which there are fewer, and the
# lines meet them last. Rows of one order then lie in one task, where a dedup by job keeps one of them before its shuffle.
SPARK_FROM = """FROM {lineitem} l
JOIN {part}     p ON l.l_partkey  = p.p_partkey
JOIN ({orders} o
  JOIN {customer} c ON o.o_custkey  = c.c_custkey
  JOIN {nation}   n ON c.c_nationkey = n.n_nationkey) ON l.l_orderkey = o.o_orderkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows out by a row identity, where few tasks would read them.

    The given files are one row group each, so one task would read all of it and do the work on
    top of it alone. A scan that Spark splits for all cores stays as it is;
    spark.hirelake.verification.partitions (bench.py, the tests) fixes the number.
    """
    spark = df.sparkSession
    asked = spark.conf.get("spark.hirelake.verification.partitions", None)
    cores = spark.sparkContext.defaultParallelism
    parts = int(asked) if asked else cores if df.rdd.getNumPartitions() < cores else 0
    return df.repartition(parts, *keys) if parts else df


POSTINGS_SELECT = POSTINGS_SQL.partition("FROM {lineitem}")[0]


def _frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = {name: table(spark, sf_dir, name) for name in TABLES}
    frames["lineitem"] = spread(frames["lineitem"], *LINE_IDENTITY)
    return frames


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole fixture; Spark prunes the columns and joins no query asks for."""
    return spark.sql(POSTINGS_SELECT + SPARK_FROM, **_frames(spark, sf_dir))


def joined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What postings are derived from, before their texts are made: a struct per table, under its alias."""
    used = sorted(set(re.findall(r"\b([a-z])\.(\w+)", POSTINGS_SELECT)))
    structs = [f"named_struct({', '.join(f"'{c}', {t}.{c}" for a, c in used if a == t)}) AS {t}" for t in dict.fromkeys(a for a, _ in used)]
    return spark.sql(f"SELECT {', '.join(structs)} {SPARK_FROM}", **_frames(spark, sf_dir))


def made_postings(rows: DataFrame, *others: str) -> DataFrame:
    """The postings of `joined_rows`, and other columns of theirs."""
    return rows.sparkSession.sql(POSTINGS_SELECT + "".join(f", {c}" for c in others) + " FROM {rows}", rows=rows)


def postings_oracle() -> str:
    return POSTINGS_SQL.format(**{name: name for name in TABLES})
