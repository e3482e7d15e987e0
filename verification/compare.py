"""Run queries in Spark and their oracles in DuckDB and compare the rows.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from verification.oracles import ORACLES
from verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """(Spark rows, problems); no problems means columns and rows agree."""
    df = QUERIES[name](spark, sf_dir)
    ours = _bag(df.columns, df.collect())
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    theirs = _bag(names, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    for side, extra in (("spark", ours - theirs), ("duckdb", theirs - ours)):
        if extra:
            problems.append(f"only in {side}: {sum(extra.values())} rows, e.g. {list(extra)[0]}")
    return sum(ours.values()), problems


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or list(QUERIES):
        start = time.time()
        try:
            n, problems = differences(spark, con, sf_dir, name) if name in ORACLES else (-1, ["no oracle"])
        except Exception as error:
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:26s} {n:7d} rows {time.time() - start:6.2f}s", flush=True)
        for p in problems:
            print("     ", p[:900], flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
