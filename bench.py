"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, default all) select what runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verification.queries import QUERIES  # noqa: E402


def session(cpus: int) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.sql.session.timeZone", "UTC")
        .config("spark.hirelake.verification.partitions", str(cpus))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hirelake-bench-"))
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(QUERIES)
    spark = session(cpus)
    # JVM start-up and the first code generation belong to no query.
    QUERIES["value_frequency"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
