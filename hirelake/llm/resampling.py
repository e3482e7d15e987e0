"""Importance resampling towards a target distribution, with hashed n-gram features.

Separators collapse to single spaces, then one overlapped regex scan meets every word of
a text once: its match holds the spans of the n-grams of one, two and three words that
begin there, and each span's CRC continues the one before it. Buckets are kept per
document, so texts are scanned once; bucket counts are merged as sums, a document's
weight is the sum of its buckets' gains, and Gumbel noise from its id turns the largest
scores into a sample without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.llm.terms import collapsed

#: The space before a word and the look-ahead after the last one are its boundaries; the groups are the next words, where there are any.
SPANS = regex.compile(rb" ([^ ]++)( [^ ]++)?+( [^ ]++)?+(?![^ ])")


@dataclass(frozen=True)
class ResamplePlan:
    """`share` percent of the documents of at least `least_words` words are drawn."""

    buckets: int = 10_000
    least_words: int = 20
    share: int = 5
    seed: int = 42


def features(text: str | None, buckets: int, most: int = 1 << 18) -> tuple[int, np.ndarray]:
    """(number of words, bucket of every feature). Matches are taken `most` at a time, so a long text needs no more."""
    matches = SPANS.finditer(collapsed(text), overlapped=True)
    n_words, parts = 0, []
    while True:
        found: list[int] = []
        add, count = found.append, 0
        for match in islice(matches, most):
            count += 1
            one, two, three = match.groups()
            crc = crc32(one)
            add(crc)
            if two is not None:
                crc = crc32(two, crc)
                add(crc)
                if three is not None:
                    add(crc32(three, crc))
        if not count:
            break
        n_words += count
        parts.append((np.array(found, np.uint32) % buckets).astype(np.uint16 if buckets <= 1 << 16 else np.uint32))
    return n_words, np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def _width(plan: ResamplePlan) -> str:
    return "<u2" if plan.buckets <= 1 << 16 else "<u4"


def featured(rows: DataFrame, plan: ResamplePlan) -> DataFrame:
    """(doc_id, n_words, n_features, features) of rows (doc_id, text); features are little-endian bucket numbers."""
    width = _width(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few texts at a time, so that no output batch outgrows the input's.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [features(t.as_py(), plan.buckets) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()),
                    pa.array([f.astype(width).tobytes() for _, f in found], pa.binary()),
                ], names=["doc_id", "n_words", "n_features", "features"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, features binary")


def bucket_counts(rows: DataFrame, plan: ResamplePlan) -> DataFrame:
    """(bucket, n) over all rows of `featured`; each task sends one row a bucket at most."""
    width = _width(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(plan.buckets, np.int64)
        for batch in batches:
            for f in batch.column(0):
                total += np.bincount(np.frombuffer(f.as_py(), width), minlength=plan.buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    return rows.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, plan: ResamplePlan) -> np.ndarray:
    """Every bucket's gain; both frames have a row a bucket at most, and only these gains reach the driver."""
    spark = corpus.sparkSession
    every = spark.range(plan.buckets).select(F.col("id").alias("bucket"))
    both = every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    totals = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = (F.col("t") + 1) * F.lit(float(totals.s + plan.buckets)) / ((F.col("s") + 1) * F.lit(float(totals.t + plan.buckets)))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()
    gains = np.zeros(plan.buckets, np.int64)
    for r in rows:
        gains[r.bucket] = r.gain
    return gains


def weighed(rows: DataFrame, gains: np.ndarray, plan: ResamplePlan) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of rows of `featured`."""
    width = _width(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(gains[np.frombuffer(f.as_py(), width)].sum()) for f in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, fixed by the id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, plan: ResamplePlan, folder: str) -> DataFrame:
    """Rows (doc_id, n_words, score, …) with the rank of those drawn, null for the others.

    Rows are dealt into ranges of (score, doc_id), sorted within them and stored; the
    numbers of eligible rows in the ranges before give each range its first rank. No task
    sorts all rows, and only one number per range reaches the driver.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The last key parts rows that are alike, of which a third of the table may consist.
    order = [F.col("short"), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("spread")]
    dealt = rows.withColumns({"short": F.col("n_words") < plan.least_words, "spread": F.monotonically_increasing_id()}).repartitionByRange(n, *order)
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()), folder, "ranges")
    sizes = {r.part: r.n for r in dealt.where("not short").groupBy("part").agg(F.count("*").alias("n")).collect()}
    drawn = plan.share * sum(sizes.values()) // 100
    starts, at = {}, 0
    for part in sorted(sizes):
        starts[part], at = at, at + sizes[part]
    # Only ranges with a drawn row are sorted again.
    top = [p for p in starts if starts[p] < drawn]
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    if not top:
        return dealt.withColumn("rank", F.lit(None).cast("long"))
    first = F.create_map(*[F.lit(x).cast("long") for p in top for x in (p, starts[p])])
    head = dealt.where(F.col("part").isin(top)).withColumn("rank", within + first[F.col("part").cast("long")])
    head = head.withColumn("rank", F.when(~F.col("short") & (F.col("rank") <= drawn), F.col("rank").cast("long")))
    rest = dealt.where(~F.col("part").isin(top)).withColumn("rank", F.lit(None).cast("long"))
    return head.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, plan: ResamplePlan = ResamplePlan()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `docs`; rank is null where not drawn.

    `target` holds the texts whose distribution is wanted. Null and empty texts have no
    features and weigh 0; rows that repeat an id are rows of their own with the same
    noise; null ids come last among equal scores; other columns are not read. An empty
    target makes the gains those of uniform buckets; without documents there are no rows.
    """
    folder = work_folder(docs.sparkSession)
    text = F.col("text").cast("string").alias("text")
    rows = featured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), plan)
    path = f"{folder}/features"
    rows.write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    wanted = featured(target.select(F.lit(None).cast("long").alias("doc_id"), text), plan)
    gains = bucket_gains(bucket_counts(rows, plan), bucket_counts(wanted, plan), plan)
    scored = weighed(rows, gains, plan).withColumn("score", F.col("weight") + noise(F.col("doc_id"), plan.seed))
    return ranked(scored, plan, folder).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, plan: ResamplePlan = ResamplePlan()) -> DataFrame:
    """The documents drawn, with all their columns; `docs` must have unique, non-null ids."""
    ids = resample(docs, target, plan).where("rank is not null").select("doc_id")
    return docs.join(ids, "doc_id", "left_semi").select(*docs.columns)


#: DuckDB SQL with the same rows as `resample`; the CRC is folded over the bytes of each distinct feature.
SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(1, 9)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(0, 256) AS g(b))),
txt AS (SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 1, -row_number() OVER (), NULL, text FROM benchmark),
w AS (SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM txt),
u AS (SELECT side, r, unnest(ws) AS a, unnest(ws[2:]) AS b, unnest(ws[3:]) AS c FROM w),
f AS (SELECT side, r, unnest([a, a || ' ' || b, a || ' ' || b || ' ' || c]) AS f FROM u),
n AS (SELECT side, r, f, count(*) AS n FROM f WHERE f IS NOT NULL GROUP BY ALL),
h AS (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(f))), lambda i: ('0x' || hex(encode(f))[2 * i + 1:2 * i + 2])::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT f FROM n), crc),
e AS (SELECT side, r, bucket, sum(n)::BIGINT AS n FROM n JOIN h USING (f) GROUP BY ALL),
k AS (SELECT bucket, sum(CASE WHEN side = 0 THEN n ELSE 0 END) AS s, sum(CASE WHEN side = 1 THEN n ELSE 0 END) AS t FROM e GROUP BY bucket),
a AS (SELECT sum(s) AS s, sum(t) AS t FROM k),
g AS (SELECT bucket, floor(1000 * ln((k.t + 1)::DOUBLE * (a.s + 10000) / ((k.s + 1)::DOUBLE * (a.t + 10000))))::BIGINT AS gain FROM k, a),
x AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM e JOIN g USING (bucket) WHERE side = 0 GROUP BY r),
o AS (SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256(concat('42:', doc_id))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN x USING (r) WHERE side = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS many FROM o)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * many // 100 THEN place END AS rank FROM p
"""
