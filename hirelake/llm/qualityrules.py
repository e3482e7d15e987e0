"""Quality rules with adaptive thresholds, with DataFrame functions only.

Every text is measured once. The measures of texts that pass the base rules go into
quantile sketches per language and source: counts of log-linear buckets (the leading
bits of an integer), so that sketches of any parts of the rows merge by adding counts,
always to the same result, and a hot source is reduced to its buckets before the
shuffle. Each group's fences come from its own quartiles; a group with few texts uses
its language's merged sketch, and that failing the one of all texts. The fences are
joined to the measured rows, which they filter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.stored import stored, work_folder
from hirelake.operators.stages import evaluated_once

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class RulesPlan:
    """A measure is out of bounds beyond its quartiles by `reach` times their distance.

    `bits` leading bits of a measure are kept (a relative error of 2 to the power of 1 - bits).
    `least` texts make a group's own fences. A distance counts as `spread` of the median at
    least, and an upper fence of a rate (millionths) is never under its entry in `free`: where
    nearly no text has symbols, the first symbol is not yet an outlier.
    """

    window: int = 8
    least_words: int = 20
    most_repeated: int = 30
    bits: int = 8
    least: int = 200
    reach: int = 3
    spread: int = 10
    free: tuple[int, int, int] = (100_000, 500_000, 300_000)
    salts: int = 16


#: Measures in integers: word length in thousandths, the others in millionths of words, lines and words.
MEASURES = ("length", "symbols", "lines", "repeats")


def covered_words(hashes: Column, window: int) -> Column:
    """How many words stand in windows (given by their hashes, in order) that the text has twice or more.

    Equal hashes stand next to each other once sorted; the first words of their windows,
    in order again, add the words that no window before them has covered.
    """
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(pairs, a)["h"] == F.get(pairs, b)["h"], F.lit(False))
        hit = F.filter(pairs, lambda p, k: same(k, k - 1) | same(k, k + 1))
        return F.array_sort(F.transform(hit, lambda p: p["i"]))

    # The one-element array binds the sorted pairs, which the lambdas inside would else sort again for each element.
    firsts = F.get(F.transform(F.array(placed), twice), F.lit(0))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(firsts, start, lambda acc, i: F.struct(
        (i + window).alias("end"), (acc["n"] + i + window - F.greatest(i, acc["end"])).alias("n"),
    ), lambda acc: acc["n"])


def _unused(names: list[str], wanted: str) -> str:
    while wanted in names:
        wanted = f"_{wanted}"
    return wanted


def measure(docs: DataFrame, plan: RulesPlan = RulesPlan()) -> tuple[DataFrame, str]:
    """`docs` with a struct column (its name is returned): n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    Null texts count as empty. Windows are compared by 64-bit hashes.
    """
    kept = docs.columns
    out, w, h = (_unused(kept, n) for n in ("quality", "quality_words", "quality_windows"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = evaluated_once(docs.withColumn(w, F.array_remove(F.split(text, SPACE), "")), w)
    hashes = F.transform(F.col(w), lambda x: F.xxhash64(x))
    last = F.size(w) - plan.window
    windows = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(F.col(h), i, plan.window)))
    df = evaluated_once(df.withColumn(h, hashes), h)
    df = evaluated_once(df.withColumn(h, F.when(last > 0, windows)), h)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    repeated = F.when(F.size(F.array_distinct(h)) < F.size(h), covered_words(F.col(h), plan.window))
    df = evaluated_once(df.withColumn(out, lines), out)
    measured = F.struct(
        F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"), F.size(out).cast("long").alias("n_lines"),
        (F.size(out) - F.size(F.array_distinct(out))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"),
    )
    df = evaluated_once(df.withColumn(out, measured), out)
    q = F.col(out)
    failed = (q["n_words"] < plan.least_words) | (100 * q["n_repeat_words"] > plan.most_repeated * q["n_words"])
    return df.select(*kept, q.withField("base_failed", failed).alias(out)), out


def rates(q: Column) -> list[Column]:
    """The values that MEASURES names, of a measured row."""
    def share(n: Column, of: Column, scale: int) -> Column:
        return F.when(of > 0, F.floor(n * scale / of)).otherwise(0).cast("long")

    return [
        share(q["word_chars"], q["n_words"], 1000), share(q["n_symbols"], q["n_words"], 1_000_000),
        share(q["n_dup_lines"], q["n_lines"], 1_000_000), share(q["n_repeat_words"], q["n_words"], 1_000_000),
    ]


def bucket(value: Column, bits: int) -> Column:
    """The value with all but its leading bits zero: the least value of its bucket."""
    drop = F.greatest(F.length(F.bin(value)) - bits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(rows: DataFrame, q: str, plan: RulesPlan = RulesPlan()) -> DataFrame:
    """(lang, source, measure, bucket, n): one quantile sketch per language, source and measure."""
    passed = rows.where(~F.col(q)["base_failed"])
    each = F.explode(F.array(*[
        F.struct(F.lit(k).alias("measure"), bucket(v, plan.bits).alias("bucket")) for k, v in enumerate(rates(F.col(q)))
    ])).alias("x")
    return passed.select("lang", "source", each).groupBy("lang", "source", "x.measure", "x.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of larger groups: those of the groups with equal `keys`, added."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, measure, total, q25, q50, q75) of every sketch."""
    group = Window.partitionBy(*keys, "measure")
    ranked = sketch.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "total": F.sum("n").over(group)})
    at = lambda p: F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, F.col("bucket")))
    return ranked.groupBy(*keys, "measure").agg(F.max("total").alias("total"), *[at(p).alias(f"q{p}") for p in (25, 50, 75)])


def fences(quartiles: DataFrame, plan: RulesPlan, *keys: str) -> DataFrame:
    """(keys, total, low, high): the bounds of all measures as arrays, in the order of MEASURES; only word length has a lower one."""
    width = plan.reach * F.greatest(F.col("q75") - F.col("q25"), F.floor(F.col("q50") / plan.spread)).cast("long")
    free = F.element_at(F.array(*[F.lit(x).cast("long") for x in (0, *plan.free)]), F.col("measure") + 1)
    high = F.greatest(F.col("q75") + width, free)
    low = F.when(F.col("measure") == 0, F.col("q25") - width).otherwise(0).cast("long")
    rows = quartiles.groupBy(*keys).agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("measure", low.alias("low"), high.alias("high")))).alias("b"))
    return rows.select(*keys, "total", F.col("b.low").alias("low"), F.col("b.high").alias("high"))


def thresholds(sketch: DataFrame, plan: RulesPlan = RulesPlan()) -> DataFrame:
    """(lang, source, low, high) of every group: its own fences, its language's, or those of all texts."""
    own = fences(quantiles(sketch, "lang", "source"), plan, "lang", "source")
    by_lang = fences(quantiles(merged(sketch, "lang"), "lang"), plan, "lang").select(
        F.col("lang").alias("of"), F.col("total").alias("lang_total"), F.col("low").alias("lang_low"), F.col("high").alias("lang_high"),
    )
    every = fences(quantiles(merged(sketch)), plan).first()
    rows = own.join(by_lang, F.col("lang").eqNullSafe(F.col("of")))
    few, lang_few = F.col("total") < plan.least, F.col("lang_total") < plan.least

    def pick(name: str) -> Column:
        # Of all texts there is one row of eight numbers; an empty table has none, and then no group either.
        last = F.array(*[F.lit(x).cast("long") for x in (every[name] if every else [])]).cast("array<long>")
        return F.when(~few, F.col(name)).when(~lang_few, F.col(f"lang_{name}")).otherwise(last)

    return rows.select("lang", "source", pick("low").alias("low"), pick("high").alias("high"))


def judge(rows: DataFrame, q: str, bounds: DataFrame, plan: RulesPlan = RulesPlan()) -> DataFrame:
    """`rows` with `kept` in their struct `q`: false for base failures and for a measure outside its group's fences.

    Rows join their group's fences with a salt, as one group may hold a third of them.
    """
    names = rows.columns
    salt, lo, hi, a, b = (_unused(names, n) for n in ("salt", "low", "high", "of_lang", "of_source"))
    spread = rows.withColumn(salt, F.pmod(F.xxhash64(F.col(q), "doc_id"), F.lit(plan.salts)).cast("int"))
    right = bounds.select(
        F.col("lang").alias(a), F.col("source").alias(b), F.col("low").alias(lo), F.col("high").alias(hi),
        F.explode(F.sequence(F.lit(0), F.lit(plan.salts - 1))).alias(f"{salt}_"),
    )
    same = F.col("lang").eqNullSafe(F.col(a)) & F.col("source").eqNullSafe(F.col(b)) & (F.col(salt) == F.col(f"{salt}_"))
    inside = F.lit(True)
    for k, value in enumerate(rates(F.col(q))):
        inside = inside & value.between(F.get(F.col(lo), F.lit(k)), F.get(F.col(hi), F.lit(k)))
    # A group without fences has no text that passed the base rules.
    kept = ~F.col(q)["base_failed"] & F.coalesce(inside, F.lit(False))
    out = spread.join(right, same, "left")
    return out.select(*[n for n in names if n != q], F.col(q).withField("kept", kept).alias(q))


def verdicts(docs: DataFrame, plan: RulesPlan = RulesPlan()) -> DataFrame:
    """One row per row of `docs`: doc_id, the measures, base_failed, kept.

    Null and empty texts have no words and fail the base rules. Null languages and
    sources are groups like others; rows that repeat an id or a whole row are judged one
    by one and alike; columns of `docs` of any other name are not read.
    """
    rows, q = measure(docs.select("doc_id", "text", "lang", "source"), plan)
    rows = stored(rows.drop("text"), work_folder(docs.sparkSession), "measured")
    judged = judge(rows, q, thresholds(sketches(rows, q, plan), plan), plan)
    return judged.select("doc_id", *[F.col(q)[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def kept_documents(docs: DataFrame, plan: RulesPlan = RulesPlan()) -> DataFrame:
    """The documents that pass, with all their columns whatever they are called."""
    rows, q = measure(docs, plan)
    rows = stored(rows, work_folder(docs.sparkSession), "measured")
    judged = judge(rows, q, thresholds(sketches(rows, q, plan), plan), plan)
    return judged.where(F.col(q)["kept"]).select(*docs.columns)


#: DuckDB SQL with the same rows as `verdicts` under the default plan.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT r, i, list_aggregate(ws[i:i+7], 'string_agg', ' ') AS t FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, t) > 1),
rep AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
m AS (SELECT w.r, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(list_aggregate(ws, 'string_agg', ''))::BIGINT AS wc,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep ON w.r = rep.r),
b AS (SELECT * REPLACE (coalesce(wc, 0) AS wc), n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
v AS (SELECT *, [coalesce(1000 * wc // nullif(n_words, 0), 0), coalesce(1000000 * n_symbols // nullif(n_words, 0), 0),
  coalesce(1000000 * n_dup_lines // nullif(n_lines, 0), 0), coalesce(1000000 * n_repeat_words // nullif(n_words, 0), 0)] AS val FROM b),
e AS (SELECT lang, source, k, val[k] AS x, greatest(length(bin(val[k])) - 8, 0) AS s FROM v, range(1, 5) AS g(k) WHERE NOT base_failed),
s AS (SELECT g, CASE WHEN g < 2 THEN lang END AS lang, CASE WHEN g < 1 THEN source END AS source, k, (x >> s) << s AS bucket, count(*) AS n
  FROM e, range(0, 3) AS l(g) GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY g, lang, source, k ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY g, lang, source, k) AS total FROM s),
q AS (SELECT g, lang, source, k, max(total) AS total, min(bucket) FILTER (upto * 100 >= total * 25) AS q25,
  min(bucket) FILTER (upto * 100 >= total * 50) AS q50, min(bucket) FILTER (upto * 100 >= total * 75) AS q75 FROM c GROUP BY g, lang, source, k),
f AS (SELECT g, lang, source, max(total) AS total,
  list(CASE WHEN k = 1 THEN q25 - 3 * greatest(q75 - q25, q50 // 10) ELSE 0 END ORDER BY k) AS low,
  list(greatest(q75 + 3 * greatest(q75 - q25, q50 // 10), [0, 100000, 500000, 300000][k]) ORDER BY k) AS high FROM q GROUP BY g, lang, source),
t AS (SELECT o.lang, o.source, CASE WHEN o.total >= 200 THEN o.low WHEN l.total >= 200 THEN l.low ELSE a.low END AS low,
  CASE WHEN o.total >= 200 THEN o.high WHEN l.total >= 200 THEN l.high ELSE a.high END AS high
  FROM f o JOIN f l ON o.g = 0 AND l.g = 1 AND o.lang IS NOT DISTINCT FROM l.lang JOIN f a ON a.g = 2)
SELECT doc_id, n_words, wc AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(list_bool_and([val[k] BETWEEN low[k] AND high[k] for k in range(1, 5)]), false) AS kept
FROM v LEFT JOIN t ON v.lang IS NOT DISTINCT FROM t.lang AND v.source IS NOT DISTINCT FROM t.source
"""
