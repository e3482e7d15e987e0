"""Quality rules: measures against plain Python, mergeable sketches, fences, odd inputs."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from hirelake.llm.qualityrules import SQL, RulesPlan, bucket, kept_documents, merged, quantiles, sketches, measure, thresholds, verdicts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words string, quality string, low string"


def expected(text):
    text = text or ""
    words, seen, again = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if count[run] > 1:
            covered |= set(range(i, i + 8))
    n, rep = len(words), len(covered)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, rep, n < 20 or 100 * rep > 30 * n


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(5), []
    for i in range(700):
        lang = ["en", "de", None, "fr"][0 if i % 3 else i % 4]
        words = ["".join(rng.choices("abcdefghé", k=rng.randint(2, 8))) for _ in range(rng.randint(0, 120))]
        if i % 20 == 1:
            words = [w + "###" for w in words]
        if i % 20 == 2:
            words += words[:15]
        text = " ".join(words).replace("a ", "a\n") + ("\nagain\n \nagain" if i % 7 == 0 else "")
        rows.append((i, text, lang, f"s{i % 3}" if i % 11 else None, "own", "own", "own"))
    rows += [rows[3], rows[3], (None, "no id " * 30, "en", "s1", "", "", ""), (900, None, "en", "s1", "", "", ""), (901, "", None, None, "", "", "")]
    rows += [(902, "one two three " * 8000, "en", "s0", "", "", ""), (903, "\n\t \r\n", "xx", "only", "", "", ""), (904, "w" * 100_000, "en", "s0", "", "", "")]
    rows.append((905, " ".join(f"w{k}" for k in range(30_000)), "zz", "alone", "", "", ""))
    return spark.createDataFrame(rows, SCHEMA)


def test_measures_and_verdicts(docs):
    out = verdicts(docs)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = Counter(tuple(r)[:7] for r in out.collect())
    assert got == Counter((r.doc_id, *expected(r.text)) for r in docs.collect())
    rows = {r.doc_id: r for r in out.collect()}
    # Symbols after every word are outside the fences; a plain text is inside.
    assert not rows[21].base_failed and not rows[21].kept
    assert all(r.kept for r in out.collect() if not r.base_failed and r.n_symbols == 0 and r.doc_id is not None and r.doc_id < 700)


def test_same_rows_as_sql(docs):
    con, docs = duckdb.connect(), docs.where("doc_id is null or doc_id not in (902, 905)")  # long lists are slow in that SQL
    con.register("documents", docs.toPandas())
    want = Counter(map(tuple, con.execute(f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM ({SQL})").fetchall()))
    assert Counter(map(tuple, verdicts(docs).collect())) == want


def test_sketches_merge_exactly(docs):
    rows, q = measure(docs)
    key = lambda df: sorted(map(str, df.collect()))
    halves = sketches(rows.where("doc_id % 2 = 0"), q).unionByName(sketches(rows.where("not (doc_id % 2 <=> 0)"), q))
    whole = sketches(rows, q)
    assert key(merged(halves, "lang", "source")) == key(whole)
    assert key(merged(merged(halves, "lang"))) == key(merged(whole))


def test_quantiles_within_their_error(spark):
    values = [v * v for v in range(1, 4000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").select(F.lit(0).alias("measure"), bucket(F.col("v"), 8).alias("bucket"))
    r = quantiles(df.groupBy("measure", "bucket").agg(F.count("*").alias("n"))).first()
    for p, q in ((25, r.q25), (50, r.q50), (75, r.q75)):
        exact = values[(p * len(values) + 99) // 100 - 1]
        assert q <= exact < q * (1 + 2**-7) + 1


def test_small_groups_borrow_fences(spark, docs):
    rows, q = measure(docs)
    found = {(r.lang, r.source): (r.low, r.high) for r in thresholds(sketches(rows, q), RulesPlan(least=10**6)).collect()}
    assert len(set(map(str, found.values()))) == 1
    own = {(r.lang, r.source): (r.low, r.high) for r in thresholds(sketches(rows, q), RulesPlan(least=1)).collect()}
    assert set(own) == set(found) and len(set(map(str, own.values()))) > 1


def test_filter_keeps_all_columns(docs):
    out = kept_documents(docs)
    assert out.columns == docs.columns
    want = Counter(r.doc_id for r in verdicts(docs).where("kept").collect())
    got = out.collect()
    assert Counter(r.doc_id for r in got) == want and {r.n_words for r in got} <= {"own", ""}


def test_empty_and_all_failed(spark, docs):
    assert verdicts(docs.limit(0)).collect() == []
    assert [r.kept for r in verdicts(docs.where("doc_id in (900, 901)")).collect()] == [False, False]


def test_native_plan(docs):
    plan = verdicts(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
