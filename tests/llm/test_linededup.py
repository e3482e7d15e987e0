"""Line dedup: planted passages go but for their first copy, other texts stay."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hirelake.llm.linededup import CUT, WinnowPlan, lines, repeated_runs, text_key, winnowed, with_rolled, without_repeats

SCHEMA = "doc_id long, text string, lang string, n_runs string, row string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = []
    for _ in range(n):
        w = "".join(rng.choices(letters, k=rng.randint(1, 7)))
        out.append(w + rng.choice(["", "", "", "", ".", ",", "\n"]))
    return " ".join(out)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(9)
    passage, short = prose(rng, 90), prose(rng, 20)
    docs = {i: prose(rng, rng.choice([30, 120, 500])) for i in range(40)}
    for i in range(10, 20):  # inside another paragraph, at any place
        words = docs[i].split(" ")
        at = rng.randrange(len(words))
        docs[i] = " ".join([*words[:at], passage, *words[at:]])
    for i in range(20, 30):
        docs[i] = docs[i] + "\n" + short
    docs[30] = docs[31] = prose(rng, 70)
    docs[32] = docs[33] = "too short to count"
    docs[34] = prose(rng, 60)
    docs[35] = docs[34] + "\nalso new\n" + docs[34]
    return docs, passage


def rows_of(docs):
    return [(i, t, "xx", "own", "own") for i, t in docs.items()]


def test_planted_passages(spark, planted):
    docs, passage = planted
    given = rows_of(docs) + [(100, None, None, None, None), (101, "", "", "", ""), (102, " \n\n ", "", "", ""), (None, "no id", "", "", ""), (None, docs[30], "", "", "")]
    got = without_repeats(spark.createDataFrame(given, SCHEMA))
    assert got.count() == len(given) and "row" in got.columns and dict(got.dtypes)["n_runs"] == "bigint"
    out = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    clean = [*range(0, 11), *range(20, 31), 32, 33, 34, 100, 101, 102]
    for i in clean:
        assert out[i].text == (docs.get(i) if i in docs else {100: None, 101: "", 102: " \n\n "}[i]) and out[i].n_runs == 0, i
    for i in range(11, 20):
        assert out[i].n_runs == 1 and 60 <= out[i].removed_words <= 100
        a, b = map(int, out[i].removed_spans.split(":"))
        assert docs[i][:a] + docs[i][b:] == out[i].text
        at = docs[i].index(passage)
        assert abs(a - at) < 60 and abs(b - at - len(passage)) < 60
    assert out[31].text == "" and out[31].removed_words == 70
    assert "also new" in out[35].text and out[35].removed_words >= 100
    assert [r.n_runs for r in got.where("doc_id is null").orderBy("text").collect()] == [1, 0]


def test_every_long_run_of_lines_is_found(spark, planted):
    docs, _ = planted
    plan = WinnowPlan(min_words=1, min_chars=1)
    found = repeated_runs(spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string"), plan).collect()
    keys = {r.k: r.doc_id for r in spark.createDataFrame(list(docs.items()), "doc_id long, text string").orderBy(F.desc("doc_id")).select("doc_id", text_key(F.col("text")).alias("k")).collect()}
    units = {i: re.sub("(" + CUT + ")", "\\1\uffff", t).split("\uffff") for i, t in docs.items()}
    covered = {}
    for r in found:
        me, other = units[keys[r.row]], units[keys[r.from_row]]
        assert me[r.start:r.end] == other[r.from_start:r.from_start + r.end - r.start]
        assert (keys[r.from_row], r.from_start) < (keys[r.row], r.start)
        covered.setdefault(keys[r.row], set()).update(range(r.start, r.end))
    seen = {}
    for i in sorted(set(keys.values())):
        for p in range(len(units[i]) - plan.reach + 1):
            run = tuple(units[i][p:p + plan.reach])
            if run in seen:
                assert set(range(p, p + plan.reach)) <= covered[i], (i, p)
            seen.setdefault(run, (i, p))


def test_long_periodic_and_empty(spark):
    rows = [(1, "la di da. " * 5_000), (2, "solo")]
    out = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[2].text == "solo" and out[1].text == rows[0][1]  # a short phrase over and over is no passage
    empty = without_repeats(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "n_runs", "removed_words", "removed_spans"]


def test_lines_join_to_the_text(spark):
    texts = ["a b c  d\n\ne. f", "x\uffffy a b", "", "。。a！b", "\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lines(F.col("t")).alias("x")).collect()
    assert all("".join(r.x) == r.t.replace("\uffff", " ") for r in rows)


def test_native_plan(spark, planted):
    df = without_repeats(spark.createDataFrame(rows_of(planted[0]), SCHEMA))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()


def test_passages_without_telling_letters_are_found(spark):
    rng = random.Random(3)
    say = lambda n, letters: ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n)]
    smooth, spam = say(52, "hijklmnop"), ["shop", "now", "here"] * 20
    around = lambda part: " ".join(say(30, "abcxyz") + part + say(30, "abcxyz"))
    rows = [(1, around(smooth)), (2, around(smooth)), (3, around(spam)), (4, around(spam))]
    out = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].n_runs == out[3].n_runs == 0
    assert out[2].removed_words == 52 and out[4].removed_words == 60


def test_short_lines_elsewhere_do_not_hide_a_passage(spark):
    rng = random.Random(5)
    say = lambda n: ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)]
    docs, n = {}, 0
    for _ in range(20):
        left, right = say(32), say(32)
        for part in (left, right, left + right, left + right):
            docs[n] = " ".join(say(20) + part + say(20))
            n += 1
    out = {r.doc_id: r for r in without_repeats(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert all(out[i].removed_words == (64 if i % 4 == 3 else 0) for i in docs)


def test_plain_replacements_cut_as_the_regular_expression(spark):
    texts = ["a b  c\n\n d \n", " a", "\n", " ", "", "a\tb \t c", "a\x01b c", "x\uffffy", "一。 二！三 ？", "a \n。\n b", "\r\n a\x0b\x0cb"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lines(F.col("t")).alias("x")).collect()
    assert all(r.x == re.sub("(" + CUT + ")", "\\1\uffff", r.t.replace("\uffff", " ")).split("\uffff") for r in rows)


def test_no_slice_of_lines_is_hashed_at_each_line(spark):
    plan = winnowed(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), WinnowPlan())._jdf.queryExecution().toString()
    assert "xxhash64(" in plan and "slice(u" not in plan


def test_the_same_run_of_other_lines_has_another_hash(spark):
    # Every number in c holds four lines; changing any one line changes each number that holds it.
    base = list(range(-30, 30))
    rows = [(-1, base)] + [(i, [*base[:i], 1 << 30, *base[i + 1:]]) for i in range(60)]
    out = {r.i: r.c for r in with_rolled(spark.createDataFrame(rows, "i int, u array<int>"), 40).collect()}
    assert all((out[i][j] != out[-1][j]) == (j <= i <= j + 3) for i in range(60) for j in range(57))
