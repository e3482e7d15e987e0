"""Importance resampling: features, gains, weights, noise and ranks against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from hirelake.llm.resampling import ResamplePlan, drawn_documents, features, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, weight string, rank string, features string"


def plain(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def expected(docs, target):
    docs = [(i, *plain(t)) for i, t in docs]
    wanted = Counter(b for t in target for b in plain(t)[1])
    seen = Counter(b for _, _, f in docs for b in f)
    s, t = sum(seen.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((seen[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for i, n, f in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[5] = k + 1
    return Counter((r[0], *r[2:]) for r in rows)


@pytest.fixture(scope="module")
def given(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcXYZñ9", k=rng.randint(1, 4)))
    docs = [(i, rng.choice([" ", "--", "\n", ". "]).join(word() for _ in range(rng.randint(0, 90)))) for i in range(500)]
    docs += [(600, None), (601, ""), (602, " .,; "), (603, "one"), (604, "Two words"), (605, "ab " * 60_000), (606, "x" * 200_000), (None, "no id " * 15)]
    target = [" ".join(word() for _ in range(40)) for _ in range(20)] + [None, "", "one"]
    df = spark.createDataFrame([(i, t, "own", "own", "own") for i, t in docs], SCHEMA)
    return docs, target, df, spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")


def test_spans_are_all_ngrams():
    for text in ("", "a", "A b", "a-b--c", "Ünïcode ZEBRA 9x\x00y", "é" * 50 + " b c d"):
        n, got = features(text, 10000)
        assert (n, sorted(got.tolist())) == (plain(text)[0], sorted(plain(text)[1]))
    whole, parts = features("a b c d e f g", 10000), features("a b c d e f g", 10000, most=2)
    assert whole[0] == parts[0] and whole[1].tolist() == parts[1].tolist()


def test_all_columns_as_by_hand(given):
    docs, target, df, wanted = given
    out = resample(df, wanted)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, out.collect())) == expected(docs, target)
    assert Counter(map(tuple, resample(df.repartition(5), wanted).collect())) == expected(docs, target)


def test_repeated_rows_have_their_own_ranks(spark, given):
    df = spark.createDataFrame([(7, "a b c d " * 6)] * 60, "doc_id long, text string")
    out = resample(df, given[3]).collect()
    assert sorted(r.rank for r in out if r.rank) == [1, 2, 3] and len({r.score for r in out}) == 1


def test_draw_leans_to_the_target(spark):
    rng = random.Random(1)
    make = lambda letters: " ".join("".join(rng.choices(letters, k=3)) for _ in range(30))
    df = spark.createDataFrame([(i, make("abc" if i % 10 else "xyz")) for i in range(400)], "doc_id long, text string")
    wanted = spark.createDataFrame([(make("xyz"),) for _ in range(30)], "text string")
    assert all(r.doc_id % 10 == 0 for r in drawn_documents(df, wanted).collect())


def test_empty_tables(spark, given):
    _, _, df, wanted = given
    assert resample(df.limit(0), wanted).collect() == []
    out = resample(df.where("doc_id < 100"), wanted.limit(0), ResamplePlan(share=10)).collect()
    assert len(out) == 100 and any(r.rank for r in out)
