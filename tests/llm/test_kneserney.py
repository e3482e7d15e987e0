"""Kneser-Ney quality against a plain in-memory model."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hirelake.llm.kneserney import BLOCKS, QualityPlan, _bucketed, _packer, quality
from tests.conftest import plan_of

SCHEMA = "doc_id long, text string, lang string, n_chars long, perplexity string"


def brute(trusted, texts):
    """Perplexities of texts under order-4 interpolated modified Kneser-Ney of the trusted ones."""
    def grams(t):
        cs = [0, 0, 0] + [min(ord(c), 0xFFFF) for c in t]
        return [tuple(cs[i:i + 4]) for i in range(len(t))]
    counts = Counter(g for t in trusted for g in grams(t))
    tables = []
    for order in (4, 3, 2, 1):
        n = Counter(c for c in counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        ds = []
        for k in (1, 2, 3):
            v = k - (k + 1) * y * n[k + 1] / n[k] if n[k] and n[1] else -1
            ds.append(v if 0 < v < k else k / 2)
        total, saved = defaultdict(float), defaultdict(float)
        for g, c in counts.items():
            total[g[:-1]] += c
            saved[g[:-1]] += ds[min(c, 3) - 1]
        own = {g: (c - ds[min(c, 3) - 1]) / total[g[:-1]] for g, c in counts.items()}
        tables.append((own, {h: saved[h] / total[h] for h in total}))
        counts = Counter(g[1:] for g in counts)

    def p(g):
        value = 1 / 65_536
        for own, back in reversed(tables):
            k = len(next(iter(own)))
            s = g[4 - k:]
            value = own.get(s, 0.0) + back.get(s[:-1], 1.0) * value
        return value
    return [math.exp(-sum(math.log(p(g)) for g in grams(t)) / len(t)) if t else None for t in texts]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    say = {"en": ["the", "ing", "re", "tion", "a"], "de": ["sch", "ung", "ei", "ber", "ß"]}
    rows, labels = [], []
    for i in range(160):
        lang = "en" if i % 3 else "de"
        text = " ".join("".join(rng.choices(say[lang], k=2)) for _ in range(rng.choice([1, 30, 200])))
        if i % 10 == 9:
            text = "".join(chr(rng.randrange(33, 127)) for _ in range(300))
        rows.append((i, text, lang, 0, "x"))
        if i % 2:
            labels.append((i, int(i % 10 != 9), 0))
    rows += [(500, None, "en", 0, ""), (501, "", "en", 0, ""), (502, "the ingre", None, 0, ""), (503, "thesch", "xx", 0, ""), (None, "the re", "en", 0, ""), (504, "the 😀 re " * 9000, "en", 0, "")]
    labels += [(3, 1, 0), (None, 1, 0), (7, None, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, {x[0] for x in labels if x[1] == 1 and x[0] is not None}


def test_equals_plain_model(corpus):
    docs, labels, rows, good = corpus
    got = {r.doc_id: r for r in quality(docs, labels, QualityPlan(block_bytes=2000)).collect()}
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    held = {r.doc_id for r in docs.where(F.pmod(F.xxhash64("text"), F.lit(QualityPlan().held_out)) == 0).collect()}
    by = lambda lang: [r[1] for r in rows if r[0] in good and r[0] not in held and (lang is None or r[2] == lang)]
    for lang, ids in (("en", [r[0] for r in rows if r[2] == "en"]), ("de", [r[0] for r in rows if r[2] == "de"]), (None, [502, 503])):
        for i, want in zip(ids, brute(by(lang), [text[i] for i in ids])):
            assert got[i].perplexity == (None if want is None else pytest.approx(want, rel=1e-9)), i
    junk = [i for i in range(160) if i % 10 == 9]
    assert not any(got[i].keep for i in junk) and not got[500].keep and not got[501].keep
    assert sum(got[i].keep for i in range(160) if i % 10 != 9) >= 140
    limits = {r.lang: r.threshold for r in got.values()}
    assert limits["en"] != limits["de"] and got[503].threshold == got[502].threshold


def test_without_labels_and_rows(corpus):
    docs, labels, rows, _ = corpus
    assert quality(docs.limit(0), labels).collect() == []
    got = quality(docs, labels.limit(0)).collect()
    assert len(got) == len(rows) and all(r.perplexity == pytest.approx(65_536) for r in got if r.n_chars)


def test_few_trusted_texts_use_the_pooled_model_and_unseen_ones_stay(corpus):
    docs, labels, rows, good = corpus
    few = sorted(i for i in good if i < 160)[:12]
    got = {r.doc_id: r for r in quality(docs, labels.where(F.col("doc_id").isin(few))).collect()}
    assert len({r.threshold for r in got.values()}) == 1
    clean = [i for i in range(160) if i % 10 != 9]
    assert sum(got[i].keep for i in clean) >= 0.9 * len(clean) and not any(got[i].keep for i in range(160) if i % 10 == 9)


def test_units_that_end_early_change_nothing(corpus):
    docs, labels, rows, _ = corpus
    whole = {r.doc_id: r for r in quality(docs, labels).collect()}
    cut = {r.doc_id: r for r in quality(docs, labels, QualityPlan(block_bytes=2000, unit_grams=50)).collect()}
    assert whole.keys() == cut.keys() and len(whole) == len({r[0] for r in rows})
    for i, r in whole.items():
        assert (cut[i].lang, cut[i].n_chars, cut[i].keep) == (r.lang, r.n_chars, r.keep), i
        assert cut[i].perplexity == (None if r.perplexity is None else pytest.approx(r.perplexity, rel=1e-9)), i
        assert cut[i].threshold == pytest.approx(r.threshold, rel=1e-9), i


def test_texts_are_not_shuffled(spark, corpus, tmp_path):
    """Blocks lie in buckets of their unit, so a join by unit moves the other side alone."""
    given = corpus[0].select("doc_id", "lang", "text", F.lit(False).alias("held"))
    table = _bucketed(given.mapInArrow(_packer(QualityPlan(block_bytes=2000, unit_grams=50)), BLOCKS), str(tmp_path))
    packed = spark.table(table)
    texts, grams = packed.where("ids is not null").select("unit", "ids", "z"), packed.where("ids is null")
    assert sorted(r.id for r in texts.select(F.explode("ids").alias("id")).collect() if r.id is not None) == sorted(r[0] for r in corpus[2] if r[0] is not None)
    assert grams.count() == grams.select("unit").distinct().count() == texts.select("unit").distinct().count() > 2
    sent = grams.select("unit", F.explode("grams").alias("g")).hint("merge").groupBy("unit").agg(F.collect_list("g").alias("gs"))
    plan = plan_of(texts.join(sent.hint("merge"), "unit", "left"))
    scan_of_texts = plan[plan.index("SortMergeJoin"):].split("ObjectHashAggregate")[0]
    assert "Exchange" not in scan_of_texts and "Bucketed: true" in scan_of_texts
    spark.sql(f"DROP TABLE {table}")
