"""Toxicity: held-out accuracy, unseen spellings, odd rows."""

import random
import zlib

import pyarrow as pa
import pytest

from hirelake.llm.toxicity import ToxicPlan, classify, score_texts, train

BAD = ["grumbolt", "fizzwack", "scronker"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    syllables = ["an", "re", "tion", "the", "ed", "or", "is", "ou", "ha", "st", "in", "ly"]
    say = lambda n: ["".join(rng.choices(syllables, k=rng.choice([1, 2, 3]))) for _ in range(n)]
    docs, labels = [], []
    for i in range(900):
        words = say(rng.choice([5, 60, 400]))
        toxic = i % 3 == 0
        if toxic:
            for _ in range(1 + len(words) // 50):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "ing", "ish", ","]))
        docs.append((i, " ".join(words), "en", "src", len(words)))
        labels.append((i, 1, int(toxic)))
    docs += [(None, "the grumbolt", None, None, None), (5000, None, None, None, None), (5001, "", "x", "y", 0)]
    labels += [(None, 1, 1), (5000, 1, None), (5001, 0, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_classified(tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = classify(docs, labels, ToxicPlan(buckets=1 << 14)).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    right = [r.predicted == truth[r.doc_id] for r in held if truth[r.doc_id] is not None]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    empty = {r.doc_id: r for r in rows}
    assert empty[5000].predicted == empty[5001].predicted == 0 and empty[5000].score < 0.01
    assert {r.doc_id: r.score for r in classify(docs, labels, ToxicPlan(buckets=1 << 14)).collect()} == {r.doc_id: r.score for r in rows}


def test_unseen_spellings_and_long_texts(tables):
    plan = ToxicPlan(buckets=1 << 14)
    model = train(*tables, plan)
    clean = "the re tion is an or "
    texts = [clean + "grumbolty " + clean, clean + "SCRONKERZ " + clean, clean * 20_000, clean * 20_000 + "fizzwackle", "an an an an an an", "x" * 200_000]
    s = score_texts(pa.array(texts), model, plan)
    assert min(s[0], s[1], s[3]) > 0.7 and max(s[2], s[4]) < 0.7


def test_one_class_and_no_labels(spark, tables):
    docs, labels = tables
    assert {r.predicted for r in classify(docs, labels.where("toxic = 0")).collect()} == {0}
    assert classify(docs.limit(0), labels.limit(0)).collect() == []
    assert {r.predicted for r in classify(docs, labels.limit(0)).collect()} == {0}


def test_repeated_ids_count_once(spark, tables, monkeypatch):
    import hirelake.llm.toxicity as module

    docs, labels = tables
    given = []
    monkeypatch.setattr(module, "fit", lambda texts, toxic, plan: given.append((texts, toxic.tolist())))
    few = docs.where("doc_id is not null and text is not null")
    train(few, labels)
    copies = few.where("doc_id < 30").crossJoin(spark.range(50)).drop("id")
    train(few.unionByName(copies), labels)
    assert given[0] == given[1] and len(given[0][0]) > 500
