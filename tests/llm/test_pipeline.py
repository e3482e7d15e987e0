"""The pipeline's stages on a small corpus with planted cases, each judged on its own input."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm import mixing, sentencepieces, toxicity
from tests.llm.test_setsketch import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    syllables = ["an", "re", "tion", "the", "ed", "or", "is", "ou", "ha", "st", "in", "ly"]
    say = lambda n: ["".join(rng.choices(syllables, k=rng.choice([1, 2, 3]))) + rng.choice(["", "", "", "."]) for _ in range(n)]
    passage = " ".join(say(80))
    docs, labels = [], []
    for i in range(240):
        words = say(rng.choice([20, 60, 150]))
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grumbolt", "grumbolts", "fizzwack"])
        text = " ".join(words)
        if i in (41, 42, 43):
            text = text + " " + passage
        docs.append([i, text, "en", f"s{i % 3}", len(text)])
        labels.append((i, 1, int(toxic)))
    docs[51][1] = docs[50][1]
    near = docs[53][1].split()
    near[3] = "changed"
    docs[54][1] = " ".join(near)
    docs += [[500, "", "en", "s0", 0], [501, None, None, None, None]]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([tuple(d) for d in docs], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {d[0]: d for d in docs}


def test_stages(spark, corpus):
    folder, given = corpus
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-dup", "mixing", "sentencepiece"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/stage{k}")
        before, docs = docs, spark.read.parquet(f"{folder}/stage{k}")
        if k < 4:
            assert docs.columns == names
        kept[name] = docs
        rows = docs.collect()
        ids = {r.doc_id for r in rows}
        if name == "toxicity":
            predicted = {r.doc_id: r.predicted for r in toxicity.classify(before, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
            assert ids == {i for i, p in predicted.items() if p == 0}
            clean = {i for i in given if i % 4 or i >= 500}
            assert len(ids & clean) >= len(clean) - 2 and len(ids - clean) <= 6
        if name == "line dedup":
            texts = {r.doc_id: r.text for r in rows}
            assert 51 not in ids and {500, 501} <= ids
            tail = given[42][1][-200:]
            assert sum(tail in (t or "") for t in texts.values()) <= 1
            assert all(texts[i] == given[i][1] for i in ids - {42, 43, 54})
        if name == "near-dup":
            want = brute([(r.doc_id, r.text) for r in before.collect()])
            assert ids == {i for i, c in want.items() if i == c}
        if name == "mixing":
            words = lambda df: df.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
            assert abs(words(docs) - 1.5 * words(before)) <= 4
        if name == "sentencepiece":
            assert docs.count() == before.count() and all(r.lossless for r in rows)
            back = sentencepieces.decode(docs, sentencepieces.load()).collect()
            assert sorted(r.text for r in back) == sorted(r.text or "" for r in before.collect())


def test_run_repeats_itself(spark, corpus):
    folder, _ = corpus
    runs = [sorted((r.doc_id, tuple(r.pieces)) for r in corpus_pipeline.run(spark, folder).collect()) for _ in range(2)]
    assert runs[0] and runs[0] == runs[1]
    assert corpus_pipeline.ORACLE_SQL is None
