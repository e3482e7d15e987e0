"""Mixing: targets, permutations, whole coverage, texts."""

import re

import pytest
from pyspark.sql import functions as F

from hirelake.llm.mixing import MixPlan, mix, mixed_documents, permuted, shard_counts, taken_words
from hirelake.llm.stored import stored, work_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, weight string"


def waterfill(sizes, plan):
    """Targets by repeated resharing, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: plan.weights[i % len(plan.weights)] for i, s in enumerate(names)}
    capped, total = {}, plan.share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left, weight = total - sum(capped.values()), sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / weight > plan.most * sizes[s]]
        if not over:
            return capped | {s: left * w[s] / weight for s in free}
        capped |= {s: float(plan.most * sizes[s]) for s in over}


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(300):
        source = ["b", "a", None, "Ω", "zz"][0 if i % 3 else i % 5]
        words = [f"w{i}x{k}" for k in range((i * 37) % 90)]
        rows.append((i, " ".join(words) if i % 50 else None, "en", source, 0, "own", "own"))
    rows += [rows[7], rows[7], (None, "no id here", "en", "a", 0, "", ""), (900, "long " * 30_000, "en", "zz", 0, "", ""), (901, "\t \n", "en", "only blank", 0, "", "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_and_taken(docs):
    plan = MixPlan(block=16, shard_slots=8)
    got = taken_words(docs, plan).toPandas()
    given = docs.toPandas()
    assert len(got) == len(given)
    size = {}
    for text, source in zip(given.text, given.source):
        size[source] = size.get(source, 0) + len(WORD.findall(text or ""))
    want = waterfill(size, plan)
    by_total = {size[s]: s for s in size}
    assert len(by_total) == len(size)
    for total, rows in got.groupby("source_size"):
        s = by_total[total]
        assert rows.target.iloc[0] == pytest.approx(want[s], rel=1e-9)
        assert abs(rows.taken.sum() - want[s]) <= 1
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    again = taken_words(docs.repartition(7), plan).toPandas()
    key = lambda d: sorted(map(tuple, d.fillna(-1).to_numpy().tolist()))
    assert key(again) == key(got)


def test_slots_fill_shards_and_draws_differ(docs):
    plan = MixPlan(block=16, shard_slots=8)
    _, sources, slots, _ = mix(docs, plan)
    rows = slots.toPandas()
    assert sorted(rows.shard * plan.shard_slots + rows.slot) == list(range(len(rows)))
    assert not rows.duplicated(["rank", "pass", "block"]).any()
    assert rows.words.sum() == pytest.approx(sources.toPandas().target.sum(), abs=6)
    counts = shard_counts(slots).toPandas()
    assert counts.n_slots.sum() == len(rows) and counts.groupby("rank").n_slots.nunique().max() > 1


def test_rows_get_the_words_of_the_slots_that_shards_drew(docs):
    plan = MixPlan(block=16, shard_slots=8)
    got = taken_words(docs, plan).collect()
    assert all(sum(s.words for s in r.shards) == r.taken and all(s.words > 0 for s in r.shards) for r in got)
    by_shard = {}
    for r in got:
        for s in r.shards:
            by_shard[s.shard] = by_shard.get(s.shard, 0) + s.words
    slots = mix(docs, plan)[2].groupBy("shard").agg(F.sum("words").alias("words")).collect()
    assert by_shard == {r.shard: r.words for r in slots if r.words}
    assert all(r.shards == [] for r in got if not r.taken) and any(len(r.shards) > 1 for r in got)


def test_permutation_and_inverse(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select("id", permuted(F.col("id"), F.lit(n), 16, F.lit(3)).alias("p"))
        df = df.withColumn("back", permuted(F.col("p"), F.lit(n), 16, F.lit(3), inverse=True)).toPandas()
        assert sorted(df.p) == list(range(n)) and (df.back == df.id).all()


def test_texts_of_the_mix(docs):
    plan = MixPlan(block=16, shard_slots=8)
    out = mixed_documents(docs, plan)
    assert out.columns == docs.columns
    assert {(r["size"], r.weight) for r in out.collect()} <= {("own", "own"), ("", "")}
    names = {"weight": "row", "size": "key", "lang": "order"}
    other = docs.withColumnsRenamed(names).withColumns({"bin": F.lit(1), "size": F.lit("own"), "n": F.lit(2), "of": F.lit(3), "given": F.lit(4), "mix_text": F.lit(5)})
    again = mixed_documents(other, plan)
    assert again.columns == other.columns and again.count() == out.count()
    assert {(r.bin, r["size"], r.n, r.of, r.given, r.mix_text) for r in again.collect()} == {(1, "own", 2, 3, 4, 5)}
    counts = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(WORD.pattern))).alias("n")).collect()}
    taken = {r.doc_id: r.n for r in taken_words(docs, plan).groupBy("doc_id").agg(F.sum("taken").alias("n")).collect()}
    assert counts == {k: v for k, v in taken.items() if v}
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        for line in r.text.split("\n"):
            assert line in whole[r.doc_id]


def test_empty_and_wordless_tables(spark, docs):
    assert taken_words(docs.limit(0)).collect() == []
    assert mixed_documents(docs.limit(0)).collect() == []
    blank = taken_words(docs.where("doc_id = 901")).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)]


def test_native_plan(spark, docs):
    df = taken_words(docs)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    assert stored(spark.range(3), work_folder(spark), "x").count() == 3
