"""Answers by content: one call a prompt, none on the second run, time limits, tries, odd inputs."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.operators.answers import CallPlan, answers_schema, enrich_known, in_time, tried
from hirelake.sources.bucketed import BucketedTable
from hirelake.sources.workspace import shared_folder

FIELDS = T.StructType([T.StructField("n", T.DoubleType(), False), T.StructField("tags", T.ArrayType(T.StringType()))])
QUICK = CallPlan(threads=3, seconds=0.5, tries=2, pause=0.01)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def answers(spark):
    return BucketedTable(spark, shared_folder(spark), answers_schema(FIELDS), key="prompt_hash")


def asker(folder):
    """An answerer that leaves a file per call; text that is no number fails, 'slow' is late."""
    os.makedirs(folder)

    def answer(prompt, _session):
        with open(f"{folder}/{time.time_ns()}-{os.getpid()}-{threading.get_ident()}", "w") as f:
            f.write(prompt)
        if prompt == "slow":
            time.sleep(5)
        if prompt == "null":
            return {"tags": ["x"]}
        if prompt == "wrong":
            return {"n": "text"}
        return {"n": float(prompt), "tags": [prompt]}

    return answer


def test_each_prompt_is_called_once_and_never_again(spark, answers, tmp_path):
    fn = asker(str(tmp_path / "calls"))
    df = spark.createDataFrame([(i, str(i % 7), "own") for i in range(300)] + [(900, None, "own")], "id int, text string, n_own string").repartition(5)
    out = enrich_known(df, F.col("text"), fn, answers, defaults={"n": -1.0}, known_column="known")
    assert out.columns == ["id", "text", "n_own", "n", "tags", "known"]
    assert rows(out) == sorted([(i, str(i % 7), "own", float(i % 7), [str(i % 7)], False) for i in range(300)] + [(900, None, "own", -1.0, None, False)], key=str)
    assert len(os.listdir(tmp_path / "calls")) == 7
    again = enrich_known(df, F.col("text"), fn, answers, known_column="known")
    assert {r.known for r in again.where("text is not null").collect()} == {True}
    more = enrich_known(df.union(spark.createDataFrame([(5, "77", "own")], df.schema)), F.col("text"), fn, answers)
    assert more.count() == 302 and len(os.listdir(tmp_path / "calls")) == 8


def test_failures_are_isolated_and_tried_again(spark, answers, tmp_path):
    fn = asker(str(tmp_path / "calls"))
    df = spark.createDataFrame([("1",), ("x",), ("slow",), ("null",), ("wrong",), ("2",)], "text string")
    out = {r.text: r for r in enrich_known(df, F.col("text"), fn, answers, defaults={"n": -1.0}, error_column="error", plan=QUICK).collect()}
    assert {t: r.n for t, r in out.items()} == {"1": 1.0, "2": 2.0, "x": -1.0, "slow": -1.0, "null": -1.0, "wrong": -1.0}
    assert out["1"].error is None and "could not convert" in out["x"].error and "0.5 s" in out["slow"].error and out["null"].error == "required field n is null" and out["wrong"].error
    first = len(os.listdir(tmp_path / "calls"))
    assert rows(answers.read().select("n")) == [(1.0,), (2.0,)]
    enrich_known(df, F.col("text"), fn, answers, plan=QUICK).collect()
    # Again two tries for each late or failing call, none for the answered ones.
    assert len(os.listdir(tmp_path / "calls")) - first == first - 2


def test_tries_and_time_limit():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return {"a": 1}

    assert tried(flaky, CallPlan(tries=3, pause=0)) == {"a": 1} and len(calls) == 3
    with pytest.raises(TimeoutError):
        in_time(lambda: time.sleep(3), 0.05)


def test_calls_at_a_time_are_bounded(spark, answers):
    def answer(prompt, session):
        with session["lock"]:
            session["now"] += 1
            session["most"] = max(session["most"], session["now"])
        time.sleep(0.01)
        with session["lock"]:
            session["now"] -= 1
        return {"n": float(session["most"])}

    def open_session():
        # Sessions of one task share a counter here, to see how many calls run at once.
        import builtins

        state = getattr(builtins, "_calls", None) or {"lock": threading.Lock(), "now": 0, "most": 0}
        builtins._calls = state
        return state

    df = spark.range(60).select(F.col("id").cast("string").alias("text"))
    out = enrich_known(df, F.col("text"), answer, answers, plan=CallPlan(threads=3), open_session=open_session, partitions=1)
    assert 1 < max(r.n for r in out.collect()) <= 3


def test_empty_table(spark, answers):
    assert enrich_known(spark.createDataFrame([], "text string"), F.col("text"), lambda p, s: {}, answers).collect() == []
