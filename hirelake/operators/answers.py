"""Enrichment by content: a prompt is answered once, however many rows and runs ask it.

Answers are kept in a table keyed by the hash of the prompt text. Only prompts that it
does not have are called for, each once, a bounded number at a time in every task, with a
time limit and repeated tries; rows then join their answers.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from queue import Empty, Queue
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hirelake.operators.upsert import upsert_buckets
from hirelake.sources.bucketed import BucketedTable

Answerer = Callable[[str, Any], dict]
HASH, ERROR = "prompt_hash", "call_error"


@dataclass(frozen=True)
class CallPlan:
    """How calls are made: `threads` at a time in a task, `seconds` for each, up to `tries` with `pause` seconds before the second and twice that before each further one."""

    threads: int = 4
    seconds: float = 180.0
    tries: int = 3
    pause: float = 1.0


def prompt_hash(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def answers_schema(fields: T.StructType) -> T.StructType:
    """The table's schema; an answer that leaves a non-null field null is a failed one."""
    return T.StructType([T.StructField(HASH, T.StringType()), *fields])


def in_time(fn: Callable[[], dict], seconds: float) -> dict:
    """The call's result, or TimeoutError. A call that is late is left behind in its own thread, which does not hold up the task's end."""
    result: Queue = Queue(1)

    def call() -> None:
        try:
            result.put((True, fn()))
        except Exception as error:
            result.put((False, error))

    threading.Thread(target=call, daemon=True).start()
    try:
        good, value = result.get(timeout=seconds)
    except Empty:
        raise TimeoutError(f"no answer within {seconds:g} s") from None
    if good:
        return value
    raise value


def tried(fn: Callable[[], dict], plan: CallPlan) -> dict:
    for k in range(plan.tries):
        try:
            return in_time(fn, plan.seconds)
        except Exception:
            if k + 1 == plan.tries:
                raise
            time.sleep(plan.pause * 2**k)
    raise ValueError("tries must be 1 or more")


def called(prompts: DataFrame, fn: Answerer, fields: T.StructType, plan: CallPlan, open_session: Callable[[], Any] | None) -> DataFrame:
    """(prompt_hash, fields, call_error) of rows (prompt_hash, prompt), in any order."""
    # Failed calls have nulls in all fields.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in answers_schema(fields)] + [T.StructField(ERROR, T.StringType())])
    types, names, required = to_arrow_schema(schema).types, schema.fieldNames(), [f.name for f in fields if not f.nullable]

    def one(key: str, prompt: str, session: Any) -> pa.RecordBatch:
        row = {n: None for n in names} | {HASH: key}
        try:
            answer = tried(lambda: fn(prompt, session), plan)
            missing = [n for n in required if answer.get(n) is None]
            if missing:
                raise ValueError(f"required field {missing[0]} is null")
            full = row | {n: answer.get(n) for n in fields.fieldNames()}
            return pa.RecordBatch.from_arrays([pa.array([full[n]], t) for n, t in zip(names, types)], names=names)
        except Exception as error:
            row[ERROR] = str(error) or type(error).__name__
            return pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows wait here for a free thread, and answers for the next batch: neither queue outgrows a batch.
        for batch in batches:
            todo, done = Queue(), Queue()
            for pair in zip(*(c.to_pylist() for c in batch.columns)):
                todo.put(pair)

            def work() -> None:
                session = None
                try:
                    session = open_session() if open_session else None
                    while True:
                        key, prompt = todo.get_nowait()
                        done.put(one(key, prompt, session))
                except Empty:
                    pass
                except Exception as error:
                    done.put(error)
                finally:
                    if hasattr(session, "close"):
                        session.close()

            threads = [threading.Thread(target=work, daemon=True) for _ in range(min(plan.threads, batch.num_rows))]
            for t in threads:
                t.start()
            for t in threads:
                t.join()
            answers = [done.get() for _ in range(done.qsize())]
            # A session that does not open is no fault of a row: the task fails and runs again.
            for error in answers:
                if isinstance(error, Exception):
                    raise error
            if answers:
                yield pa.Table.from_batches(answers).combine_chunks().to_batches()[0]

    return prompts.select(HASH, "prompt").mapInArrow(run, schema)


def enrich_known(
    df: DataFrame, prompt: Column, fn: Answerer, answers: BucketedTable, *, defaults: dict[str, Any] | None = None, error_column: str | None = None,
    known_column: str | None = None, plan: CallPlan = CallPlan(), open_session: Callable[[], Any] | None = None, partitions: int | None = None,
) -> DataFrame:
    """`df` with the fields of its prompts' answers; only prompts that `answers` lacks are called for.

    `answers` has `answers_schema(fields)` as its schema and `prompt_hash` as its key.
    New answers are stored before rows are joined, so a job that is lost after that, and every
    later run, calls for none of them again. A prompt whose tries all fail stays unanswered: its rows
    get the `defaults` and the message in `error_column`, and the next run tries again. A null
    prompt is not called for and gets the defaults. `known_column` tells which
    answers an earlier run had.
    """
    fields = T.StructType([f for f in answers.schema if f.name != HASH])
    keyed = df.withColumn(HASH, prompt_hash(prompt))
    asked = keyed.select(HASH, prompt.alias("prompt")).where(F.col(HASH).isNotNull())
    known = answers.read()
    # One row per prompt in every map task before the shuffle, so a prompt of a third of all rows is asked once.
    missing = asked.groupBy(HASH).agg(F.first("prompt").alias("prompt")).join(known.select(HASH), HASH, "left_anti")
    # Each task's share is small against the time of a call; round-robin takes no key.
    missing = missing.repartition(partitions or answers.spark.sparkContext.defaultParallelism)
    fresh = answers.stage(called(missing, fn, fields, plan, open_session))
    upsert_buckets(answers, fresh.where(F.col(ERROR).isNull()).drop(ERROR))
    new = fresh.select(HASH, F.lit(True).alias("_new"), F.col(ERROR).alias("_error"))
    both = answers.read().join(new, HASH, "full").withColumn("_found", F.lit(True))
    joined = keyed.join(both, HASH, "left")
    ok = F.col("_found").isNotNull() & F.col("_error").isNull()
    out = [*df.columns]
    for f in fields:
        spare = F.lit((defaults or {}).get(f.name)).cast(f.dataType)
        out.append(F.when(ok, F.col(f.name)).otherwise(spare).alias(f.name))
    if error_column:
        out.append(F.col("_error").alias(error_column))
    if known_column:
        out.append((F.col("_found").isNotNull() & F.col("_new").isNull()).alias(known_column))
    return joined.select(*out)
