"""Run a user callable over every row, with one session per partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Enricher = Callable[[dict, Any], dict]


def enrich(
    df: DataFrame,
    fn: Enricher,
    schema: T.StructType,
    *,
    key: str = "job_id",
    defaults: dict[str, Any] | None = None,
    error_column: str | None = None,
    open_session: Callable[[], Any] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One output row per input row: ``fn(row, session)`` as a dict.

    A row whose call raises gets the key, the `defaults` and the message in
    `error_column`; so does a row whose answer leaves a non-null field of `schema`
    null (give `defaults` for such fields). Its partition goes on. `open_session` runs once per task and
    its result is closed at the end if it has a `close` method. `partitions`
    spreads the rows round-robin first, for calls much slower than the scan;
    round-robin takes no key, so no key can make one task heavy.
    """
    types = to_arrow_schema(schema).types
    names = schema.fieldNames()
    base = {n: None for n in names} | (defaults or {})

    def failed(row: dict, error: Exception) -> dict:
        message = {error_column: str(error)} if error_column else {}
        return {**base, key: row[key], **message}

    required = [f.name for f in schema if not f.nullable]

    def pack(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = open_session() if open_session else None
        try:
            for batch in batches:
                given, out = batch.to_pylist(), []
                for row in given:
                    try:
                        answer = {**base, key: row[key], **fn(row, session)}
                        for n in required:
                            if answer[n] is None:
                                raise ValueError(f"required field {n} is null")
                        out.append(answer)
                    except Exception as error:
                        out.append(failed(row, error))
                try:
                    yield pack(out)
                except (pa.ArrowException, TypeError, ValueError):
                    # Some value has the wrong type: find its row, keep the others.
                    for i, row in enumerate(given):
                        try:
                            pack([out[i]])
                        except (pa.ArrowException, TypeError, ValueError) as error:
                            out[i] = failed(row, error)
                    yield pack(out)
        finally:
            if hasattr(session, "close"):
                session.close()

    spread = df.repartition(partitions) if partitions else df
    return spread.mapInArrow(run, schema)
