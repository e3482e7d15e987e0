"""A Parquet table kept as numbered, immutable version folders.

A version counts once Spark's commit marker is in it, so a reader never sees a
half-written one and a job lost midway leaves the previous version current.
One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _folder(self, version: int) -> str:
        return f"{self.root}/v{version:08d}"

    def _listing(self) -> tuple[list[int], list[int]]:
        """(committed, all) version numbers, from one listing of the root folder."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return [], []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        found = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
        marker = jvm.org.apache.hadoop.fs.Path
        return [v for v in found if fs.exists(marker(f"{self._folder(v)}/_SUCCESS"))], found

    def current_version(self) -> int | None:
        committed, _ = self._listing()
        return committed[-1] if committed else None

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """`df` stored beside the versions, as read back; gone with the next `retire`."""
        path = f"{self.root}/stage-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(self.schema).parquet(path)

    def retire(self, keep: int = 2) -> None:
        """Delete staged rows and all versions but the last `keep` committed ones, which a running reader may hold."""
        committed, found = self._listing()
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = [self._folder(v) for v in found if v not in committed[-keep:]]
        staged = [s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().startswith("stage-")]
        for folder in old + staged:
            fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)

    def read(self) -> DataFrame:
        """Current rows; an empty frame before the first write."""
        version = self.current_version()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def write(self, df: DataFrame) -> DataFrame:
        """Store `df` as the next version and return it as read back."""
        _, used = self._listing()
        df.select(*self.schema.fieldNames()).write.parquet(self._folder(used[-1] + 1 if used else 1))
        return self.read()
