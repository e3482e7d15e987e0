"""A Parquet table in hash buckets of its key, so that an upsert writes only what it touches.

Every version has a manifest that names, for each bucket, the version that wrote its
files. A version counts once its manifest is committed; files of buckets that a batch does
not touch stay as they are and are only named again. Buckets are split one by one as the
table grows (linear hashing), so their size, and with it the cost of a touched key, does
not grow with the table. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.sources.folders import is_committed, names_in, remove

#: The version that wrote a row, stored beside the table's own columns.
WRITTEN = "_written"
_BUCKET = "_bucket"


@dataclass(frozen=True)
class Manifest:
    """(version, rows) of each bucket, in order, and the last batch taken from each stream."""

    version: int = 0
    buckets: tuple[tuple[int, int], ...] = ((0, 0),)
    batches: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.buckets)


def bucket_of(key: Column, whole_row: Column, n: int) -> Column:
    """The bucket, of `n`, of a key; rows without a key are dealt out by all their columns."""
    low = 1 << (n.bit_length() - 1)
    hashed = F.pmod(F.xxhash64(F.when(key.isNotNull(), F.xxhash64(key)).otherwise(whole_row)), F.lit(2 * low))
    return F.when(hashed >= n, hashed - low).otherwise(hashed).cast("int")


def origin(bucket: int, n: int) -> int:
    """The bucket, when there were `n`, that held what `bucket` holds now."""
    while bucket >= n:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "job_id", bucket_rows: int = 250_000, keep: int = 2):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.bucket_rows, self.keep = bucket_rows, keep
        self._stored = T.StructType([*schema.fields, T.StructField(WRITTEN, T.LongType())])

    # --- manifests ---

    def _manifest_folder(self, version: int) -> str:
        return f"{self.root}/manifest/v{version:08d}"

    def _data_folder(self, version: int) -> str:
        return f"{self.root}/data/v{version:08d}"

    def versions(self) -> list[int]:
        """Committed versions that are still kept, oldest first."""
        found = [int(n[1:]) for n in names_in(self.spark, f"{self.root}/manifest") if n[:1] == "v" and n[1:].isdigit()]
        return [v for v in found if is_committed(self.spark, self._manifest_folder(v))]

    def current_version(self) -> int | None:
        kept = self.versions()
        return kept[-1] if kept else None

    def manifest(self, version: int | None = None) -> Manifest:
        """The manifest of a version, the current one by default; that of an empty table before the first."""
        version = self.current_version() if version is None else version
        if not version:
            return Manifest()
        # One short line per bucket: what reaches the driver is the manifest, never rows of the table.
        lines = [json.loads(r.value) for r in self.spark.read.text(self._manifest_folder(version)).collect()]
        buckets = sorted((x["bucket"], x["version"], x["rows"]) for x in lines if "bucket" in x)
        return Manifest(version, tuple((v, n) for _, v, n in buckets), {x["stream"]: x["batch"] for x in lines if "stream" in x})

    def _commit(self, manifest: Manifest) -> None:
        lines = [json.dumps({"bucket": b, "version": v, "rows": n}) for b, (v, n) in enumerate(manifest.buckets)]
        lines += [json.dumps({"stream": s, "batch": b}) for s, b in sorted(manifest.batches.items())]
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(self._manifest_folder(manifest.version))

    # --- rows ---

    def stored_rows(self, manifest: Manifest, buckets: Iterable[int]) -> DataFrame:
        """The rows of these buckets, with the version that wrote each."""
        paths = [f"{self._data_folder(manifest.buckets[b][0])}/{_BUCKET}={b}" for b in buckets if manifest.buckets[b][1]]
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.manifest(version)
        return self.stored_rows(manifest, range(len(manifest.buckets))).drop(WRITTEN)

    def changes(self, version: int | None = None) -> DataFrame | None:
        """(sign, columns): the rows that a version took away (-1) and put in (1).

        None if the version before is no longer kept. Nothing is stored for this: new
        rows carry the version, old ones are those of the same keys one version before.
        """
        kept = self.versions()
        version = version or (kept[-1] if kept else None)
        if version not in kept or (kept.index(version) == 0 and version != 1):
            return None
        before = kept[kept.index(version) - 1] if kept.index(version) else 0
        new, old = self.manifest(version), self.manifest(before)
        written = [b for b, (v, _) in enumerate(new.buckets) if v == version]
        came = self.stored_rows(new, written).where(F.col(WRITTEN) == version).drop(WRITTEN)
        gone = self.stored_rows(old, sorted({origin(b, len(old.buckets)) for b in written})).drop(WRITTEN)
        gone = gone.join(came.select(self.key), self.key, "left_semi").select(*self.schema.fieldNames())
        return came.select(F.lit(1).alias("sign"), "*").unionByName(gone.select(F.lit(-1).alias("sign"), "*"))

    def stage(self, df: DataFrame) -> DataFrame:
        """`df` stored beside the table, as read back; one run's, gone with `retire_staged`."""
        path = f"{self.root}/beside/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def retire_staged(self) -> None:
        """Delete what `stage` stored, when no frame reads it any more."""
        remove(self.spark, f"{self.root}/beside")

    def replace_buckets(self, rows: DataFrame, merge, batch: tuple[str, int] | None = None) -> DataFrame:
        """Write the next version: `merge(old, new)` on the buckets that `rows` touch; returns the table.

        Both arguments have the table's columns and WRITTEN. `rows` is stored first, so a costly or
        non-deterministic plan runs once. A `batch` (stream, number) not after the last one of its
        stream has been taken already and changes nothing.
        """
        old = self.manifest()
        if batch and old.batches.get(batch[0], -1) >= batch[1]:
            return self.read()
        names = self.schema.fieldNames()
        taken = [int(n[1:]) for n in names_in(self.spark, f"{self.root}/data") if n[1:].isdigit()]
        version = max([old.version, *taken]) + 1
        stage = f"{self.root}/stage/{uuid.uuid4().hex}"
        rows.select(*names).write.parquet(stage)
        staged = self.spark.read.schema(self.schema).parquet(stage)
        n_old = len(old.buckets)
        # A first batch is dealt out by its own size; later ones split as many buckets as the rows before them ask for.
        n = max(n_old, -(-(old.rows or staged.count()) // self.bucket_rows), 1)
        bucket = bucket_of(F.col(self.key), F.xxhash64(*names), n)
        touched = {r[0] for r in staged.select(bucket.alias(_BUCKET)).distinct().collect()} | set(range(n_old, n))
        sources = sorted({origin(b, n_old) for b in touched})
        written = touched | {b for b in sources if any(origin(c, n_old) == b for c in range(n_old, n))}
        before = self.stored_rows(old, sources).withColumn(_BUCKET, bucket)
        # A bucket that is split has rows for others too; only those of buckets being written are taken.
        before = before.where(F.col(_BUCKET).isin(sorted(written))).drop(_BUCKET) if sources else before.drop(_BUCKET)
        merged = merge(before, staged.withColumn(WRITTEN, F.lit(version).cast("long")))
        data = self._data_folder(version)
        merged.select(*names, WRITTEN, bucket.alias(_BUCKET)).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(data)
        counts: dict[int, int] = {}
        if names_in(self.spark, data) != ["_SUCCESS"]:
            counts = {r[_BUCKET]: r["count"] for r in self.spark.read.parquet(data).groupBy(_BUCKET).count().collect()}
        buckets = [(version, counts.get(b, 0)) if b in written else old.buckets[b] for b in range(n)]
        self._commit(Manifest(version, tuple(buckets), old.batches | (dict([batch]) if batch else {})))
        self.retire()
        return self.read()

    def retire(self) -> None:
        """Delete what none of the last `keep` versions names: staged rows, old manifests, files of old buckets."""
        kept = self.versions()
        for v in kept[: -self.keep]:
            remove(self.spark, self._manifest_folder(v))
        manifests = [self.manifest(v) for v in kept[-self.keep:]]
        used = reduce(set.union, ({(v, b) for b, (v, n) in enumerate(m.buckets) if n} for m in manifests), set())
        remove(self.spark, f"{self.root}/stage")
        for name in names_in(self.spark, f"{self.root}/data"):
            version, folder = int(name[1:]), f"{self.root}/data/{name}"
            inside = [x for x in names_in(self.spark, folder) if x.startswith(f"{_BUCKET}=")]
            old = [x for x in inside if (version, int(x.partition("=")[2])) not in used]
            if len(old) == len(inside):
                remove(self.spark, folder)
            else:
                for x in old:
                    remove(self.spark, f"{folder}/{x}")
