"""A run-scoped folder on storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a temporary folder;
    on a cluster the setting is required, because local disks are not shared
    and vanish with their machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return tempfile.mkdtemp(prefix="hirelake-")
    return f"{root.rstrip('/')}/hirelake-{uuid.uuid4().hex}"
