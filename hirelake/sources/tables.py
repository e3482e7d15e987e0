"""Named tables: create, materialise, read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hirelake.sources.folders import is_committed, names_in, remove


def target_namespace(custom: str | None, default: str) -> str:
    """The custom namespace, trimmed and unprefixed; else the default."""
    return default if custom is None else custom.strip()


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, provider: str = "parquet", location: str | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Create namespace and table where missing."""
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    where = f" LOCATION '{location}'" if location else ""
    options = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}{where}"
        + (f" TBLPROPERTIES ({options})" if options else "")
    )


def materialize(df: DataFrame, alias: str, namespace: str | None = None, default: str = "gold", path: str | None = None) -> str:
    """Replace table `namespace.alias` by the rows of `df`; returns its name.

    The rows are written to a new folder, under `path` or the namespace's own, and the table is
    pointed to it when they are complete. A job that is lost midway leaves the table as it was,
    readers of the old rows keep them (the replaced folder stays until the next time), and `df`
    may read the table itself.
    """
    spark, space = df.sparkSession, target_namespace(namespace, default)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {space}")
    name = f"{space}.{alias}"
    root = (path or f"{spark.catalog.getDatabase(space).locationUri.rstrip('/')}/{alias}-versions").rstrip("/")
    done = [n for n in names_in(spark, root) if n[:1] == "v" and n[1:].isdigit()]
    folder = f"v{int(done[-1][1:]) + 1 if done else 1:08d}"
    df.write.parquet(f"{root}/{folder}")
    if spark.catalog.tableExists(name) and _same_columns(spark.table(name).schema, df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{root}/{folder}'")
    else:
        # Other columns, or no table yet: its entry is made anew; its rows are complete by now.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        create_table(spark, name, df.schema, location=f"{root}/{folder}")
    spark.catalog.refreshTable(name)
    committed = [n for n in done if is_committed(spark, f"{root}/{n}")]
    for old in done:
        if old not in committed[-1:]:
            remove(spark, f"{root}/{old}")
    return name


def _same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def register(df: DataFrame, view: str) -> DataFrame:
    df.createOrReplaceTempView(view)
    return df
