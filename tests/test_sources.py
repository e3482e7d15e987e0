"""Tables replaced at once, and ranges of day folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelake.schemas import RAW_A
from hirelake.sources.csv_export import ARRAYS, read_csv, write_csv
from hirelake.sources.folders import names_in
from hirelake.sources.snapshots import read_days, stored_days, write_snapshot
from hirelake.sources.tables import materialize
from hirelake.sources.workspace import shared_folder

KV = "job_id string, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("own_path", [True, False])
def test_a_failing_job_leaves_the_old_table(spark, own_path):
    path = shared_folder(spark) + "/gold" if own_path else None
    alias = f"swap_{own_path}"
    name = materialize(spark.createDataFrame([("a", 1)], KV), alias, "swap_t", path=path)
    assert rows(spark.table(name)) == [("a", 1)]
    bad = spark.createDataFrame([("b", 2), ("c", 3)], KV).repartition(2).withColumn("v", F.when(F.col("job_id") == "c", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        materialize(bad, alias, "swap_t", path=path)
    assert rows(spark.table(name)) == [("a", 1)]
    held = spark.table(name)
    materialize(spark.createDataFrame([("d", 4)], KV), alias, "swap_t", path=path)
    assert rows(spark.table(name)) == [("d", 4)]
    # A reader that began before still has its rows.
    assert rows(held.where("v < 3")) in ([("a", 1)], [])
    # The table's own rows may be what replaces them.
    materialize(spark.table(name).unionByName(spark.createDataFrame([("e", 5)], KV)), alias, "swap_t", path=path)
    assert rows(spark.table(name)) == [("d", 4), ("e", 5)]
    materialize(spark.createDataFrame([(7,)], "n int"), alias, "swap_t", path=path)
    assert spark.table(name).columns == ["n"] and rows(spark.table(name)) == [(7,)]
    if path:
        assert len(names_in(spark, path)) == 2


def test_a_range_reads_only_its_folders(spark):
    root = shared_folder(spark)
    days = [dt.date(2024, 2, 28) + dt.timedelta(days=i) for i in range(5)]
    for i, day in enumerate(days):
        write_snapshot(spark.createDataFrame([(f"j{i}", i)], KV), root, day)
    spark.createDataFrame([("x", 9)], KV).write.parquet(f"{root}/not-a-day")
    assert stored_days(spark, root) == days
    schema = spark.createDataFrame([], KV).schema
    read = read_days(spark, root, days[1], days[3], schema)
    assert rows(read) == [(f"j{i}", i, days[i]) for i in (1, 2, 3)]
    assert {f.rsplit("/", 2)[1] for f in read.inputFiles()} == {"2024-2-29", "2024-3-1", "2024-3-2"}
    assert rows(read_days(spark, root, dt.date(2020, 1, 1), dt.date(2020, 1, 2), schema)) == []
    assert rows(read_days(spark, root + "/none", days[0], days[4], schema)) == []


def test_a_file_of_one_row_group_is_dealt_out(spark, tmp_path):
    from verification.fixture import spread

    path = str(tmp_path / "one")
    spark.range(1_000).coalesce(1).write.parquet(path)
    asked = spark.conf.get("spark.hirelake.verification.partitions")
    spark.conf.unset("spark.hirelake.verification.partitions")
    try:
        dealt = spread(spark.read.parquet(path), "id")
        assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert dealt.count() == 1_000
        many = spark.range(0, 1_000, 1, 64)
        assert spread(many, "id") is many
    finally:
        spark.conf.set("spark.hirelake.verification.partitions", asked)


def test_export_of_one_task_is_read_by_several(spark, tmp_path):
    """Values with line breaks keep a file in one task, so a file holds few rows."""
    values = {f.name: F.concat(F.lit(f"{f.name}\n\""), F.col("id").cast("string")) for f in RAW_A}
    typed = [F.array(values[f.name]).alias(f.name) if f.name in ARRAYS else F.col("id").alias(f.name) if f.name == "source_page" else values[f.name].alias(f.name) for f in RAW_A]
    given = spark.range(250).coalesce(1).select(*typed)
    write_csv(given, f"{tmp_path}/csv", file_rows=100)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 3
    assert sorted(map(str, read_csv(spark, f"{tmp_path}/csv").collect())) == sorted(map(str, given.collect()))
