import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoalmark.operators.exchange import TableChanged, data_files_below, exchange_files
from shoalmark.operators.replace import replace_by_source, table_schema
from shoalmark.operators.upsert import upsert
from shoalmark.operators import maintain, metadata, versions
from shoalmark.plans.maintenance import Table, maintain_all
from shoalmark.sources import paths
from shoalmark.sources.filemeta import data_files, file_count, file_stats, partition_stats

UTC = dt.timezone.utc


def tiny_files(spark, path, n=40, partitions=None):
    df = spark.range(400).select("id", (F.col("id") % 3).alias("p"), F.lit("x").alias("t"))
    writer = df.repartition(n).write
    (writer.partitionBy(partitions) if partitions else writer).parquet(path)


def rows(spark, path):
    return Counter(tuple(r) for r in spark.read.parquet(path).select("id", "p", "t").collect())


@pytest.mark.parametrize("partitions", [None, ["p"]])
def test_compaction_keeps_the_rows(spark, path, partitions):
    tiny_files(spark, path, partitions=partitions)
    before = rows(spark, path)
    done = maintain.compact(spark, path, partitions)
    assert rows(spark, path) == before
    assert done.files_before >= 40 and done.files_after == (3 if partitions else 1)
    assert not [c for c in paths.children(spark, path) if c.endswith(maintain.WORK_FOLDER)]
    again = maintain.compact(spark, path, partitions)
    assert again.files_rewritten == 0 and again.files_after == done.files_after


def test_portions(spark, path):
    tiny_files(spark, path, 30, ["p"])
    before = rows(spark, path)
    done = maintain.compact(spark, path, ["p"], per_wave=7)
    assert rows(spark, path) == before and done.files_after < done.files_before


def test_large_files_stay(spark, path):
    tiny_files(spark, path, 4)
    sizes = sorted(r["size"] for r in data_files(spark, path).collect())
    kept = {r["path"] for r in data_files(spark, path).where(F.col("size") == sizes[-1]).collect()}
    maintain.compact(spark, path, below=sizes[-1])
    assert kept <= {r["path"] for r in data_files(spark, path).collect()}


def test_interrupted_before_the_exchange(spark, path):
    tiny_files(spark, path, 5)
    before = rows(spark, path)
    work = f"{path}/{maintain.WORK_FOLDER}/000000"
    spark.read.parquet(path).coalesce(1).write.parquet(f"{work}/new")
    assert rows(spark, path) == before
    assert maintain.finish_interrupted(spark, path) == 1
    assert rows(spark, path) == before


def half_written(spark, path):
    """A folder that another job is writing its new files to, old or not."""
    work = f"{path}/{maintain.WORK_FOLDER}/000000"
    spark.range(3).coalesce(1).write.parquet(f"{work}/new")
    return work


def test_work_of_a_running_job_survives(spark, path):
    schema = "k int, p string, _source_file string"
    rows = spark.createDataFrame([(1, "a", "f"), (2, "a", "f"), (3, "b", "g")], schema)
    upsert(spark, f"{path}/1", rows, "k", "p")
    work = half_written(spark, f"{path}/1")
    upsert(spark, f"{path}/1", rows.withColumn("p", F.lit("c")), "k", "p")
    assert spark.read.parquet(f"{path}/1").where("p = 'c'").count() == 3 and paths.exists(spark, work)
    rows.repartition(2, "k").write.parquet(f"{path}/2")
    work = half_written(spark, f"{path}/2")
    assert maintain.compact(spark, f"{path}/2").files_rewritten == 2 and paths.exists(spark, work)
    table = table_schema(rows.schema)
    for _ in range(2):
        replace_by_source(spark, f"{path}/3", table, rows, rows.select("_source_file").distinct())
        work = half_written(spark, f"{path}/3") if not paths.exists(spark, f"{path}/3/_compaction") else work
    assert spark.read.parquet(f"{path}/3").count() == 3 and paths.exists(spark, work)


def test_old_work_without_a_plan_goes(spark, path):
    tiny_files(spark, path, 3)
    work = half_written(spark, path)
    for folder, _, files in os.walk(work):
        for name in [".", *files]:
            os.utime(f"{folder}/{name}", (0, 0))
    maintain.finish_interrupted(spark, path)
    assert not paths.exists(spark, work)


def test_files_replaced_by_another_job_stop_the_exchange(spark, path):
    tiny_files(spark, path, 3)
    table, before = paths.qualified(spark, path), rows(spark, path)
    old = data_files_below(spark, table)
    found = spark.createDataFrame(spark.read.parquet(path).collect())
    maintain.compact(spark, path)
    with pytest.raises(TableChanged, match="another job"):
        exchange_files(spark, table, old, found, [])
    assert rows(spark, path) == before


@pytest.mark.parametrize("at", [0, 1, 2, 4, 7])
def test_interrupted_during_the_exchange(spark, path, monkeypatch, at):
    tiny_files(spark, path, 6, ["p"])
    before, calls = rows(spark, path), []
    for name in ("move", "remove"):

        def failing(*args, real=getattr(paths, name)):
            calls.append(args)
            if len(calls) > at:
                raise OSError("interrupted")
            return real(*args)

        monkeypatch.setattr(paths, name, failing)
    with pytest.raises(OSError, match="interrupted"):
        maintain.compact(spark, path, ["p"])
    monkeypatch.undo()
    maintain.finish_interrupted(spark, path)
    assert rows(spark, path) == before


@pytest.mark.parametrize("at", [0, 1, 2, 3])
def test_interrupted_upsert_leaves_no_row_twice(spark, path, monkeypatch, at):
    first = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], "k int, p string, v int")
    upsert(spark, path, first, "k", "p")
    moved = spark.createDataFrame([(3, "a", 2)], "k int, p string, v int")
    calls = []
    for name in ("move", "remove"):

        def failing(*args, real=getattr(paths, name)):
            calls.append(args)
            if len(calls) > at:
                raise OSError("interrupted")
            return real(*args)

        monkeypatch.setattr(paths, name, failing)
    with pytest.raises(OSError, match="interrupted"):
        upsert(spark, path, moved, "k", "p")
    monkeypatch.undo()
    maintain.finish_interrupted(spark, path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "p", "v").collect())
    assert got == [(1, "a", 1), (2, "a", 1), (3, "a", 2)]


def test_bases_of_a_change_log_are_no_leftovers(spark, path):
    versions.commit(spark.range(3).withColumnRenamed("id", "k"), path, 1, "insert")
    versions.write_base(spark, path, "k", 1)
    later = dt.datetime.now(UTC) + dt.timedelta(days=30)
    assert maintain.leftover_files(spark, path, later).where("path LIKE '%_bases%'").count() == 0


def test_leftovers_of_failed_jobs(spark, path):
    tiny_files(spark, path, 3)
    for name in ("_temporary/0/a", ".staging"):
        spark.range(3).coalesce(1).write.parquet(f"{path}/{name}")
    now = dt.datetime.now(UTC)
    assert maintain.leftover_files(spark, path, now).count() == 0
    found = maintain.leftover_files(spark, path, now + dt.timedelta(days=8))
    assert found.where("path LIKE '%.parquet'").count() == 2
    assert maintain.remove_files(spark, found) == found.count()
    assert file_count(spark, path) == 3


def test_tables_are_found_in_the_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE kept_db LOCATION '{tmp_path}/db'")
    spark.range(30).selectExpr("id", "id % 2 AS p").repartition(6).write.partitionBy("p").saveAsTable("kept_db.plain")
    spark.range(3).write.saveAsTable("kept_db._own")
    records = maintain_all(spark, str(tmp_path / "lake"), "kept_db", "run-1")
    assert [(r["table_name"], r["operation"], r["status"]) for r in records] == [
        ("plain", "optimize", "completed"),
        ("plain", "expire_snapshots", "skipped"),
        ("plain", "remove_orphan_files", "completed"),
    ]
    assert spark.table("kept_db.plain").count() == 30
    spark.sql("DROP DATABASE kept_db CASCADE")


def test_file_figures(spark, path):
    tiny_files(spark, path, 2, ["p"])
    table = spark.read.parquet(path)
    files = file_stats(table).collect()
    assert sum(r["record_count"] for r in files) == 400
    sizes = [r["file_size_in_bytes"] for r in files]
    assert sizes == sorted(sizes, reverse=True)
    parts = {r["p"]: r for r in partition_stats(table, "p").collect()}
    assert {p: r["record_count"] for p, r in parts.items()} == {0: 134, 1: 133, 2: 133}
    assert sum(r["file_count"] for r in parts.values()) == len(files)


def test_maintenance_run(spark, tmp_path):
    base = str(tmp_path)
    tiny_files(spark, f"{base}/plain", 5)
    old = dt.datetime(2024, 1, 1, tzinfo=UTC)
    for batch in (1, 2):
        df = spark.createDataFrame([("a", batch)], "k string, v int")
        versions.commit(df, f"{base}/log", batch, "update", old)
    tables = [
        Table("plain", f"{base}/plain"),
        Table("log", f"{base}/log", ("batch_id",), "k"),
        Table("broken", f"{base}/broken", ("no_such_column",)),
        Table("_hidden", f"{base}/none"),
    ]
    tiny_files(spark, f"{base}/broken", 2)
    records = maintain_all(spark, base, tables, "run-1", old + dt.timedelta(days=60))
    by = {(r["table_name"], r["operation"]): r for r in records}
    assert len(by) == 9
    assert by["plain", "optimize"]["files_before"] == 5
    assert by["plain", "optimize"]["files_after"] == 1
    assert by["log", "expire_snapshots"]["snapshots_before"] == 2
    assert by["log", "expire_snapshots"]["snapshots_after"] == 1
    assert by["broken", "optimize"]["status"] == "error"
    assert by["broken", "remove_orphan_files"]["status"] == "completed"
    effect = maintain.log_effect(metadata.read(spark, base, metadata.MAINTENANCE_LOG)).collect()
    assert {r["files_removed"] for r in effect if r["table_name"] == "plain"} == {4, 0}


def test_partition_column_with_an_underscore(spark, path):
    df = spark.range(100).select("id", (F.col("id") % 2).cast("int").alias("_source_bucket"))
    df.repartition(6).write.partitionBy("_source_bucket").parquet(path)
    assert file_count(spark, path) == 12
    done = maintain.compact(spark, path, ["_source_bucket"])
    assert (done.files_rewritten, done.files_after) == (12, 2)
    assert spark.read.parquet(path).select("id").distinct().count() == 100


def test_files_with_different_columns(spark, path):
    spark.range(5).coalesce(1).write.parquet(path)
    for _ in range(2):
        more = spark.range(5, 8).select("id", F.lit("x").alias("later")).coalesce(1)
        more.write.mode("append").parquet(path)
    maintain.compact(spark, path)
    table = spark.read.parquet(path)
    assert table.where("later = 'x'").count() == 6 and table.where("later IS NULL").count() == 5
