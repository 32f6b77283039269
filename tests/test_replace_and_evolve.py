import pytest
from pyspark.sql import functions as F

from shoalmark.operators.evolve import missing_columns, reconcile, united
from shoalmark.sources.filemeta import data_files
from shoalmark.operators.replace import SOURCE_BUCKET, replace_by_source, source_bucket, table_schema

SCHEMA = "id int, _source_file string"


def put(spark, path, rows, files=None, buckets=4):
    df = spark.createDataFrame(rows, SCHEMA)
    names = spark.createDataFrame(
        [(f,) for f in (files or sorted({r[1] for r in rows}))], "_source_file string"
    )
    replace_by_source(spark, path, table_schema(df.schema), df, names, buckets)


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "_source_file").collect())


def test_only_the_named_files_change(spark, path):
    rows = [(n, f"f{n % 6}") for n in range(60)]
    put(spark, path, rows)
    put(spark, path, [(100, "f3"), (101, "f3"), (200, "new")])
    expected = [r for r in rows if r[1] != "f3"] + [(100, "f3"), (101, "f3"), (200, "new")]
    assert content(spark, path) == sorted(expected)


def test_same_file_again_changes_nothing(spark, path):
    rows = [(n, f"f{n % 3}") for n in range(30)]
    for _ in range(3):
        put(spark, path, rows)
    assert content(spark, path) == sorted(rows)


@pytest.mark.parametrize("buckets", [1, 64])
def test_file_that_lost_its_rows(spark, path, buckets):
    put(spark, path, [(1, "a"), (2, "b")], buckets=buckets)
    put(spark, path, [], files=["a"], buckets=buckets)
    assert content(spark, path) == [(2, "b")]


def test_hot_source_is_written_by_several_tasks(spark, path):
    """One source with most rows must not end in one file written by one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 200000, 1, 8).select(
            F.col("id").cast("int").alias("id"), F.lit("hot.csv").alias("_source_file")
        )
        names = df.select("_source_file").limit(1)
        replace_by_source(spark, path, table_schema(df.schema), df, names, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(path)
    assert written.count() == 200000
    assert written.select(F.col("_metadata.file_path")).distinct().count() > 1


def test_bucket_is_stable(spark):
    df = spark.createDataFrame([("a/b.csv",)], "f string").select(source_bucket(F.col("f"), 256))
    assert 0 <= df.first()[0] < 256


def test_missing_columns_and_union(spark):
    assert missing_columns([("a", "INTEGER"), ("b", "VARCHAR")], ["A", SOURCE_BUCKET]) == [
        ("b", "VARCHAR")
    ]
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")
    assert sorted(map(tuple, united([one, two]).collect()), key=str) == [(1, None), (None, "x")]


def test_reconcile(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    out = reconcile(df, drop=["b"], rename={"a": "key"}, widen={"a": "bigint"}, order=["c"])
    assert out.dtypes == [("c", "double"), ("key", "bigint")]
    with pytest.raises(ValueError, match="cannot widen"):
        reconcile(df, widen={"c": "int"})


def test_another_number_of_buckets_replaces_all_the_same(spark, path):
    put(spark, path, [(n, f"s{n % 8}") for n in range(200)], buckets=16)
    put(spark, path, [(1000 + n, f"s{n % 8}") for n in range(200)], buckets=256)
    table = spark.read.parquet(path)
    assert table.count() == 200 and table.where(f"{table.columns[0]} < 1000").isEmpty()


def test_only_files_with_rows_of_the_source_are_rewritten(spark, path):
    put(spark, path, [(1, "a")], buckets=1)
    put(spark, path, [(2, "b")], buckets=1)
    before = {r["path"] for r in data_files(spark, path).collect()}
    put(spark, path, [(3, "a")], buckets=1)
    after = {r["path"] for r in data_files(spark, path).collect()}
    assert len(before) == len(after) == 2 and len(before & after) == 1
