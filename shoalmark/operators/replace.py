"""Replacing the rows of source files in a table that many files share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.csvfiles import SOURCE_FILE
from ..sources.listing import decoded_path
from ..sources.paths import exists, qualified
from .exchange import exchange_files, finish_interrupted
from .partitions import append_rows

SOURCE_BUCKET = "_source_bucket"
# Tables are partitioned by a hash bucket of the source file: the rows of a source then lie in few
# data files, and small sources still end up together in large ones.
BUCKETS = 256


def source_bucket(c: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    return df.withColumn(SOURCE_BUCKET, source_bucket(F.col(SOURCE_FILE), buckets))


def table_schema(columns: T.StructType) -> T.StructType:
    """Stored schema: the columns and, last, the bucket."""
    kept = [f for f in columns.fields if f.name != SOURCE_BUCKET]
    return T.StructType([*kept, T.StructField(SOURCE_BUCKET, T.IntegerType())])


def replace_by_source(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rows: DataFrame,
    files: DataFrame,
    buckets: int = BUCKETS,
) -> None:
    """Drop the table rows of ``files`` and add ``rows``; rows of all other files stay.

    ``files`` has one ``_source_file`` per replaced file, also for files that have no rows now.
    Sources the table has not seen are appended. Otherwise only the data files that hold rows of a
    replaced source are written anew, without these rows; they are found by a scan of one column of
    the table, so it does not matter with how many buckets it was written.
    """
    rows = with_bucket(rows, buckets).select(*schema.fieldNames())
    if not exists(spark, path):
        append_rows(rows, path, SOURCE_BUCKET)
        return
    path = qualified(spark, path)
    finish_interrupted(spark, path)
    table = spark.read.schema(schema).parquet(path)
    names = files.select(SOURCE_FILE)
    held_in = table.select(SOURCE_FILE, decoded_path(F.col("_metadata.file_path")).alias("path"))
    stale = [
        r["path"]
        for r in held_in.join(names, SOURCE_FILE, "left_semi").select("path").distinct().collect()
    ]
    if not stale:
        append_rows(rows, path, SOURCE_BUCKET)
        return
    old = spark.read.schema(schema).option("basePath", path).parquet(*stale)
    kept = old.join(names, SOURCE_FILE, "left_anti").select(*schema.fieldNames())
    exchange_files(spark, path, stale, kept.unionByName(rows), [SOURCE_BUCKET])
