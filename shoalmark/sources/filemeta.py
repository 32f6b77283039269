"""File and partition figures of Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .listing import list_files, relative_key
from .paths import qualified


# Names that begin with an underscore or a point are hidden, unless they are partition folders.
_HIDDEN = r"(^|/)[_.][^=/]*(/|$)"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, size, modified_at, partition`` of the table's data files, from the listing alone.

    ``partition`` is the folder below the table (``day=2024-01-01``), empty without partitions.
    """
    base = qualified(spark, path)
    key = relative_key(F.col("path"), base)
    folder = F.regexp_extract(key, "^(.*)/[^/]*$", 1)
    return (
        list_files(spark, path, "*.parquet")
        .where(~key.rlike(_HIDDEN))
        .withColumn("partition", folder)
    )


def file_stats(table: DataFrame) -> DataFrame:
    """One row per data file with its record count and size, largest first."""
    meta = F.col("_metadata")
    return (
        table.groupBy(
            meta["file_path"].alias("file_path"), meta["file_size"].alias("file_size_in_bytes")
        )
        .agg(F.count("*").alias("record_count"))
        .select(
            "file_path", F.lit("PARQUET").alias("file_format"), "record_count", "file_size_in_bytes"
        )
        .orderBy(F.desc("file_size_in_bytes"), "file_path")
    )


def file_count(spark: SparkSession, path: str) -> int:
    return data_files(spark, path).count()


def partition_stats(table: DataFrame, partition: str | Column) -> DataFrame:
    """Rows, files and bytes per partition value.

    Rows are counted per file first, so the second step sees one row per file.
    """
    value = F.col(partition) if isinstance(partition, str) else partition
    name = partition if isinstance(partition, str) else "partition"
    per_file = table.groupBy(
        value.alias(name),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count("*").alias("n"))
    return per_file.groupBy(name).agg(
        F.sum("n").alias("record_count"),
        F.count("*").alias("file_count"),
        F.sum("file_size").alias("total_size"),
    )
