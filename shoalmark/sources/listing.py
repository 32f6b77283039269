"""Listing of dropped CSV files and of table data files."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.names import table_of_key
from .paths import qualified

log = logging.getLogger(__name__)

# Fixed value: files above this size are reported.
LARGE_FILE_BYTES = 100 * 1024 * 1024


def relative_key(path: Column, root: str) -> Column:
    """File path below ``root``, without the leading slash."""
    return F.substring(path, len(root) + 2, 1 << 30)


def decoded_path(c: Column) -> Column:
    """``_metadata.file_path`` as listings show it: not percent-encoded, one slash after ``file:``."""
    plain = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def list_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """``path, size, modified_at`` of all files below ``root``; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select(
            "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at")
        )
    )


def list_csv(spark: SparkSession, root: str) -> DataFrame:
    """CSV files inside a folder below ``root``: ``key, path, size, modified_at, table_name, is_large``.

    A file directly at the root has no folder to name its table and is left out. So is a file
    without any content; it shows up as soon as it has some.
    """
    base = qualified(spark, root)
    key = relative_key(F.col("path"), base)
    return (
        list_files(spark, root, "*.[cC][sS][vV]")
        .withColumn("key", key)
        .where(F.contains(F.col("key"), F.lit("/")))
        .select(
            "key",
            "path",
            "size",
            "modified_at",
            table_of_key(F.col("key")).alias("table_name"),
            (F.col("size") > LARGE_FILE_BYTES).alias("is_large"),
        )
    )


def warn_large(files: DataFrame) -> int:
    """Log how many files are above the warning size; they are processed all the same."""
    n = files.where("is_large").count()
    if n:
        log.warning("%d file(s) above %d bytes", n, LARGE_FILE_BYTES)
    return n
