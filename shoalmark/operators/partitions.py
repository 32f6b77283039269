"""Replacing whole partitions of a Parquet table."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.paths import qualified, remove_if_empty
from .exchange import MOVERS, data_files_below, exchange_files, finish_interrupted

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_folder(spark: SparkSession, path: str, column: str, value: Any) -> str:
    if value is None:
        text = _NULL_FOLDER
    else:
        names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        text = names.escapePathName(str(value))
    return f"{path.rstrip('/')}/{column}={text}"


def in_values(column: str, values: Iterable[Any]) -> Column:
    """Membership test that treats NULL as a value; usable for partition pruning."""
    values = set(values)
    known = [v for v in values if v is not None]
    test = F.col(column).isin(known) if known else F.lit(False)
    return test | F.col(column).isNull() if None in values else test


def partition_values(df: DataFrame, column: str) -> set[Any]:
    """Distinct values of a partition column: as many as there are partitions to touch."""
    return {r[0] for r in df.select(column).distinct().collect()}


def append_rows(df: DataFrame, path: str, column: str) -> None:
    """Add rows. Rebalancing by partition value keeps files large and splits a hot partition."""
    df.hint("rebalance", column).write.mode("append").partitionBy(column).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, column: str, touched: set[Any]) -> None:
    """Make ``df`` the new content of the ``touched`` partitions, and of all others it has rows for.

    ``df`` may read the table itself: the new files are written to a hidden folder first. Only when
    every task has succeeded are they exchanged, emptied partitions in the same step, so a failed
    job leaves the old rows and an interrupted exchange can be completed.
    """
    spark = df.sparkSession
    path = qualified(spark, path)
    folders = [partition_folder(spark, path, column, v) for v in touched]
    with ThreadPoolExecutor(MOVERS) as pool:
        old = [f for files in pool.map(lambda x: data_files_below(spark, x), folders) for f in files]
    exchange_files(spark, path, old, df, [column], whole_folders=True)
    finish_interrupted(spark, path)
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(lambda x: remove_if_empty(spark, x), folders))
