"""Keyed upsert into a date-partitioned Parquet table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import held
from ..sources.paths import exists, qualified
from .exchange import finish_interrupted
from .partitions import (
    append_rows,
    in_values,
    overwrite_partitions,
    partition_values,
)


@dataclass(frozen=True)
class UpsertResult:
    rows_merged: int
    partitions_rewritten: int


def latest_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of every key by the columns ``order``; rows without a key are all kept.

    Rows that are equal in ``order`` are told apart by their other columns, the greatest counts, so
    the result never depends on how the rows are dealt out. Only rows of keys that repeat are
    compared. ``max`` of a struct combines inside each task before the shuffle, so a key that owns a
    third of the rows reaches its reducer as one row per task.
    """
    repeated = (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_n"))
        .where("_n > 1")
        .select(key)
    )
    if repeated.isEmpty():
        return rows
    names = rows.columns
    ranked = F.struct(*order, *[c for c in names if c not in order])
    last = (
        rows.join(repeated, key, "left_semi")
        .groupBy(key)
        .agg(F.max(ranked).alias("_last"))
        .select(*[F.col(f"_last.`{c}`") for c in names])
    )
    return rows.join(repeated, key, "left_anti").select(*names).unionByName(last)


def merged(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the source, and all source rows.

    A NULL key matches nothing, so such target rows stay and such source rows are added.
    """
    keys = source.select(key).where(F.col(key).isNotNull())
    return target.join(keys, key, "left_anti").select(*target.columns).unionByName(source)


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    partition: str,
    order: list[Column] | None = None,
    drop: list[str] | None = None,
) -> UpsertResult:
    """Update rows with a known key in all columns, insert the others.

    ``order`` decides which row of a key counts when the source repeats it (the last one); without
    it, the row with the greatest values in the order of the columns. Columns in ``drop`` only serve
    the order. Rewritten are the partitions of the source rows and the partitions that hold the old
    version of an updated row, found by a scan of two columns. The source needs all columns of the
    table.
    """
    places = {f"_rank{i}": c for i, c in enumerate(order or [])}
    ordered = source.select("*", *[c.alias(name) for name, c in places.items()])
    with held(ordered, "source") as given, held(
        latest_per_key(given, key, list(places)).drop(*places, *(drop or [])), "upsert"
    ) as batch:
        rows_merged = batch.count()
        if rows_merged == 0:
            return UpsertResult(0, 0)
        if not exists(spark, path):
            append_rows(batch, path, partition)
            return UpsertResult(rows_merged, 0)
        finish_interrupted(spark, qualified(spark, path))
        lacking = set(spark.read.parquet(path).columns) - set(batch.columns)
        if lacking:
            raise ValueError(f"the source lacks columns of the table: {sorted(lacking)}")
        target = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
        old_places = target.select(key, partition).join(batch.select(key), key, "left_semi")
        touched = partition_values(old_places.unionByName(batch.select(key, partition)), partition)
        affected = target.where(in_values(partition, touched))
        overwrite_partitions(merged(affected, batch, key), path, partition, touched)
        return UpsertResult(rows_merged, len(touched))


def overwrite_by_partition(df: DataFrame, path: str, partition: str) -> None:
    """Replace every partition present in ``df``; partitions absent from it stay."""
    overwrite_partitions(df, path, partition, set())
