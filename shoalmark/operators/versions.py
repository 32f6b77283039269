"""A change log that answers reads as of an earlier version.

The log is append-only and partitioned by ``batch_id``. Each batch holds at most one row per key,
with ``op`` (insert, update or delete) and ``_ingested_at``, the same for the whole batch.

Beside the batches, a hidden folder may hold bases: the whole state at some versions. A read as of a
version then opens one base and the batches after it, however long the log is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.csvfiles import INGESTED_AT
from ..sources.paths import children, exists, remove
from .partitions import overwrite_partitions, partition_values

BATCH, OP, DELETE = "batch_id", "op", "delete"
BASES = "_bases"


def commit(
    rows: DataFrame, path: str, batch_id: int, op: str | Column, at: dt.datetime | None = None
) -> None:
    """Append one batch. Running it again for the same ``batch_id`` replaces that batch only.

    Bases at or after ``batch_id`` don't hold for the new log and are removed first.
    """
    _drop_bases(rows.sparkSession, path, batch_id)
    moment = F.current_timestamp() if at is None else F.lit(at)
    batch = (
        rows.withColumn(OP, F.lit(op) if isinstance(op, str) else op)
        .withColumn(INGESTED_AT, moment.cast("timestamp"))
        .withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .drop("_op")
    )
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        BATCH
    ).parquet(path)


def _numbers(spark: SparkSession, folder: str, column: str) -> list[int]:
    """Values of a numbered partition folder, in order; one for each version."""
    names = [child.rsplit("/", 1)[1] for child in children(spark, folder)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def bases(spark: SparkSession, path: str) -> list[int]:
    """Versions whose state is stored as a whole."""
    found = _numbers(spark, f"{path}/{BASES}", "version")
    return [v for v in found if exists(spark, f"{path}/{BASES}/version={v}/_SUCCESS")]


def _drop_bases(spark: SparkSession, path: str, since: int, upto: int | None = None) -> None:
    for v in _numbers(spark, f"{path}/{BASES}", "version"):
        if v >= since and (upto is None or v <= upto):
            remove(spark, f"{path}/{BASES}/version={v}")


def _with_base(spark: SparkSession, path: str, key: str, version: int) -> DataFrame:
    """Newest log rows per key as of ``version``, deletes left out."""
    base = max((v for v in bases(spark, path) if v <= version), default=None)
    stored = f"{path}/{BASES}/version={base}"
    later = [
        f"{path}/{BATCH}={b}"
        for b in _numbers(spark, path, BATCH)
        if b <= version and (base is None or b > base)
    ]
    if later:
        log = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*later)
        log = log.withColumn(BATCH, F.col(BATCH).cast("bigint"))
        if base is not None:
            log = spark.read.parquet(stored).unionByName(log, allowMissingColumns=True)
        return _newest(log, key).where(F.col(OP) != DELETE)
    return spark.read.parquet(stored) if base is not None else read_log(spark, path).where(F.lit(False))


def write_base(spark: SparkSession, path: str, key: str, version: int) -> None:
    """Store the state at ``version``, computed from the base before it and the batches since."""
    state = _with_base(spark, path, key, version)
    state.write.mode("overwrite").parquet(f"{path}/{BASES}/version={version}")


def keep_bases(spark: SparkSession, path: str, key: str, every: int) -> int | None:
    """Store a base at the newest version if ``every`` batches or more have come since the last base.

    Called after each commit, it keeps every read as of a version to one base and fewer than ``every``
    batches. Returns the version of a new base.
    """
    found = _numbers(spark, path, BATCH)
    last = max(bases(spark, path), default=None)
    if not found or sum(last is None or b > last for b in found) < every:
        return None
    write_base(spark, path, key, found[-1])
    return found[-1]


def as_of_version(spark: SparkSession, path: str, key: str, version: int) -> DataFrame:
    """Table state at ``version``, from the last base up to it and the batches after that.

    The same rows as ``as_of``, with all columns that base and batches have. Only these folders are
    listed and read.
    """
    return _with_base(spark, path, key, version).drop(OP)


def read_log(spark: SparkSession, path: str, all_columns: bool = False) -> DataFrame:
    """The log with ``batch_id`` as a number.

    ``all_columns`` looks into every file for columns, for a log whose batches differ in them.
    """
    log = spark.read.option("mergeSchema", all_columns).parquet(path)
    return log.withColumn(BATCH, F.col(BATCH).cast("bigint"))


def _newest(log: DataFrame, key: str) -> DataFrame:
    """Newest log row per key, combined inside each task before the shuffle."""
    names = log.columns
    return (
        log.groupBy(key).agg(F.max_by(F.struct(*names), BATCH).alias("_row")).select("_row.*")
    )


def as_of(
    log: DataFrame,
    key: str,
    version: int | None = None,
    timestamp: dt.datetime | None = None,
) -> DataFrame:
    """Table state at a version or a moment; the current state without either.

    The version is a partition column, so later batches are not read at all.
    """
    if version is not None:
        log = log.where(F.col(BATCH) <= version)
    if timestamp is not None:
        log = log.where(F.col(INGESTED_AT) <= F.lit(timestamp).cast("timestamp"))
    return _newest(log, key).where(F.col(OP) != DELETE).drop(OP)


def batches(log: DataFrame) -> DataFrame:
    """One row per version with its parent, commit time and counts, newest first."""
    found = log.groupBy(BATCH).agg(
        F.max(INGESTED_AT).alias("committed_at"),
        F.count_if(F.col(OP) == "insert").alias("inserted"),
        F.count_if(F.col(OP) == "update").alias("updated"),
        F.count_if(F.col(OP) == DELETE).alias("deleted"),
    )
    # One row per version is left here, so ordering them in one place is no bottleneck.
    return found.withColumn("parent_id", F.lag(BATCH).over(Window.orderBy(BATCH))).orderBy(
        F.desc(BATCH)
    )


def version_count(log: DataFrame) -> int:
    return log.select(BATCH).distinct().count()


def compare_counts(log: DataFrame, key: str, versions: dict[str, int | None]) -> DataFrame:
    """Row counts of several versions under one label each, from a single pass over the log."""
    labels = list(versions)
    limits = {label: versions[label] for label in labels}
    per_key = log.groupBy(key).agg(
        *[
            F.max_by(
                OP, F.when(F.lit(True) if v is None else F.col(BATCH) <= v, F.col(BATCH))
            ).alias(f"_op{i}")
            for i, v in enumerate(limits.values())
        ]
    )
    counted = per_key.agg(
        *[F.count_if(F.col(f"_op{i}") != DELETE).alias(label) for i, label in enumerate(labels)]
    )
    return counted.unpivot([], labels, "version", "rows")


def rollback(spark: SparkSession, path: str, key: str, version: int, batch_id: int) -> None:
    """Append a batch that brings back the state of ``version``."""
    log = read_log(spark, path)
    touched = log.where(F.col(BATCH) > version).select(key).distinct()
    state = as_of(log, key, version).drop(BATCH, INGESTED_AT)
    restored = state.join(touched, key, "left_semi").withColumn(OP, F.lit("update"))
    gone = touched.join(state.select(key), key, "left_anti").withColumn(OP, F.lit(DELETE))
    rows = restored.unionByName(gone, allowMissingColumns=True)
    commit(rows.withColumnRenamed(OP, "_op"), path, batch_id, F.col("_op"))


def expired(log: DataFrame, key: str, cutoff: dt.datetime) -> DataFrame:
    """What is left of the batches at or before ``cutoff``: the state at the cutoff.

    For each key that is its newest old row, unless that is a delete. Together with the untouched
    younger batches it still answers every read as of a younger version.
    """
    old = log.where(F.col(INGESTED_AT) <= F.lit(cutoff).cast("timestamp"))
    return _newest(old, key).where(F.col(OP) != DELETE)


def expire(spark: SparkSession, path: str, key: str, cutoff: dt.datetime) -> int:
    """Drop log rows that no version after ``cutoff`` needs; returns the versions removed.

    Only old batches are rewritten. The rows keep their batch, so emptied batches disappear.
    """
    log = read_log(spark, path, all_columns=True)
    old = log.where(F.col(INGESTED_AT) <= F.lit(cutoff).cast("timestamp"))
    touched = partition_values(old, BATCH)
    before = version_count(log)
    if touched:
        _drop_bases(spark, path, min(touched), max(touched) - 1)
        overwrite_partitions(expired(log, key, cutoff), path, BATCH, touched)
    return before - version_count(read_log(spark, path)) if touched else 0
