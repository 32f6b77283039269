"""Compaction of small data files and removal of what failed jobs have left behind."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import paths
from ..sources.filemeta import data_files
from .exchange import RETENTION_DAYS, WORK_FOLDER, exchange_files, finish_interrupted
from .versions import BASES

# Fixed value: files below this size are compacted.
SMALL_FILE_BYTES = 10 * 1024 * 1024
TARGET_BYTES = 128 * 1024 * 1024
FILES_PER_WAVE = 10_000


@dataclass(frozen=True)
class Compaction:
    files_before: int
    files_after: int
    files_rewritten: int


def small_files(spark: SparkSession, path: str, below: int = SMALL_FILE_BYTES) -> DataFrame:
    """Small files of partitions that have at least two of them: ``path, size, partition``."""
    small = data_files(spark, path).where(F.col("size") < below)
    crowded = small.groupBy("partition").agg(F.count("*").alias("n")).where("n > 1")
    return small.join(crowded.select("partition"), "partition", "left_semi").select(
        "path", "size", "partition"
    )


def _waves(files: DataFrame, size: int) -> Iterator[list]:
    """Listing rows in portions, whole partitions together where a portion can hold them."""
    wave: list = []
    for row in files.orderBy("partition", "path").toLocalIterator():
        if len(wave) >= size:
            yield wave
            wave = []
        wave.append(row)
    if wave:
        yield wave


def compact(
    spark: SparkSession,
    path: str,
    partitions: list[str] | None = None,
    below: int = SMALL_FILE_BYTES,
    target: int = TARGET_BYTES,
    per_wave: int = FILES_PER_WAVE,
) -> Compaction:
    """Merge small files; rows and large files stay as they are. Nothing to do is no error.

    A portion of the listed files is rewritten by one job and exchanged. The files of a portion may
    have different columns; the new ones have all of them.
    """
    path = paths.qualified(spark, path)
    finish_interrupted(spark, path)
    before = data_files(spark, path).count()
    todo = small_files(spark, path, below)
    rewritten = 0
    for wave in _waves(todo, per_wave):
        old = [row["path"] for row in wave]
        rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*old)
        files = math.ceil(sum(row["size"] for row in wave) / target)
        exchange_files(spark, path, old, rows, partitions or [], files=files)
        rewritten += len(wave)
    return Compaction(before, data_files(spark, path).count(), rewritten)


def leftover_files(
    spark: SparkSession, path: str, now: dt.datetime, retention_days: int = RETENTION_DAYS
) -> DataFrame:
    """``path, size, modified_at`` of old files in the hidden folders of a table.

    Failed jobs leave such folders (``_temporary``, staging folders) behind; no reader sees them, so
    nothing refers to their files. Files younger than the retention may belong to a running job. The
    bases of a change log are no leftovers.
    """
    cutoff = int((now - dt.timedelta(days=retention_days)).timestamp() * 1000)
    found = [
        (name, size, dt.datetime.fromtimestamp(changed / 1000, dt.timezone.utc))
        for folder in paths.children(spark, path)
        if folder.rsplit("/", 1)[1][:1] in "._" and "=" not in folder.rsplit("/", 1)[1]
        if folder.rsplit("/", 1)[1] != BASES
        for name, size, changed in paths.files_below(spark, folder)
        if changed < cutoff
    ]
    return spark.createDataFrame(found, "path string, size bigint, modified_at timestamp")


def remove_files(spark: SparkSession, files: DataFrame) -> int:
    """Delete the listed files; a step of its own, to be taken after looking at the list."""
    n = 0
    for row in files.select("path").toLocalIterator():
        n += bool(paths.remove(spark, row["path"]))
    return n


def log_effect(log: DataFrame) -> DataFrame:
    """Files and versions saved per maintenance record, newest first."""
    return log.select(
        "table_name",
        "operation",
        "status",
        (F.col("files_before") - F.col("files_after")).alias("files_removed"),
        (F.col("snapshots_before") - F.col("snapshots_after")).alias("snapshots_removed"),
        "executed_at",
    ).orderBy(F.desc("executed_at"), "table_name", "operation")
