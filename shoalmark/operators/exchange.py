"""Exchange of data files of a plain Parquet table.

One job at a time may exchange files of a table. A job that finds files gone it wanted to replace gives
up before it has changed anything; work of other jobs that is not ready is left alone until it is old.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..sources import paths

WORK_FOLDER = "_compaction"
MOVERS = 16
# Fixed value: days of retention.
RETENTION_DAYS = 7
_NEW, _PLAN = "new", "plan"


class TableChanged(OSError):
    """Files that were to be replaced are gone."""


def data_files_below(spark: SparkSession, folder: str) -> list[str]:
    """Data files below ``folder``, in its partition folders."""
    found, folders = [], [folder]
    while folders:
        for child in paths.children(spark, folders.pop()):
            name = child.rsplit("/", 1)[1]
            if name.endswith(".parquet"):
                found.append(child)
            elif "=" in name:
                folders.append(child)
    return found


def _swap(spark: SparkSession, table: str, work: str) -> None:
    """Put the new files in place of the old ones. Safe to run again after an interruption.

    The new files are brought into their folders first, under hidden names; then the old ones go and
    the new ones are shown, many at a time, so that the moment between is short.
    """
    plan = spark.read.schema("path string, is_new boolean").parquet(f"{work}/{_PLAN}").collect()
    mark = f".{work.rsplit('/', 1)[1]}-"

    def hidden(inner: str) -> str:
        folder, name = inner.rsplit("/", 1)
        return f"{table}{folder}/{mark}{name}"

    def hide(inner: str) -> None:
        source = f"{work}/{_NEW}{inner}"
        if paths.exists(spark, source):
            paths.make_folder(spark, f"{table}{inner.rsplit('/', 1)[0]}")
            paths.move(spark, source, hidden(inner))

    def drop(file: str) -> None:
        if paths.exists(spark, file):
            paths.remove(spark, file)

    def show(inner: str) -> None:
        if paths.exists(spark, hidden(inner)):
            paths.move(spark, hidden(inner), f"{table}{inner}")

    new = [r["path"] for r in plan if r["is_new"]]
    with ThreadPoolExecutor(MOVERS) as pool:
        list(pool.map(hide, new))
        list(pool.map(drop, [r["path"] for r in plan if not r["is_new"]]))
        list(pool.map(show, new))
    paths.remove(spark, work)
    if not paths.children(spark, f"{table}/{WORK_FOLDER}"):
        paths.remove_empty(spark, f"{table}/{WORK_FOLDER}")


def exchange_files(
    spark: SparkSession, table: str, old: list[str], rows: DataFrame, partitions: list[str],
    files: int | None = None, whole_folders: bool = False,
) -> None:
    """Replace the data files ``old`` of ``table`` by new ones with ``rows``.

    With ``whole_folders``, all other files of the partitions that receive rows go, too.

    The new files are written to a hidden folder inside the table, then the list of old ones is
    stored, then they are exchanged. Until the list is stored nothing has changed; after that anyone
    can complete the exchange with ``finish_interrupted``. If one of the ``old`` files is gone by then,
    another job has changed the table; the new files are dropped and the job fails.
    """
    work = f"{table}/{WORK_FOLDER}/{uuid.uuid4().hex[:12]}"
    if partitions:
        writer = rows.hint("rebalance", *partitions).write.partitionBy(*partitions)
    else:
        writer = rows.coalesce(files or 1).write
    writer.parquet(f"{work}/{_NEW}")
    base = paths.qualified(spark, f"{work}/{_NEW}")
    new = [(file[len(base) :], True) for file in data_files_below(spark, base)]
    replaced = set(old)
    with ThreadPoolExecutor(MOVERS) as pool:
        still_there = all(pool.map(lambda file: paths.exists(spark, file), old))
    if not still_there:
        paths.remove(spark, work)
        raise TableChanged(f"another job has changed {table}; nothing was exchanged")
    if whole_folders:
        folders = {f"{table}{file.rsplit('/', 1)[0]}" for file, _ in new}
        with ThreadPoolExecutor(MOVERS) as pool:
            replaced.update(*pool.map(lambda folder: data_files_below(spark, folder), folders))
    plan = [*[(file, False) for file in sorted(replaced)], *new]
    listed = spark.createDataFrame(plan, "path string, is_new boolean")
    listed.coalesce(1).write.parquet(f"{work}/{_PLAN}")
    _swap(spark, table, work)


def finish_interrupted(spark: SparkSession, path: str) -> int:
    """Complete what an earlier, interrupted exchange left behind; returns the exchanges found.

    Files without a stored plan may belong to a job that is still writing them. They count for
    nothing, and go when none of them has changed for ``RETENTION_DAYS``.
    """
    pending = paths.children(spark, f"{path}/{WORK_FOLDER}")
    for work in pending:
        if paths.exists(spark, f"{work}/{_PLAN}/_SUCCESS"):
            _swap(spark, path, work)
        elif _age_in_days(spark, work) > RETENTION_DAYS:
            paths.remove(spark, work)
    return len(pending)


def _age_in_days(spark: SparkSession, work: str) -> float:
    changed = paths.changed_at(spark, work)
    newest = max([changed, *(at for _, _, at in paths.files_below(spark, work))])
    return (time.time() - newest / 1000) / 86_400
