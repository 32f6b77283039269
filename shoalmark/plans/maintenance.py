"""Maintenance of all tables: compaction, expiry of versions, leftovers of failed jobs."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from ..functions.text import ERROR_LIMIT
from ..operators import maintain, metadata, versions
from ..sources import catalog
from ..sources.filemeta import data_files

log = logging.getLogger(__name__)

TABLES_AT_ONCE = 4
# Status words and operations of the log.
COMPLETED, ERROR, SKIPPED = "completed", "error", "skipped"
OPTIMIZE, EXPIRE, ORPHANS = "optimize", "expire_snapshots", "remove_orphan_files"


class Skipped(Exception):
    """The operation does not apply to the table."""


@dataclass(frozen=True)
class Table:
    """A maintained table. ``key`` marks a change log."""

    name: str
    path: str
    partitions: tuple[str, ...] = ()
    key: str | None = None


def _figures(spark: SparkSession, table: Table) -> tuple[int, int]:
    files = data_files(spark, table.path).count()
    if table.key is None:
        return 0, files
    return versions.version_count(versions.read_log(spark, table.path)), files


def _operations(
    spark: SparkSession, table: Table, now: dt.datetime, days: int
) -> dict[str, Callable[[], str]]:
    cutoff = now - dt.timedelta(days=days)

    def optimize() -> str:
        done = maintain.compact(spark, table.path, list(table.partitions) or None)
        return f"{done.files_rewritten} file(s) rewritten"

    def expire() -> str:
        if table.key is None:
            raise Skipped("no version history")
        return f"{versions.expire(spark, table.path, table.key, cutoff)} version(s) expired"

    def orphans() -> str:
        found = maintain.leftover_files(spark, table.path, now, days)
        return f"{maintain.remove_files(spark, found)} orphan file(s) removed"

    return {OPTIMIZE: optimize, EXPIRE: expire, ORPHANS: orphans}


def user_tables(spark: SparkSession, database: str) -> list[Table]:
    """The user tables of a database; the table property ``history.key`` marks a change log."""
    found = []
    for name in catalog.user_tables(spark, database):
        full = f"`{database}`.`{name}`"
        path, properties = catalog.place(spark, full), catalog.properties(spark, full)
        parts = [c.name for c in spark.catalog.listColumns(full) if c.isPartition]
        found.append(Table(name, path, tuple(parts), properties.get("history.key")))
    return found


def maintain_table(
    spark: SparkSession,
    table: Table,
    run_id: str,
    now: dt.datetime | None = None,
    days: int = maintain.RETENTION_DAYS,
) -> list[dict[str, Any]]:
    """One record per operation. A failing operation does not keep the others from running."""
    now = now or metadata.now()
    records = []
    snapshots, files = _figures(spark, table)
    for name, operation in _operations(spark, table, now, days).items():
        status, details = COMPLETED, ""
        try:
            details = operation()
        except Skipped as reason:
            status, details = SKIPPED, str(reason)
        except (PySparkException, Py4JJavaError, OSError, ValueError) as problem:
            log.warning("%s on %s failed: %s", name, table.name, problem)
            status, details = ERROR, str(problem)[:ERROR_LIMIT]
        snapshots_after, files_after = _figures(spark, table)
        records.append(
            {
                "table_name": table.name,
                "operation": name,
                "status": status,
                "details": details,
                "snapshots_before": snapshots,
                "snapshots_after": snapshots_after,
                "files_before": files,
                "files_after": files_after,
                "run_id": run_id,
            }
        )
        snapshots, files = snapshots_after, files_after
    return records


def maintain_all(
    spark: SparkSession,
    lake: str,
    tables: list[Table] | str,
    run_id: str,
    now: dt.datetime | None = None,
    days: int = maintain.RETENTION_DAYS,
) -> list[dict[str, Any]]:
    """Maintain user tables (no leading underscore) and log what was done.

    ``tables`` may be the name of a database. Whatever happens to one table, the records of the
    others are stored.
    """
    known = user_tables(spark, tables) if isinstance(tables, str) else tables
    wanted = sorted((t for t in known if not t.name.startswith("_")), key=lambda t: t.name)
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        runs = [pool.submit(maintain_table, spark, t, run_id, now, days) for t in wanted]
    records = [record for run in runs if run.exception() is None for record in run.result()]
    metadata.append(spark, lake, metadata.MAINTENANCE_LOG, records)
    for run in runs:
        run.result()
    return records
