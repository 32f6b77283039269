"""Append-only metadata tables: ingest registry, quality results, maintenance log."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import DETAILS_LIMIT, ERROR_LIMIT
from ..sources.paths import exists

REGISTRY = "_ingest_registry"
QUALITY_RESULTS = "_quality_results"
MAINTENANCE_LOG = "_maintenance_log"
# Status of a file whose size or time has changed, but not its content.
UNCHANGED = "unchanged"

# Size and time of a file stand beside its tag, so that an unchanged file is not read again.
SCHEMAS = {
    REGISTRY: (
        "file_key string, etag string, table_name string, row_count bigint, status string, "
        "error_message string, ingested_at timestamp, run_id string, "
        "size bigint, modified_at timestamp, rejected bigint, ragged bigint"
    ),
    QUALITY_RESULTS: (
        "check_name string, check_type string, table_name string, column_name string, "
        "status string, failing_rows bigint, total_rows bigint, details string, run_id string, "
        "executed_at timestamp"
    ),
    MAINTENANCE_LOG: (
        "table_name string, operation string, status string, details string, "
        "snapshots_before bigint, snapshots_after bigint, files_before bigint, "
        "files_after bigint, run_id string, executed_at timestamp"
    ),
}
TIME_COLUMN = {
    REGISTRY: "ingested_at",
    QUALITY_RESULTS: "executed_at",
    MAINTENANCE_LOG: "executed_at",
}


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _fitted(name: str, row: dict[str, Any]) -> dict[str, Any]:
    row = dict(row)
    if name == REGISTRY:
        row["error_message"] = (row.get("error_message") or "")[:ERROR_LIMIT]
    else:
        row["details"] = (row.get("details") or "")[:DETAILS_LIMIT]
    if name == QUALITY_RESULTS:
        row["column_name"] = row.get("column_name") or ""
    row.setdefault(TIME_COLUMN[name], now())
    return row


def append(spark: SparkSession, root: str, name: str, rows: list[dict[str, Any]]) -> None:
    """Add records: one per processed file, check or operation of a run."""
    if not rows:
        return
    columns = [part.split()[0] for part in SCHEMAS[name].split(",")]
    data = [tuple(_fitted(name, row).get(c) for c in columns) for row in rows]
    spark.createDataFrame(data, SCHEMAS[name]).coalesce(1).write.mode("append").parquet(
        f"{root}/{name}"
    )


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All records; an empty frame before the first append."""
    path = f"{root}/{name}"
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def newest(records: DataFrame, time_column: str, n: int = 20, *ties: str) -> DataFrame:
    """The latest ``n`` records."""
    return records.orderBy(F.desc(time_column), *ties).limit(n)


def known_files(registry: DataFrame) -> DataFrame:
    """What the table holds of each file: ``key, etag, size, modified_at`` of its last good record.

    Failed loads do not count, so such files are tried again. A file that has got an earlier content
    back is another file than the one loaded last.
    """
    good = registry.where(F.col("status").isin("success", UNCHANGED))
    last = F.max_by(F.struct("etag", "size", "modified_at"), "ingested_at").alias("_last")
    return good.groupBy(F.col("file_key").alias("key")).agg(last).select("key", "_last.*")


def new_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose key, size and time are not those of a loaded file."""
    known = known_files(registry).drop("etag")
    return files.join(known, ["key", "size", "modified_at"], "left_anti")


def changed_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose key and content tag are not those of a loaded file."""
    return files.join(known_files(registry).select("key", "etag"), ["key", "etag"], "left_anti")
