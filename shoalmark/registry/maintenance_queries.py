"""Compaction, leftovers, file figures and the maintenance log."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import DETAILS_LIMIT, ERROR_LIMIT, fitted
from ..operators import maintain, metadata
from ..plans.maintenance import Table, maintain_all
from ..operators import versions
from ..session import scratch_path, staged
from ..sources import catalog
from ..sources.filemeta import file_stats
from ..sources.listing import decoded_path
from .common import load, plain

STATUS = "o_orderstatus"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", STATUS
    )


def _small_files(spark: SparkSession, folder: str, path: str) -> None:
    """Orders in many small files: one per status, priority and task."""
    rows = _orders(spark, folder).repartition(8, "o_orderpriority", "o_orderkey")
    rows.write.partitionBy(STATUS).parquet(path)


def compact_small_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "small")
    _small_files(spark, folder, path)
    done = maintain.compact(spark, path, [STATUS])
    again = maintain.compact(spark, path, [STATUS])
    return (
        spark.read.parquet(path)
        .select("o_orderkey", "o_totalprice", "o_orderpriority", STATUS)
        .withColumn("fewer_files", F.lit(done.files_after < done.files_before))
        .withColumn("stable", F.lit(again.files_rewritten == 0))
    )


def orphan_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the files that a failed write has left in a hidden folder of the table."""
    path = scratch_path(spark, "orphans")
    rows = _orders(spark, folder)
    rows.where(f"{STATUS} = 'F'").write.parquet(path)
    attempt = f"{path}/_temporary/0/task_0"
    rows.where(f"{STATUS} <> 'F'").write.parquet(attempt)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=30)
    found = staged(maintain.leftover_files(spark, path, later), "leftovers")
    content = spark.read.parquet(attempt).withColumn("path", decoded_path(F.col("_metadata.file_path")))
    kept = content.join(found.select("path"), "path").select(*rows.columns)
    return kept


def stats(spark: SparkSession, folder: str) -> DataFrame:
    """Record counts of the data files, added up; sizes depend on the writer."""
    path = scratch_path(spark, "stats")
    _small_files(spark, folder, path)
    files = file_stats(spark.read.parquet(path))
    status = F.regexp_extract("file_path", f"{STATUS}=([A-Z])", 1)
    return files.groupBy(status.alias(STATUS), "file_format").agg(
        F.sum("record_count").alias("record_count"),
        F.bool_and(F.col("file_size_in_bytes") > 0).alias("sized"),
    )


def log_effect(spark: SparkSession, folder: str) -> DataFrame:
    """A log made of the orders: per status and priority, orders before and customers after."""
    log = (
        load(spark, folder, "orders")
        .groupBy(F.col(STATUS).alias("table_name"), F.col("o_orderpriority").alias("operation"))
        .agg(
            F.lit("completed").alias("status"),
            F.count("*").alias("files_before"),
            F.count_distinct("o_custkey").alias("files_after"),
            F.count_distinct(F.year("o_orderdate")).cast("bigint").alias("snapshots_before"),
            F.lit(1).cast("bigint").alias("snapshots_after"),
            F.max("o_orderdate").alias("executed_at"),
        )
    )
    return plain(maintain.log_effect(log))


def run(spark: SparkSession, folder: str) -> DataFrame:
    """A maintenance run over a plain table and a change log; operations and what is left."""
    base = scratch_path(spark, "maintained")
    _small_files(spark, folder, f"{base}/orders")
    rows = _orders(spark, folder)
    old = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    versions.commit(rows, f"{base}/history", 1, "insert", old)
    low = rows.where("o_orderpriority = '5-LOW'")
    versions.commit(low, f"{base}/history", 2, versions.DELETE, old + dt.timedelta(days=1))
    tables = [
        Table("orders", f"{base}/orders", (STATUS,)),
        Table("history", f"{base}/history", (versions.BATCH,), "o_orderkey"),
    ]
    records = maintain_all(spark, base, tables, "run-1", old + dt.timedelta(days=30))
    done = spark.createDataFrame(
        [(r["table_name"], r["operation"], r["status"]) for r in records],
        "table_name string, operation string, status string",
    )
    left = [
        spark.read.parquet(t.path).agg(F.lit(t.name).alias("table_name"), F.count("*").alias("rows"))
        for t in tables
    ]
    return done.join(left[0].unionByName(left[1]), "table_name")


def _database(spark: SparkSession, folder: str, base: str) -> str:
    """A database with a plain table in small files, a change log, and a table of its own records."""
    name = f"kept_{uuid.uuid4().hex[:12]}"
    catalog.create_database(spark, name, f"{base}/{name}")
    rows = _orders(spark, folder)
    many = rows.repartition(8, "o_orderpriority", "o_orderkey")
    many.write.partitionBy(STATUS).saveAsTable(f"{name}.orders")
    path = f"{base}/history"
    versions.commit(rows, path, 1, "insert", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    versions.commit(rows.where("o_orderpriority = '5-LOW'"), path, 2, versions.DELETE)
    schema = versions.read_log(spark, path).schema
    catalog.create_table(spark, f"{name}.history", schema, path, [versions.BATCH])
    spark.sql(f"ALTER TABLE {name}.history SET TBLPROPERTIES ('history.key' = 'o_orderkey')")
    spark.sql(f"ALTER TABLE {name}.history RECOVER PARTITIONS")
    rows.select(STATUS).distinct().write.saveAsTable(f"{name}._own")
    return name


def logged(spark: SparkSession, folder: str) -> DataFrame:
    """The stored log of a run that finds its tables in the catalog, and what each table holds then."""
    base = scratch_path(spark, "logged")
    name = _database(spark, folder, base)
    maintain_all(spark, f"{base}/lake", name, "run-1")
    log = metadata.read(spark, f"{base}/lake", metadata.MAINTENANCE_LOG)
    orders = spark.read.parquet(catalog.place(spark, f"{name}.orders"))
    history = versions.as_of(versions.read_log(spark, f"{base}/history"), "o_orderkey")
    left = [
        rows.agg(F.lit(table).alias("table_name"), F.count("*").alias("rows"))
        for table, rows in (("orders", orders), ("history", history))
    ]
    return log.select(
        "table_name", "operation", "status", "run_id",
        (F.col("executed_at").isNotNull() & F.col("files_after").isNotNull()).alias("measured"),
    ).join(left[0].unionByName(left[1]), "table_name")


def catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """User tables of a database with the types of their columns and their rows."""
    name = _database(spark, folder, scratch_path(spark, "catalog"))
    found = None
    for table in catalog.user_tables(spark, name):
        columns = list(catalog.describe(spark, f"{name}.{table}").items())
        listed = spark.createDataFrame(
            [(table, *c) for c in columns], "table_name string, column_name string, data_type string"
        )
        counted = spark.table(f"{name}.{table}").agg(
            F.lit(table).alias("table_name"),
            F.lit(name in catalog.databases(spark)).alias("listed"),
            F.count("*").alias("rows"),
        )
        part = listed.join(counted, "table_name")
        found = part if found is None else found.unionByName(part)
    return found


def fitted_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as details and as error message of a record."""
    return load(spark, folder, "documents").select(
        "doc_id",
        fitted(F.col("text"), DETAILS_LIMIT).alias("details"),
        fitted(F.col("text"), ERROR_LIMIT).alias("error_message"),
    )


QUERIES = {
    "maintenance_logged": logged,
    "catalog_tables": catalog_tables,
    "fitted_texts": fitted_texts,
    "compact_small_files": compact_small_files,
    "orphan_files": orphan_files,
    "file_stats": stats,
    "maintenance_log_effect": log_effect,
    "maintenance_run": run,
}

_ROW = "o_orderkey, o_totalprice, o_orderpriority, o_orderstatus"

_TYPES = """(VALUES ('orders', 'o_orderkey', 'BIGINT'), ('orders', 'o_totalprice', 'DOUBLE'),
  ('orders', 'o_orderpriority', 'STRING'), ('orders', 'o_orderstatus', 'STRING'),
  ('history', 'o_orderkey', 'BIGINT'), ('history', 'o_totalprice', 'DOUBLE'),
  ('history', 'o_orderpriority', 'STRING'), ('history', 'o_orderstatus', 'STRING'),
  ('history', 'op', 'STRING'), ('history', '_ingested_at', 'TIMESTAMP'), ('history', 'batch_id', 'BIGINT'))"""

ORACLES = {
    "maintenance_logged": """WITH n AS (SELECT 'orders' AS table_name, COUNT(*) AS rows FROM orders
UNION ALL SELECT 'history', COUNT(*) FILTER (WHERE o_orderpriority <> '5-LOW') FROM orders)
SELECT table_name, operation, CASE WHEN table_name = 'orders' AND operation = 'expire_snapshots'
  THEN 'skipped' ELSE 'completed' END AS status, 'run-1' AS run_id, TRUE AS measured, rows FROM n
CROSS JOIN (VALUES ('optimize'), ('expire_snapshots'), ('remove_orphan_files')) AS o(operation)""",
    "catalog_tables": f"""WITH n AS (SELECT 'orders' AS table_name, COUNT(*) AS rows FROM orders
UNION ALL SELECT 'history', COUNT(*) + COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') FROM orders)
SELECT table_name, column_name, data_type, TRUE AS listed, rows
FROM {_TYPES} AS t(table_name, column_name, data_type) JOIN n USING (table_name)""",
    "fitted_texts": """SELECT doc_id, left(coalesce(text, ''), 1000) AS details,
  left(coalesce(text, ''), 500) AS error_message FROM documents""",
    "compact_small_files": f"SELECT {_ROW}, TRUE AS fewer_files, TRUE AS stable FROM orders",
    "orphan_files": f"SELECT {_ROW} FROM orders WHERE o_orderstatus <> 'F'",
    "file_stats": """SELECT o_orderstatus, 'PARQUET' AS file_format, COUNT(*) AS record_count,
TRUE AS sized FROM orders GROUP BY o_orderstatus""",
    "maintenance_log_effect": """SELECT o_orderstatus AS table_name, o_orderpriority AS operation,
'completed' AS status, COUNT(*) - COUNT(DISTINCT o_custkey) AS files_removed,
COUNT(DISTINCT year(o_orderdate)) - 1 AS snapshots_removed,
strftime(MAX(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS executed_at
FROM orders GROUP BY ALL""",
    "maintenance_run": """WITH n AS (SELECT 'orders' AS table_name, COUNT(*) AS rows FROM orders
UNION ALL SELECT 'history', COUNT(*) FILTER (WHERE o_orderpriority <> '5-LOW') FROM orders)
SELECT table_name, operation, CASE WHEN table_name = 'orders' AND operation = 'expire_snapshots'
  THEN 'skipped' ELSE 'completed' END AS status, rows FROM n
CROSS JOIN (VALUES ('optimize'), ('expire_snapshots'), ('remove_orphan_files')) AS o(operation)""",
}
