"""Incremental load, upsert, partition overwrite and the mark."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.contract import SALES_KEYS, SALES_TYPES, contract_violations
from ..operators.partitions import append_rows
from ..operators.upsert import overwrite_by_partition, upsert
from ..operators.watermark import newer_than
from ..plans.incremental import load_sales
from ..session import scratch_path
from .common import SALES_CTE, load, monthly_sales, plain, sales_view

KEY, MONTH = "order_id", "ingestion_date"
MARK = dt.date(1998, 6, 30)


def _first_load(rows: DataFrame, path: str) -> None:
    """Orders that are final or open; the pending ones come later."""
    append_rows(rows.where("status <> 'P'"), path, MONTH)


def _changes(rows: DataFrame) -> DataFrame:
    """Open orders again with twice the amount, and the pending ones for the first time."""
    return rows.where("status <> 'F'").withColumn("amount", F.col("amount") * 2)


def _table(spark: SparkSession, path: str) -> DataFrame:
    return plain(spark.read.parquet(path))


def insert_update(spark: SparkSession, folder: str) -> DataFrame:
    path, rows = scratch_path(spark, "table"), monthly_sales(spark, folder)
    _first_load(rows, path)
    upsert(spark, path, _changes(rows), KEY, MONTH)
    return _table(spark, path)


def idempotent(spark: SparkSession, folder: str) -> DataFrame:
    path, rows = scratch_path(spark, "table"), monthly_sales(spark, folder)
    _first_load(rows, path)
    for _ in range(2):
        upsert(spark, path, _changes(rows), KEY, MONTH)
    return _table(spark, path)


def moves_partition(spark: SparkSession, folder: str) -> DataFrame:
    """All orders of 1996 move ten years ahead, which leaves their old months empty."""
    path, rows = scratch_path(spark, "table"), monthly_sales(spark, folder)
    append_rows(rows, path, MONTH)
    moved = rows.where(F.year(MONTH) == 1996).withColumn(MONTH, F.add_months(MONTH, 120))
    upsert(spark, path, moved, KEY, MONTH)
    return _table(spark, path)


def last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as the source: an order has many lines, the last one by ship date counts."""
    path = scratch_path(spark, "table")
    append_rows(monthly_sales(spark, folder).drop("status", "priority"), path, MONTH)
    lines = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_extendedprice").alias("amount"),
        F.trunc("l_shipdate", "month").alias(MONTH),
        F.col("l_shipdate").alias("_shipped"),
        F.col("l_linenumber").alias("_line"),
    )
    order = [F.col(c) for c in ("_shipped", "_line", "customer_id", "amount")]
    upsert(spark, path, lines, KEY, MONTH, order, drop=["_shipped", "_line"])
    return _table(spark, path)


def overwrite_by_date(spark: SparkSession, folder: str) -> DataFrame:
    """The months of 1997 are replaced by their urgent orders, where there are any."""
    path, rows = scratch_path(spark, "table"), monthly_sales(spark, folder)
    append_rows(rows, path, MONTH)
    urgent = rows.where((F.year(MONTH) == 1997) & (F.col("priority") == "1-URGENT"))
    overwrite_by_partition(urgent, path, MONTH)
    return _table(spark, path)


def incremental_filter(spark: SparkSession, folder: str) -> DataFrame:
    return plain(newer_than(sales_view(spark, folder), "ingestion_date", MARK))


def _csv(rows: DataFrame, path: str) -> str:
    rows.write.option("header", True).csv(path)
    return path


def load_as_table(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of the sales file, the second with later months, read back as a table by its name."""
    rows = sales_view(spark, folder).withColumn(MONTH, F.trunc(MONTH, "month"))
    base = scratch_path(spark, "load")
    table = f"loaded_{uuid.uuid4().hex[:12]}.sales"
    for lot, part in enumerate((rows.where(F.col(MONTH) <= F.lit(MARK)), rows)):
        file = _csv(part, f"{base}/{lot}")
        load_sales(spark, file, f"{base}/sales", f"{base}/state", source_name=f"lot {lot}", table=table)
    loaded = spark.table(table)
    return plain(loaded.select("order_id", "customer_id", "amount", "country", MONTH, "_source_file"))


def watermark_advance(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of the sales file: up to the mark, then the whole file with changed amounts.

    Dates are months, so that the table gets a moderate number of partitions.
    """
    rows = sales_view(spark, folder).withColumn(MONTH, F.trunc(MONTH, "month"))
    base = scratch_path(spark, "load")
    first = _csv(rows.where(F.col(MONTH) <= F.lit(MARK)), f"{base}/first")
    whole = _csv(rows.withColumn("amount", F.col("amount") + 1), f"{base}/whole")
    table, state = f"{base}/sales", f"{base}/state"
    one = load_sales(spark, first, table, state, f"{base}/raw", "sales.csv", strict=True)
    two = load_sales(spark, whole, table, state, f"{base}/raw", "sales.csv")
    three = load_sales(spark, whole, table, state, f"{base}/raw", "sales.csv")
    marks = [str(r.watermark_after) for r in (one, two, three)]
    return plain(
        spark.read.parquet(table)
        .groupBy(MONTH)
        .agg(
            F.count("*").alias("orders"),
            F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("revenue"),
            F.count_distinct("_source_file").alias("sources"),
        )
        .withColumn("marks", F.lit(" ".join(marks)))
        .withColumn("late_rows", F.lit(two.late_rows))
        .withColumn("skipped", F.lit(three.skipped))
    )


def contract_check(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as text, where some prices and dates are no values and some keys are empty."""
    orders = load(spark, folder, "orders")
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" "))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("amount"),
        F.col("o_orderpriority").alias("country"),
        F.when(F.year("o_orderdate") == 1995, F.lit("1995-02-30"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("ingestion_date"),
    )
    return contract_violations(text, SALES_TYPES, SALES_KEYS)


QUERIES = {
    "contract_check": contract_check,
    "incremental_filter": incremental_filter,
    "upsert_insert_update": insert_update,
    "upsert_idempotent": idempotent,
    "upsert_moves_partition": moves_partition,
    "upsert_last_wins": last_wins,
    "overwrite_by_date": overwrite_by_date,
    "watermark_advance": watermark_advance,
    "load_as_table": load_as_table,
}

_MONTH = "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestion_date"
_ROW = "o_orderkey AS order_id, o_custkey AS customer_id"
_TAIL = "o_orderstatus AS status, o_orderpriority AS priority"
_UPSERTED = f"""SELECT {_ROW},
CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS amount,
{_MONTH}, {_TAIL} FROM orders"""

ORACLES = {
    "contract_check": """
SELECT 'order_id' AS column_name, CAST(0 AS BIGINT) AS uncastable, CAST(0 AS BIGINT) AS null_keys
UNION ALL SELECT 'customer_id', 0, (SELECT COUNT(*) FROM orders WHERE o_orderpriority = '5-LOW')
UNION ALL SELECT 'amount', (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P'), 0
UNION ALL SELECT 'country', 0, 0
UNION ALL SELECT 'ingestion_date', (SELECT COUNT(*) FROM orders WHERE year(o_orderdate) = 1995), 0""",
    "incremental_filter": f"""WITH {SALES_CTE}
SELECT order_id, customer_id, amount, country, strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date
FROM sales WHERE sales.ingestion_date > DATE '1998-06-30'""",
    "upsert_insert_update": _UPSERTED,
    "upsert_idempotent": _UPSERTED,
    "upsert_moves_partition": f"""SELECT {_ROW}, o_totalprice AS amount,
strftime(date_trunc('month', CASE WHEN year(o_orderdate) = 1996
  THEN o_orderdate + INTERVAL 10 YEAR ELSE o_orderdate END), '%Y-%m-%d') AS ingestion_date,
{_TAIL} FROM orders""",
    "upsert_last_wins": f"""WITH last AS (
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT COALESCE(l_orderkey, o_orderkey) AS order_id, COALESCE(l_suppkey, o_custkey) AS customer_id,
COALESCE(l_extendedprice, o_totalprice) AS amount,
strftime(date_trunc('month', COALESCE(l_shipdate, o_orderdate)), '%Y-%m-%d') AS ingestion_date
FROM orders FULL JOIN last ON o_orderkey = l_orderkey""",
    "overwrite_by_date": f"""SELECT {_ROW}, o_totalprice AS amount, {_MONTH}, {_TAIL} FROM orders
WHERE o_orderpriority = '1-URGENT' OR date_trunc('month', o_orderdate) NOT IN (
  SELECT date_trunc('month', o_orderdate) FROM orders
  WHERE year(o_orderdate) = 1997 AND o_orderpriority = '1-URGENT')""",
    "load_as_table": f"""WITH {SALES_CTE}, months AS (SELECT CAST(order_id AS VARCHAR) AS order_id,
  CAST(customer_id AS VARCHAR) AS customer_id, amount, country,
  CAST(date_trunc('month', ingestion_date) AS DATE) AS month FROM sales)
SELECT order_id, customer_id, amount, country, strftime(month, '%Y-%m-%d') AS ingestion_date,
  CASE WHEN month <= DATE '{MARK}' THEN 'lot 0' ELSE 'lot 1' END AS _source_file FROM months""",
    "watermark_advance": f"""WITH {SALES_CTE}, months AS (
SELECT date_trunc('month', ingestion_date) AS month, amount FROM sales)
SELECT strftime(month, '%Y-%m-%d') AS ingestion_date, COUNT(*) AS orders,
CAST(SUM(CAST(amount + CASE WHEN month > DATE '1998-06-01' THEN 1 ELSE 0 END AS DECIMAL(18,2)))
  AS DOUBLE) AS revenue,
CAST(1 AS BIGINT) AS sources,
'1998-06-01 ' || (SELECT strftime(MAX(month), '%Y-%m-%d') FROM months) || ' '
  || (SELECT strftime(MAX(month), '%Y-%m-%d') FROM months) AS marks,
(SELECT COUNT(*) FROM months WHERE month <= DATE '1998-06-01') AS late_rows,
TRUE AS skipped
FROM months GROUP BY month""",
}
