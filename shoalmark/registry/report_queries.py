"""Charts and business queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import money_label, percent_label
from ..operators.partitions import append_rows
from ..plans import reports
from ..plans.sales import between_dates
from ..session import scratch_path
from ..sources.filemeta import partition_stats
from .common import SALES_CTE, load, monthly_sales, plain, sales_view

MONEY = "CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"


def _chart(build):
    return lambda spark, folder: plain(build(sales_view(spark, folder)))


def _sql(body: str) -> str:
    return f"WITH {SALES_CTE} {body}"


def _by_source(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as if each priority and year had come in a file of its own."""
    orders = load(spark, folder, "orders")
    return orders.select(
        F.concat_ws("/", "o_orderpriority", F.year("o_orderdate")).alias("_source_file"),
        F.col("o_orderdate").alias("_ingested_at"),
    )


_SOURCES_CTE = """
files AS (
  SELECT o_orderpriority || '/' || CAST(year(o_orderdate) AS VARCHAR) AS _source_file,
         o_orderdate AS _ingested_at
  FROM orders
)"""


def partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "partitions")
    append_rows(monthly_sales(spark, folder), path, "ingestion_date")
    found = partition_stats(spark.read.parquet(path), "ingestion_date")
    return plain(
        found.select(
            "ingestion_date",
            "record_count",
            ((F.col("file_count") > 0) & (F.col("total_size") > 0)).alias("has_files"),
        )
    )


def filtered(spark: SparkSession, folder: str) -> DataFrame:
    some = between_dates(
        sales_view(spark, folder),
        dt.date(1996, 1, 1),
        dt.date(1998, 12, 31),
        ["NATION_1", "NATION_2", "NATION_3", "NATION_20"],
    )
    return reports.country_summary(some)


def parameterised(spark: SparkSession, folder: str) -> DataFrame:
    text = (
        "SELECT country, count(*) AS orders FROM {sales} "
        "WHERE ingestion_date >= :since AND amount > :least GROUP BY country"
    )
    args = {"since": dt.date(1997, 6, 1), "least": 250000.0}
    return reports.parameterised(sales_view(spark, folder), text, args)


def labels(spark: SparkSession, folder: str) -> DataFrame:
    shares = reports.orders_by_country_share(sales_view(spark, folder))
    return shares.select(
        "country",
        F.concat(F.col("country"), F.lit(": "), percent_label(F.col("share_percent"))).alias("label"),
        money_label(F.col("order_count").cast("double")).alias("as_money"),
    )


QUERIES = {
    "chart_total_revenue": _chart(reports.total_revenue),
    "chart_total_orders": _chart(reports.total_orders),
    "chart_avg_order_value": _chart(reports.avg_order_value),
    "chart_revenue_by_country": _chart(reports.revenue_by_country),
    "chart_orders_by_country_share": _chart(reports.orders_by_country_share),
    "chart_daily_revenue": _chart(reports.daily_revenue),
    "chart_daily_orders": _chart(reports.daily_orders),
    "chart_top10_customers": _chart(reports.top_customers),
    "chart_labels": labels,
    "sql_revenue_by_country_avg": _chart(reports.country_summary),
    "sql_top_customers_20": _chart(lambda s: reports.top_customers(s, reports.TOP_QUERY)),
    "sql_top_customers_5": _chart(lambda s: reports.top_customers(s, 5)),
    "sql_revenue_by_day_country": _chart(reports.revenue_by_day_country),
    "sql_revenue_by_month": _chart(reports.revenue_by_month),
    "sql_daily_trend": _chart(reports.daily_trend),
    "sql_date_range": _chart(reports.date_range),
    "sql_preview": _chart(reports.preview),
    "sql_latest_orders": _chart(reports.latest_orders),
    "sql_freshness": lambda s, d: plain(reports.freshness(_by_source(s, d))),
    "sql_rows_by_source": lambda s, d: reports.rows_by_source(_by_source(s, d)),
    "sql_percentiles_by_country": _chart(reports.percentiles_by_country),
    "sql_partition_counts": partition_counts,
    "sql_filtered_range_country": filtered,
    "sql_parameterised": parameterised,
}

_TOP = f"""SELECT customer_id, {MONEY} AS total_revenue, COUNT(*) AS order_count
FROM sales GROUP BY customer_id ORDER BY total_revenue DESC, customer_id LIMIT """
_DAY = "strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date"
_SUMMARY = f"""SELECT country, COUNT(*) AS order_count, {MONEY} AS total_revenue,
{MONEY} / COUNT(*) AS avg_order_value FROM sales"""
_ROW = f"order_id, customer_id, amount, country, {_DAY}"
_SHARE = """SELECT country, COUNT(*) AS order_count,
CAST(COUNT(*) AS DOUBLE) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM sales) * 100 AS share_percent
FROM sales GROUP BY country"""

ORACLES = {
    "chart_total_revenue": _sql(f"SELECT {MONEY} AS total_revenue FROM sales"),
    "chart_total_orders": _sql("SELECT COUNT(*) AS total_orders FROM sales"),
    "chart_avg_order_value": _sql(f"SELECT {MONEY} / COUNT(amount) AS avg_order_value FROM sales"),
    "chart_revenue_by_country": _sql(
        f"SELECT country, {MONEY} AS revenue FROM sales GROUP BY country"
    ),
    "chart_orders_by_country_share": _sql(_SHARE),
    "chart_daily_revenue": _sql(
        f"SELECT {_DAY}, {MONEY} AS daily_revenue FROM sales GROUP BY sales.ingestion_date"
    ),
    "chart_daily_orders": _sql(
        f"SELECT {_DAY}, COUNT(*) AS daily_orders FROM sales GROUP BY sales.ingestion_date"
    ),
    "chart_top10_customers": _sql(_TOP + "10"),
    "chart_labels": _sql(
        "SELECT country, country || ': ' || printf('%.2f', share_percent) || '%' AS label, "
        f"'$' || printf('%,.2f', CAST(order_count AS DOUBLE)) AS as_money FROM ({_SHARE})"
    ),
    "sql_revenue_by_country_avg": _sql(f"{_SUMMARY} GROUP BY country"),
    "sql_top_customers_20": _sql(_TOP + "20"),
    "sql_top_customers_5": _sql(_TOP + "5"),
    "sql_revenue_by_day_country": _sql(
        f"SELECT {_DAY}, country, {MONEY} AS revenue FROM sales "
        "GROUP BY sales.ingestion_date, country"
    ),
    "sql_revenue_by_month": _sql(
        f"SELECT strftime(date_trunc('month', ingestion_date), '%Y-%m-%d') AS month, "
        f"{MONEY} AS revenue, COUNT(*) AS orders FROM sales GROUP BY 1"
    ),
    "sql_daily_trend": _sql(
        f"SELECT {_DAY}, COUNT(*) AS orders, {MONEY} AS daily_revenue FROM sales "
        "GROUP BY sales.ingestion_date"
    ),
    "sql_date_range": _sql(
        "SELECT strftime(MIN(ingestion_date), '%Y-%m-%d') AS first_date, "
        "strftime(MAX(ingestion_date), '%Y-%m-%d') AS last_date FROM sales"
    ),
    "sql_preview": _sql(f"SELECT {_ROW} FROM sales ORDER BY order_id LIMIT 10"),
    "sql_latest_orders": _sql(
        f"SELECT {_ROW} FROM sales ORDER BY sales.ingestion_date DESC, order_id LIMIT 20"
    ),
    "sql_freshness": f"""WITH {_SOURCES_CTE}
SELECT strftime(MAX(_ingested_at), '%Y-%m-%d %H:%M:%S.%f') AS latest_ingestion,
       COUNT(DISTINCT _source_file) AS source_files FROM files""",
    "sql_rows_by_source": f"""WITH {_SOURCES_CTE}
SELECT _source_file, COUNT(*) AS row_count FROM files GROUP BY _source_file""",
    "sql_percentiles_by_country": _sql(
        "SELECT country, quantile_disc(amount, 0.50) AS p50, quantile_disc(amount, 0.95) AS p95 "
        "FROM sales GROUP BY country"
    ),
    "sql_partition_counts": """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestion_date,
       COUNT(*) AS record_count, TRUE AS has_files
FROM orders GROUP BY 1""",
    "sql_filtered_range_country": _sql(
        f"{_SUMMARY} WHERE ingestion_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' "
        "AND country IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_20') GROUP BY country"
    ),
    "sql_parameterised": _sql(
        "SELECT country, COUNT(*) AS orders FROM sales "
        "WHERE ingestion_date >= DATE '1997-06-01' AND amount > 250000.0 GROUP BY country"
    ),
}
