"""Helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..plans.sales import load, sales_view

__all__ = ["SALES_CTE", "load", "monthly_sales", "plain", "sales_view"]

# The sales view in SQL, the same rows as ``sales_view``.
SALES_CTE = """
sales AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
         n_name AS country, CAST(o_orderdate AS DATE) AS ingestion_date,
         o_orderstatus AS status, o_orderpriority AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_FORMATS = {
    "date": "yyyy-MM-dd",
    "timestamp": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestamp_ntz": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that results compare equal between engines."""
    return df.select(
        *[
            F.date_format(c, _FORMATS[t]).alias(c) if t in _FORMATS else F.col(c)
            for c, t in df.dtypes
        ]
    )


def monthly_sales(spark, folder: str) -> DataFrame:
    """Orders as sales rows partitioned by month, with status and priority for building batches."""
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.trunc("o_orderdate", "month").alias("ingestion_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
