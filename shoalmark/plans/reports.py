"""Dashboard charts and documented business queries over the sales table.

Amounts are stored as doubles and added up as decimals, so that a sum does not depend on the order
in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import percent
from ..operators.percentiles import approx_percentiles, exact_percentiles

MONEY = "decimal(18,2)"

# Rows of the customer rankings.
TOP_CHART, TOP_QUERY = 10, 20


def money_sum(c: str = "amount") -> Column:
    return F.sum(F.col(c).cast(MONEY)).cast("double")


def money_avg(c: str = "amount") -> Column:
    return money_sum(c) / F.count(c)


def total_revenue(sales: DataFrame) -> DataFrame:
    return sales.agg(money_sum().alias("total_revenue"))


def total_orders(sales: DataFrame) -> DataFrame:
    return sales.agg(F.count("*").alias("total_orders"))


def avg_order_value(sales: DataFrame) -> DataFrame:
    n = F.count("amount")
    return sales.agg(F.when(n > 0, money_sum() / n).alias("avg_order_value"))


def revenue_by_country(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("country")
        .agg(money_sum().alias("revenue"))
        .orderBy(F.desc("revenue"), "country")
    )


def orders_by_country_share(sales: DataFrame) -> DataFrame:
    """Order count per country with its share of all orders in percent."""
    counted = sales.groupBy("country").agg(F.count("*").alias("order_count"))
    total = counted.agg(F.sum("order_count")).scalar()
    return counted.withColumn("share_percent", percent(F.col("order_count"), total)).orderBy(
        F.desc("order_count"), "country"
    )


def daily_revenue(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("ingestion_date")
        .agg(money_sum().alias("daily_revenue"))
        .orderBy("ingestion_date")
    )


def daily_orders(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("ingestion_date")
        .agg(F.count("*").alias("daily_orders"))
        .orderBy("ingestion_date")
    )


def top_customers(sales: DataFrame, n: int = TOP_CHART) -> DataFrame:
    """Customers by spend; equal spend is ordered by customer, so the cut is always the same."""
    return (
        sales.groupBy("customer_id")
        .agg(money_sum().alias("total_revenue"), F.count("*").alias("order_count"))
        .orderBy(F.desc("total_revenue"), "customer_id")
        .limit(n)
    )


def country_summary(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("country")
        .agg(
            F.count("*").alias("order_count"),
            money_sum().alias("total_revenue"),
            money_avg().alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )


def revenue_by_day_country(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("ingestion_date", "country")
        .agg(money_sum().alias("revenue"))
        .orderBy("ingestion_date", "country")
    )


def revenue_by_month(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(F.trunc("ingestion_date", "month").alias("month"))
        .agg(money_sum().alias("revenue"), F.count("*").alias("orders"))
        .orderBy("month")
    )


def daily_trend(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("ingestion_date")
        .agg(F.count("*").alias("orders"), money_sum().alias("daily_revenue"))
        .orderBy("ingestion_date")
    )


def freshness(table: DataFrame) -> DataFrame:
    """Latest load time and number of source files.

    Sources are grouped first: one row per source is left to be counted, however large a source.
    """
    per_source = table.groupBy("_source_file").agg(F.max("_ingested_at").alias("latest"))
    return per_source.agg(
        F.max("latest").alias("latest_ingestion"), F.count("_source_file").alias("source_files")
    )


def rows_by_source(table: DataFrame) -> DataFrame:
    return table.groupBy("_source_file").agg(F.count("*").alias("row_count")).orderBy("_source_file")


def percentiles_by_country(sales: DataFrame, exact: bool = True) -> DataFrame:
    """Median and 95th percentile of the amount, exact or from a sketch."""
    points = {"p50": 0.50, "p95": 0.95}
    compute = exact_percentiles if exact else approx_percentiles
    return compute(sales, ["country"], F.col("amount"), points).orderBy("country")


def preview(sales: DataFrame, n: int = 10) -> DataFrame:
    return sales.orderBy("order_id").limit(n)


def latest_orders(sales: DataFrame, n: int = 20) -> DataFrame:
    return sales.orderBy(F.desc("ingestion_date"), "order_id").limit(n)


def date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.min("ingestion_date").alias("first_date"), F.max("ingestion_date").alias("last_date")
    )


def parameterised(sales: DataFrame, text: str, args: dict) -> DataFrame:
    """SQL over the view ``sales`` with named parameters."""
    return sales.sparkSession.sql(text, args=args, sales=sales)
