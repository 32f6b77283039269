"""The sales table: its schema and the view over order tables that stands in for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

KEY, DAY = "order_id", "ingestion_date"

# Columns as they come in the source file.
SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("country", T.StringType()),
        T.StructField("ingestion_date", T.DateType()),
    ]
)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales_view(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the nation of their customer, under the column names of the sales table.

    Customer and nation are joined first, so the orders are shuffled once; whether the small sides
    are broadcast is left to their measured size.
    """
    nation = load(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = (
        load(spark, folder, "customer")
        .select("c_custkey", "c_nationkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("country"))
    )
    return (
        load(spark, folder, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("amount"),
            "country",
            F.to_date("o_orderdate").alias("ingestion_date"),
        )
    )


def between_dates(
    sales: DataFrame, start=None, end=None, countries: list[str] | None = None
) -> DataFrame:
    """The filters every report takes: an inclusive date range and a list of countries."""
    if start is not None:
        sales = sales.where(F.col(DAY) >= F.lit(start).cast("date"))
    if end is not None:
        sales = sales.where(F.col(DAY) <= F.lit(end).cast("date"))
    if countries is not None:
        sales = sales.where(F.col("country").isin(*countries))
    return sales
