"""Streams run to the end of what is there; their tables have to equal the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.replace import SOURCE_BUCKET
from ..session import scratch_path
from ..streaming.ingest import dropped_files, late_rows, stream_ingest, stream_upsert
from ..streaming.rates import all_rates, sliding_rate, write_rates
from .common import load, monthly_sales, plain

BUCKETS = 8


def ingest_available_now(spark: SparkSession, folder: str) -> DataFrame:
    """Orders dropped as CSV in two lots; each run takes what is new."""
    base = scratch_path(spark, "stream")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for lot, rows in enumerate(
        (orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'"))
    ):
        rows.write.option("header", True).csv(f"{base}/drop/lot{lot}")
        stream = dropped_files(spark, f"{base}/drop", orders.schema)
        stream_ingest(stream, f"{base}/table", f"{base}/check", buckets=BUCKETS).awaitTermination()
    table = spark.read.parquet(f"{base}/table").drop(SOURCE_BUCKET, "_ingested_at")
    return table.withColumn("_source_file", F.split_part("_source_file", F.lit("/"), F.lit(1)))


def upsert_foreach_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Final and open orders first, then open ones doubled and pending ones for the first time."""
    base = scratch_path(spark, "stream")
    rows = monthly_sales(spark, folder)
    later = rows.where("status <> 'F'").withColumn("amount", F.col("amount") * 2)
    for lot, part in enumerate((rows.where("status <> 'P'"), later)):
        part.write.parquet(f"{base}/drop/lot{lot}")
        stream = dropped_files(spark, f"{base}/drop", rows.schema, "parquet").drop(
            "_source_file", "_ingested_at"
        )
        stream_upsert(
            stream, f"{base}/table", "order_id", "ingestion_date", f"{base}/check"
        ).awaitTermination()
    return plain(spark.read.parquet(f"{base}/table"))


def late(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in two lots behind a mark, final ones first: what came on time, and what came too late."""
    base = scratch_path(spark, "stream")
    rows = monthly_sales(spark, folder)
    first = F.expr("status = 'F' AND month(ingestion_date) <= 6")
    for lot, part in enumerate((rows.where(first), rows.where(~first))):
        part.write.parquet(f"{base}/drop/lot{lot}")
        stream = dropped_files(spark, f"{base}/drop", rows.schema, "parquet").drop(
            "_source_file", "_ingested_at"
        )
        stream_upsert(
            stream, f"{base}/table", "order_id", "ingestion_date", f"{base}/check",
            state_path=f"{base}/state", late_path=f"{base}/late",
        ).awaitTermination()
    kept = spark.read.parquet(f"{base}/table").select(*rows.columns, F.lit("on time").alias("arrived"))
    rest = late_rows(spark, f"{base}/late", rows.schema)
    return plain(kept.unionByName(rest.select(*rows.columns, F.lit("late").alias("arrived"))))


def _with_time(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _rates_of_a_run(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    schema = load(spark, folder, "events").schema
    events = _with_time(
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )
    rates = sliding_rate(events, ["event_type"], "ts")
    write_rates(rates, f"{base}/rates", f"{base}/check").awaitTermination()
    return all_rates(spark, f"{base}/rates", f"{base}/check", ["event_type"])


def rate_window(spark: SparkSession, folder: str) -> DataFrame:
    """Rates from a stream run to its end: windows it has written, and those it has left open."""
    return plain(_rates_of_a_run(spark, folder).drop("complete"))


def rate_open(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that end after the latest event less the delay: the stream leaves them open."""
    return plain(_rates_of_a_run(spark, folder).where("not complete").drop("complete"))


def rate_window_batch(spark: SparkSession, folder: str) -> DataFrame:
    return plain(sliding_rate(_with_time(load(spark, folder, "events")), ["event_type"], "ts"))


QUERIES = {
    "stream_ingest_available_now": ingest_available_now,
    "stream_upsert_foreach_batch": upsert_foreach_batch,
    "stream_late_rows": late,
    "stream_rate_window": rate_window,
    "stream_rate_open": rate_open,
    "stream_rate_window_batch": rate_window_batch,
}

_RATES = """
WITH slots AS (SELECT event_type, time_bucket(INTERVAL '15 seconds', ts, TIMESTAMP '2000-01-01')
  + INTERVAL '15 seconds' AS slot_end, COUNT(*) AS n FROM events GROUP BY 1, 2),
spread AS (SELECT event_type, slot_end + INTERVAL '15 seconds' * k AS window_end, n
  FROM slots, unnest(range(20)) AS t(k)),
rates AS (SELECT event_type, window_end, CAST(SUM(n) AS BIGINT) AS events FROM spread GROUP BY 1, 2)
SELECT event_type, strftime(window_end, '%Y-%m-%d %H:%M:%S.%f') AS window_end, events,
  events / 300 AS rate FROM rates"""

ORACLES = {
    "stream_ingest_available_now": """
SELECT o_orderkey, o_totalprice, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN 'lot0' ELSE 'lot1' END AS _source_file FROM orders""",
    "stream_upsert_foreach_batch": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS amount,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestion_date,
  o_orderstatus AS status, o_orderpriority AS priority FROM orders""",
    "stream_late_rows": """
WITH dropped AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
  date_trunc('month', o_orderdate) AS due, o_orderstatus AS status, o_orderpriority AS priority,
  o_orderstatus = 'F' AND month(o_orderdate) <= 6 AS first_lot FROM orders)
SELECT order_id, customer_id, amount, strftime(due, '%Y-%m-%d') AS ingestion_date, status, priority,
  CASE WHEN first_lot OR due > (SELECT MAX(due) FROM dropped WHERE first_lot) THEN 'on time'
    ELSE 'late' END AS arrived FROM dropped""",
    "stream_rate_window": _RATES,
    "stream_rate_open": _RATES
    + " WHERE rates.window_end > (SELECT MAX(ts) FROM events) - INTERVAL '1 minute'",
    "stream_rate_window_batch": _RATES,
}
