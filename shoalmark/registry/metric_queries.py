"""Monitoring operators over the events table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import or_zero
from ..operators import metrics
from ..operators.percentiles import exact_percentiles
from ..session import scratch_path
from .common import load, plain

SERIES = ["event_type"]
NOW = dt.datetime(2024, 1, 28, 12, 0, 0)


def _counter(spark: SparkSession, folder: str) -> DataFrame:
    """The event value read as a counter that starts again whenever it drops."""
    return (
        load(spark, folder, "events")
        .groupBy("event_type", "ts")
        .agg(F.max(F.col("value").cast("decimal(18,2)")).alias("value"))
    )


def increase(spark: SparkSession, folder: str) -> DataFrame:
    grown = metrics.counter_increase(_counter(spark, folder), SERIES, "ts", "value")
    return plain(
        grown.select(
            "event_type",
            "ts",
            F.col("value").cast("double").alias("value"),
            F.col("increase").cast("double").alias("increase"),
        )
    )


def rate(spark: SparkSession, folder: str) -> DataFrame:
    rated = metrics.counter_rate(_counter(spark, folder), SERIES, "ts", "value")
    return plain(rated.select("event_type", "ts", "rate"))


def increase_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a window of six hours, so that windows hold many samples."""
    grown = metrics.counter_increase(
        _counter(spark, folder), SERIES, "ts", "value", window=21600, chunk=86400
    )
    return plain(
        grown.select("event_type", "ts", F.col("increase").cast("double").alias("increase"))
    )


def sum_by_label(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.sum_by_label(
        load(spark, folder, "events"),
        F.date_trunc("hour", "ts"),
        "event_type",
        F.col("value").cast("decimal(18,2)"),
    )
    return plain(found.withColumn("total", F.col("total").cast("double")))


def series_up(spark: SparkSession, folder: str) -> DataFrame:
    """A user counts as up unless their latest event is an error."""
    samples = load(spark, folder, "events").select(
        "user_id", "ts", F.when(F.col("event_type") == "error", 0).otherwise(1).alias("up")
    )
    return metrics.count_in_state(samples, ["user_id"], "ts", "up")


def total_or_zero(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of a label that occurs and of one that does not."""
    events = load(spark, folder, "events")
    value = F.col("value").cast("decimal(18,2)")
    totals = [
        metrics.total_or_zero(events.where(F.col("event_type") == label), value).select(
            F.lit(label).alias("event_type"), or_zero(F.col("total")).cast("double").alias("total")
        )
        for label in ("error", "timeout")
    ]
    return totals[0].unionByName(totals[1])


HOLD, GAP, LIMIT = 3600, 7200, 60


def alert_hold(spark: SparkSession, folder: str) -> DataFrame:
    """Values below the limit for an hour at least, gaps of up to two hours allowed."""
    return plain(
        metrics.held_alerts(
            load(spark, folder, "events"), SERIES, "ts", F.col("value") < LIMIT, HOLD, GAP
        )
    )


def alert_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Counters that kept growing: rate above zero, held for five minutes."""
    rated = metrics.counter_rate(_counter(spark, folder), SERIES, "ts", "value")
    return plain(
        metrics.held_alerts(rated, SERIES, "ts", F.col("rate") > 0, metrics.HOLD_SECONDS, 1800)
    )


def alert_down(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose events are all errors for at least a minute."""
    return plain(
        metrics.held_alerts(
            load(spark, folder, "events"),
            ["user_id"],
            "ts",
            F.col("event_type") == "error",
            metrics.SHORT_HOLD_SECONDS,
            172800,
            chunk=604800,
        )
    )


def _hours(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return events.select(
        F.floor(F.col("user_id") / 10).alias("shard"),
        F.date_trunc("hour", "ts").alias("at"),
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


def alert_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Share of purchases and sign-ups in the value of all events, per group of users and hour."""
    hours = _hours(spark, folder)
    whole = hours.groupBy("shard", "at").agg(F.sum("value").alias("value"))
    part = (
        hours.where(F.col("event_type").isin("purchase", "signup"))
        .groupBy("shard", "at")
        .agg(F.sum("value").alias("value"))
    )
    return plain(metrics.gauge_ratio(part, whole, ["shard"], "at"))


def percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return exact_percentiles(
        load(spark, folder, "events"), SERIES, F.col("value"), {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )


def retention(spark: SparkSession, folder: str) -> DataFrame:
    """Samples of the last week, from a table partitioned by day."""
    path = scratch_path(spark, "samples")
    events = load(spark, folder, "events").withColumn("day", F.to_date("ts"))
    events.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    metrics.retain(spark, path, "ts", "day", NOW)
    return plain(spark.read.parquet(path).select("event_id", "ts", "value", "day"))


def threshold_status(spark: SparkSession, folder: str) -> DataFrame:
    """Colour of the number of event types that each user had on a day."""
    return plain(
        load(spark, folder, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.count_distinct("event_type").alias("kinds"))
        .withColumn("status", metrics.threshold_status(F.col("kinds")))
    )


QUERIES = {
    "metric_increase_5m": increase,
    "metric_rate_5m": rate,
    "metric_increase_6h": increase_hourly,
    "metric_sum_by_label": sum_by_label,
    "metric_series_up": series_up,
    "metric_total_or_zero": total_or_zero,
    "alert_hold": alert_hold,
    "alert_rate_positive": alert_rate,
    "alert_down": alert_down,
    "alert_ratio": alert_ratio,
    "metric_percentiles": percentiles,
    "metric_retention": retention,
    "metric_threshold_status": threshold_status,
}

_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"


def _counter_sql(window: str) -> str:
    return f"""WITH counter AS (
SELECT event_type, ts, MAX(CAST(value AS DECIMAL(18,2))) AS value FROM events GROUP BY event_type, ts),
grown AS (SELECT *, lag(value) OVER w AS last FROM counter
  WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
growth AS (SELECT event_type, ts, value, CASE WHEN last IS NULL THEN NULL
  WHEN value >= last THEN value - last ELSE value END AS g FROM grown),
rolled AS (SELECT event_type, ts, value, CAST(COALESCE(SUM(g) OVER (PARTITION BY event_type
  ORDER BY ts RANGE BETWEEN INTERVAL '{window}' PRECEDING AND CURRENT ROW), 0) AS DOUBLE) AS increase
  FROM growth)"""


def _alert_sql(samples: str, series: str, hold: int, gap: int, ctes: str = "WITH") -> str:
    """Runs of active samples, formed over whole series."""
    stamp = "strftime({} , '%Y-%m-%d %H:%M:%S.%f') AS {}"
    return f"""{ctes} samples AS ({samples}),
flagged AS (SELECT *, lag(active) OVER w AS was, lag(ts) OVER w AS before FROM samples
  WINDOW w AS (PARTITION BY {series} ORDER BY ts)),
numbered AS (SELECT *, SUM(CASE WHEN active AND was AND ts - before <= INTERVAL '{gap} seconds'
  THEN 0 ELSE 1 END) OVER (PARTITION BY {series} ORDER BY ts) AS run FROM flagged),
runs AS (SELECT {series}, MIN(ts) AS a, MAX(ts) AS b FROM numbered WHERE active
  GROUP BY {series}, run)
SELECT {series}, {stamp.format('a', 'active_from')},
  {stamp.format(f"a + INTERVAL '{hold} seconds'", 'firing_from')},
  {stamp.format('b', 'firing_to')}
FROM runs WHERE b - a >= INTERVAL '{hold} seconds'"""


_FIVE = _counter_sql("299.999999 seconds")

ORACLES = {
    "metric_increase_5m": f"""{_FIVE}
SELECT event_type, {_TS}, CAST(value AS DOUBLE) AS value, increase FROM rolled""",
    "metric_rate_5m": f"{_FIVE} SELECT event_type, {_TS}, increase / 300 AS rate FROM rolled",
    "metric_increase_6h": f"""{_counter_sql("21599.999999 seconds")}
SELECT event_type, {_TS}, increase FROM rolled""",
    "metric_sum_by_label": """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS bucket, event_type,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""",
    "metric_series_up": """
WITH latest AS (SELECT user_id, arg_max(event_type, ts) AS kind FROM events GROUP BY user_id)
SELECT COUNT(*) FILTER (WHERE kind <> 'error') AS series_in_state, COUNT(*) AS series FROM latest""",
    "metric_total_or_zero": """
SELECT 'error' AS event_type, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events WHERE event_type = 'error' UNION ALL SELECT 'timeout', CAST(0 AS DOUBLE)""",
    "alert_hold": _alert_sql(
        f"SELECT event_type, ts, value < {LIMIT} AS active FROM events", "event_type", HOLD, GAP
    ),
    "alert_rate_positive": _alert_sql(
        "SELECT event_type, ts, increase > 0 AS active FROM rolled",
        "event_type",
        300,
        1800,
        f"{_FIVE},",
    ),
    "alert_down": _alert_sql(
        "SELECT user_id, ts, event_type = 'error' AS active FROM events", "user_id", 60, 172800
    ),
    "alert_ratio": """
WITH hours AS (SELECT CAST(floor(user_id / 10) AS BIGINT) AS shard, date_trunc('hour', ts) AS h,
  event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events),
sums AS (SELECT shard, h, SUM(value) AS whole,
  SUM(value) FILTER (WHERE event_type IN ('purchase', 'signup')) AS part FROM hours GROUP BY shard, h),
shares AS (SELECT shard, h, CAST(part AS DOUBLE) / CAST(whole AS DOUBLE) * 100 AS p
  FROM sums WHERE part IS NOT NULL)
SELECT shard, strftime(h, '%Y-%m-%d %H:%M:%S.%f') AS "at", p AS percent, p > 80 AS above FROM shares""",
    "metric_percentiles": """
SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95,
  quantile_disc(value, 0.99) AS p99 FROM events GROUP BY event_type""",
    "metric_retention": f"""
SELECT event_id, {_TS}, value, strftime(events.ts, '%Y-%m-%d') AS day FROM events
WHERE events.ts >= TIMESTAMP '2024-01-21 12:00:00'""",
    "metric_threshold_status": """
WITH k AS (SELECT user_id, CAST(ts AS DATE) AS d, COUNT(DISTINCT event_type) AS kinds
  FROM events GROUP BY 1, 2)
SELECT user_id, strftime(d, '%Y-%m-%d') AS day, kinds, CASE WHEN kinds >= 5 THEN 'green'
  WHEN kinds >= 3 THEN 'yellow' ELSE 'red' END AS status FROM k""",
}
