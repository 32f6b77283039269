"""Sliding event rates, the same plan for streams and for tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.metrics import STEP_SECONDS, WINDOW_SECONDS


def sliding_rate(
    events: DataFrame,
    series: list[str],
    time: str,
    delay: str = "1 minute",
    window: int = WINDOW_SECONDS,
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Events per second over the trailing window, at every step that has any.

    Events are counted per step first. A sliding window repeats its input once per step, and this
    way it repeats one row per series and step instead of every event.
    """
    slots = (
        events.withWatermark(time, delay)
        .groupBy(*series, F.window(time, f"{step} seconds").alias("_slot"))
        .agg(F.count("*").alias("_n"))
    )
    return _as_rates(_slid(slots, series, window, step), series, window)


def _slid(slots: DataFrame, series: list[str], window: int, step: int) -> DataFrame:
    """Events of every window that holds one of the slots."""
    at = slots.select(*series, "_n", F.window_time("_slot").alias("_at"))
    sliding = F.window("_at", f"{window} seconds", f"{step} seconds").alias("_w")
    return at.groupBy(*series, sliding).agg(F.sum("_n").alias("events"))


def _as_rates(windows: DataFrame, series: list[str], window: int) -> DataFrame:
    return windows.select(
        *series,
        F.col("_w.end").alias("window_end"),
        "events",
        (F.col("events") / F.lit(window)).alias("rate"),
    )


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    series: list[str],
    window: int = WINDOW_SECONDS,
    step: int = STEP_SECONDS,
) -> DataFrame:
    """Windows that a finished run of ``sliding_rate`` has not written yet, with what they hold so far.

    They lie in the state that the run leaves at ``checkpoint``: windows with the slots that are closed,
    and the slots that are still open, which are added to their windows here. A later run of the stream
    writes them once they are complete.
    """
    operators = spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct()
    slots, windows = None, None
    for (operator,) in operators.collect():
        state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
        rows = state.select("key.*", "value.*").toDF(*series, "_w", "events")
        length = F.unix_timestamp("_w.end") - F.unix_timestamp("_w.start")
        part = rows.where(length == window), rows.where(length == step)
        windows = part[0] if windows is None else windows.unionAll(part[0])
        slots = part[1] if slots is None else slots.unionAll(part[1])
    of_slots = _slid(slots.withColumnsRenamed({"_w": "_slot", "events": "_n"}), series, window, step)
    both = windows.unionAll(of_slots.select(windows.columns))
    summed = both.groupBy(*series, "_w").agg(F.sum("events").alias("events"))
    return _as_rates(summed, series, window)


def all_rates(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    series: list[str],
    window: int = WINDOW_SECONDS,
    step: int = STEP_SECONDS,
) -> DataFrame:
    """What a finished run has written to ``path`` and what is still open, told apart by ``complete``."""
    rest = open_windows(spark, checkpoint, series, window, step)
    written = spark.read.schema(rest.schema).parquet(path)
    return written.withColumn("complete", F.lit(True)).unionAll(rest.withColumn("complete", F.lit(False)))


def write_rates(rates: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append each window once it is complete."""
    writer = (
        rates.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    trigger = {"availableNow": True} if once else {"processingTime": f"{STEP_SECONDS} seconds"}
    return writer.trigger(**trigger).start()
