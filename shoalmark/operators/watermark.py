"""High-water mark of an incremental load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.paths import exists

STATE_SCHEMA = "pipeline string, watermark date, updated_at timestamp"


def read_watermark(spark: SparkSession, path: str, pipeline: str) -> dt.date | None:
    """The mark, or None before the first load. Marks are appended, so the highest one counts."""
    if not exists(spark, path):
        return None
    marks = spark.read.schema(STATE_SCHEMA).parquet(path).where(F.col("pipeline") == pipeline)
    return marks.agg(F.max("watermark")).first()[0]


def advance_watermark(
    spark: SparkSession, path: str, pipeline: str, new: dt.date | None
) -> dt.date | None:
    """Store ``new`` if it is higher than the present mark; the mark never moves back."""
    old = read_watermark(spark, path, pipeline)
    if new is None or (old is not None and new <= old):
        return old
    row = spark.createDataFrame([(pipeline, new, dt.datetime.now(dt.timezone.utc))], STATE_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)
    return new


def newer_than(rows: DataFrame, column: str, mark: dt.date | None) -> DataFrame:
    """Rows strictly after the mark; all rows when there is none."""
    return rows if mark is None else rows.where(F.col(column) > F.lit(mark))
