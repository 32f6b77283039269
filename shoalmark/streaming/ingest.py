"""Streaming ingest and upsert of dropped files.

A file is taken up once; a file that changes in place is the business of the batch ingest. Every
micro-batch can be repeated without harm, so a restart from the checkpoint gives each row once.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.replace import BUCKETS, replace_by_source, table_schema
from ..operators.upsert import upsert
from ..operators.watermark import advance_watermark, newer_than, read_watermark
from ..session import held
from ..sources.csvfiles import INGESTED_AT, SOURCE_FILE
from ..sources.listing import decoded_path, relative_key
from ..sources.paths import exists, qualified

log = logging.getLogger(__name__)

LATE_BATCH = "late_batch"
# Fixed value: pause between two looks at the folder.
POLL = "5 minutes"


def dropped_files(
    spark: SparkSession, root: str, schema: T.StructType, file_format: str = "csv", **options
) -> DataFrame:
    """Stream of the rows of files below ``root``, with their audit columns."""
    settings = {"recursiveFileLookup": True, **options}
    if file_format == "csv":
        settings = {"header": True, "escape": '"', "pathGlobFilter": "*.[cC][sS][vV]", **settings}
    rows = spark.readStream.format(file_format).schema(schema).options(**settings).load(root)
    key = relative_key(decoded_path(F.col("_metadata.file_path")), qualified(spark, root))
    return rows.select("*", key.alias(SOURCE_FILE), F.current_timestamp().alias(INGESTED_AT))


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": POLL}
    return writer.trigger(**trigger).start()


def stream_ingest(
    rows: DataFrame, table_path: str, checkpoint: str, once: bool = True, buckets: int = BUCKETS
) -> StreamingQuery:
    """Add the rows of new files. A repeated batch replaces the rows of its own files."""
    schema = table_schema(rows.schema)

    def load(batch: DataFrame, batch_id: int) -> None:
        with held(batch, f"ingest-{batch_id}") as rows:
            files = rows.select(SOURCE_FILE).distinct()
            replace_by_source(batch.sparkSession, table_path, schema, rows, files, buckets)

    return _start(rows.writeStream.foreachBatch(load), checkpoint, once)


def late_rows(spark: SparkSession, late_path: str, schema: T.StructType) -> DataFrame:
    """Rows that ``stream_upsert`` has left out, with the ``mark`` and the ``late_batch`` they met.

    ``schema`` is that of the stream. Without any late row the result is empty.
    """
    mark = T.StructField("mark", T.DateType())
    whole = T.StructType([*schema.fields, mark, T.StructField(LATE_BATCH, T.LongType())])
    if not exists(spark, late_path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(late_path)


def stream_upsert(
    rows: DataFrame,
    table_path: str,
    key: str,
    partition: str,
    checkpoint: str,
    order: list[Column] | None = None,
    state_path: str | None = None,
    pipeline: str = "stream",
    once: bool = True,
    late_path: str | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch. With ``state_path``, rows at or before the mark are left out.

    The mark is the highest partition value of the batches before. Rows left out are counted while the
    batch is written down, and kept in ``late_path`` if it is given, a folder for one checkpoint: each
    batch has its own folder there, written before the mark moves. So a batch that is repeated after
    the mark has moved doesn't put its own rows there. A row without partition value is left out too
    once there is a mark, and kept with the others.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not state_path:
            upsert(spark, table_path, batch, key, partition, order)
            return
        mark = read_watermark(spark, state_path, pipeline)
        is_late = F.lit(False) if mark is None else ~F.coalesce(F.col(partition) > F.lit(mark), F.lit(False))
        seen = Observation(f"batch-{batch_id}")
        counted = batch.observe(
            seen, F.count_if(is_late).alias("late"), F.max(F.when(~is_late, F.col(partition))).alias("last")
        )
        with held(counted, f"upsert-{batch_id}") as arrived:
            late = seen.get["late"]
            if late:
                log.info("batch %d: %d row(s) at or before the mark %s", batch_id, late, mark)
            folder = f"{late_path}/{LATE_BATCH}={batch_id}"
            if late_path and not exists(spark, f"{folder}/_SUCCESS"):
                marked = arrived.where(is_late).withColumn("mark", F.lit(mark).cast("date"))
                marked.write.mode("overwrite").parquet(folder)
            upsert(spark, table_path, newer_than(arrived, partition, mark), key, partition, order)
            advance_watermark(spark, state_path, pipeline, seen.get["last"])

    return _start(rows.writeStream.foreachBatch(load), checkpoint, once)
