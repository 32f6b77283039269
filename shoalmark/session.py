"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .sources.paths import remove


def build_session(app: str = "shoalmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs count on (UTC, adaptive execution).

    Keyword arguments use ``__`` for the dots of a Spark setting. The number of shuffle
    partitions is left to the cluster: adaptive execution merges small ones and splits hot ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name for intermediate tables.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Only a local master
    may go without that setting; it then gets a temporary folder, kept in the session for reuse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="shoalmark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage with a table that outlives lost executors, and gives the optimizer the true
    size, so that a join is broadcast only when the data is known to be small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``staged`` for as long as a job needs it; the scratch table is removed afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
