"""Change log: reads as of a version, history, expiry, rollback."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import versions
from ..session import scratch_path
from .common import load, plain

KEY = "o_orderkey"
DAYS = [dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 5, 9)]


def _log(spark: SparkSession, folder: str) -> str:
    """Three versions: final and open orders; open ones doubled and pending ones added; low
    priority ones deleted."""
    path = scratch_path(spark, "log")
    orders = load(spark, folder, "orders").select(KEY, "o_totalprice", "o_orderstatus", "o_orderpriority")
    versions.commit(orders.where("o_orderstatus <> 'P'"), path, 1, "insert", DAYS[0])
    changed = orders.where("o_orderstatus <> 'F'").withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    op = F.when(F.col("o_orderstatus") == "P", "insert").otherwise("update")
    versions.commit(changed, path, 2, op, DAYS[1])
    low = orders.where("o_orderpriority = '5-LOW'").withColumn(
        "o_totalprice", F.lit(None).cast("double")
    )
    versions.commit(low, path, 3, versions.DELETE, DAYS[2])
    return path


def _state(spark: SparkSession, path: str, **at) -> DataFrame:
    state = versions.as_of(versions.read_log(spark, path), KEY, **at)
    return state.select(KEY, "o_totalprice", "o_orderstatus", "o_orderpriority")


def asof_version(spark: SparkSession, folder: str) -> DataFrame:
    return _state(spark, _log(spark, folder), version=2)


def asof_base(spark: SparkSession, folder: str) -> DataFrame:
    """The fifth of six versions, two priorities repriced and two deleted, with a base at every second."""
    path = scratch_path(spark, "log")
    orders = load(spark, folder, "orders").select(KEY, "o_totalprice", "o_orderstatus", "o_orderpriority")
    steps = [(None, 1), ("1-URGENT", 2), ("2-HIGH", 3), ("3-MEDIUM", None), ("1-URGENT", 5), ("5-LOW", None)]
    for version, (priority, factor) in enumerate(steps, 1):
        rows = orders.where(F.lit(True) if priority is None else F.col("o_orderpriority") == priority)
        op = versions.DELETE if factor is None else "insert" if priority is None else "update"
        price = (F.col("o_totalprice") * F.lit(factor)).cast("double")
        versions.commit(rows.withColumn("o_totalprice", price), path, version, op)
        versions.keep_bases(spark, path, KEY, 2)
    state = versions.as_of_version(spark, path, KEY, 5)
    return state.select(KEY, "o_totalprice", "o_orderstatus", "o_orderpriority", "batch_id")


def asof_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return _state(spark, _log(spark, folder), timestamp=DAYS[2] + dt.timedelta(hours=1))


def counts(spark: SparkSession, folder: str) -> DataFrame:
    log = versions.read_log(spark, _log(spark, folder))
    return versions.compare_counts(log, KEY, {"first": 1, "previous": 2, "current": None})


def history(spark: SparkSession, folder: str) -> DataFrame:
    return plain(versions.batches(versions.read_log(spark, _log(spark, folder))))


def expire(spark: SparkSession, folder: str) -> DataFrame:
    """Everything before the third version is reduced to the state at that time."""
    path = _log(spark, folder)
    versions.expire(spark, path, KEY, DAYS[1] + dt.timedelta(days=1))
    return versions.read_log(spark, path).select(KEY, "o_totalprice", "op", "batch_id")


def rollback(spark: SparkSession, folder: str) -> DataFrame:
    path = _log(spark, folder)
    versions.rollback(spark, path, KEY, 1, 4)
    return _state(spark, path)


QUERIES = {
    "asof_version": asof_version,
    "asof_timestamp": asof_timestamp,
    "asof_base": asof_base,
    "version_counts_union": counts,
    "version_history": history,
    "expire_versions": expire,
    "rollback_version": rollback,
}

_COLUMNS = "o_orderkey, {price} AS o_totalprice, o_orderstatus, o_orderpriority"
_DOUBLED = "CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END"

ORACLES = {
    "asof_version": f"SELECT {_COLUMNS.format(price=_DOUBLED)} FROM orders",
    "asof_timestamp": f"SELECT {_COLUMNS.format(price=_DOUBLED)} FROM orders "
    "WHERE o_orderpriority <> '5-LOW'",
    "asof_base": """
SELECT o_orderkey, o_totalprice * CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 3
    ELSE 1 END AS o_totalprice, o_orderstatus, o_orderpriority,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 3 ELSE 1 END AS BIGINT) AS batch_id
FROM orders WHERE o_orderpriority <> '3-MEDIUM'""",
    "version_counts_union": """
SELECT 'first' AS version, COUNT(*) AS rows FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'previous', COUNT(*) FROM orders
UNION ALL SELECT 'current', COUNT(*) FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "version_history": """
SELECT CAST(1 AS BIGINT) AS batch_id, '2024-01-01 00:00:00.000000' AS committed_at,
  COUNT(*) FILTER (WHERE o_orderstatus <> 'P') AS inserted, CAST(0 AS BIGINT) AS updated,
  CAST(0 AS BIGINT) AS deleted, CAST(NULL AS BIGINT) AS parent_id FROM orders
UNION ALL SELECT 2, '2024-01-05 00:00:00.000000', COUNT(*) FILTER (WHERE o_orderstatus = 'P'),
  COUNT(*) FILTER (WHERE o_orderstatus = 'O'), 0, 1 FROM orders
UNION ALL SELECT 3, '2024-01-09 00:00:00.000000', 0, 0,
  COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW'), 2 FROM orders""",
    "expire_versions": f"""
SELECT o_orderkey, {_DOUBLED} AS o_totalprice,
  CASE WHEN o_orderstatus = 'O' THEN 'update' ELSE 'insert' END AS op,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS BIGINT) AS batch_id FROM orders
UNION ALL SELECT o_orderkey, NULL, 'delete', 3 FROM orders WHERE o_orderpriority = '5-LOW'""",
    "rollback_version": f"SELECT {_COLUMNS.format(price='o_totalprice')} FROM orders "
    "WHERE o_orderstatus <> 'P'",
}
