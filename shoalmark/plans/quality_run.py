"""A quality run: checks, stored results, then the gate."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators import metadata
from ..operators.quality import Check, gate, run_suite


def run_and_store(
    spark: SparkSession,
    lake: str,
    checks: list[Check],
    tables: Mapping[str, DataFrame],
    run_id: str,
) -> list[dict[str, Any]]:
    """Run the checks and append their results."""
    results = run_suite(spark, checks, tables)
    at = metadata.now()
    rows = [{**r, "run_id": run_id, "executed_at": at} for r in results]
    metadata.append(spark, lake, metadata.QUALITY_RESULTS, rows)
    return results


def run_gate(
    spark: SparkSession,
    lake: str,
    checks: list[Check],
    tables: Mapping[str, DataFrame],
    run_id: str,
) -> int:
    """The results are stored before the gate decides, so a failing run leaves its record."""
    return gate(run_and_store(spark, lake, checks, tables, run_id))
