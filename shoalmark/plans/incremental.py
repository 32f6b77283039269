"""Incremental load of the sales file: contract, raw copy, mark filter, upsert, new mark."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.contract import SALES_COLUMNS, SALES_KEYS, SALES_TYPES, contract_violations
from ..operators.upsert import upsert
from ..operators.watermark import advance_watermark, newer_than, read_watermark
from ..session import held
from ..sources import catalog
from ..sources.csvfiles import CsvSource, check_columns, contract_rows, with_audit
from ..sources.paths import exists
from .sales import DAY, KEY, SOURCE_SCHEMA

PIPELINE = "sales_pipeline"


class ContractViolation(ValueError):
    """Cells that do not fit their column type, or rows without a key."""


@dataclass(frozen=True)
class LoadResult:
    rows_in: int
    rows_merged: int
    late_rows: int
    watermark_before: dt.date | None
    watermark_after: dt.date | None
    skipped: bool
    undated_rows: int = 0


def land_raw(source: CsvSource, raw_path: str) -> None:
    """Copy the source records as text, replacing an earlier copy; every part has the header."""
    rows = source.text()
    # The writer would strip blanks around cells otherwise.
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.mode("overwrite").options(header=True, escape='"', emptyValue="", **blanks).csv(raw_path)


def require_contract(source: CsvSource, types: dict[str, str], keys: list[str]) -> None:
    """Raise if a cell cannot be read as its type or a key is missing."""
    text = source.text()
    check_columns(text.columns, SALES_COLUMNS)
    bad = contract_violations(text, types, keys).where("uncastable + null_keys > 0")
    problems = [
        f"{r['column_name']}: {r['uncastable']} uncastable, {r['null_keys']} empty keys"
        for r in bad.collect()
    ]
    if problems:
        raise ContractViolation("; ".join(problems))


def mark_figures(rows: DataFrame, mark: dt.date | None) -> tuple[int, int, int, dt.date | None]:
    """Rows in the source, rows not after the mark, rows without a date, latest date after it."""
    after = F.col(DAY).isNotNull() if mark is None else F.col(DAY) > F.lit(mark)
    figures = rows.agg(
        F.count("*").alias("n"),
        F.count_if(after).alias("fresh"),
        F.count_if(F.col(DAY).isNull()).alias("undated"),
        F.max(F.when(after, F.col(DAY))).alias("last"),
    ).first()
    late = figures["n"] - figures["fresh"] - figures["undated"]
    return figures["n"], late, figures["undated"], figures["last"]


def register(spark: SparkSession, table: str, path: str) -> None:
    """Make the loaded folder a table of the catalog, with all its partitions."""
    catalog.create_database(spark, table.rsplit(".", 1)[0])
    schema = spark.read.parquet(path).schema
    catalog.create_table(spark, table, schema, path, [DAY])
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def load_sales(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    state_path: str,
    raw_path: str | None = None,
    source_name: str | None = None,
    strict: bool = False,
    allow_undated: bool = False,
    table: str | None = None,
) -> LoadResult:
    """Load what is newer than the mark. The mark moves only after the upsert has succeeded.

    A date that cannot be read is always an error, and so is an empty one unless ``allow_undated``;
    such rows are then merged by every run, since no mark can tell whether they are new. ``strict``
    raises for all other cells that do not fit, too. ``table`` (``database.name``) registers the
    folder in the catalog.
    """
    if not exists(spark, csv_path):
        raise FileNotFoundError(csv_path)
    opened = CsvSource.open(spark, csv_path)
    # The file order has to be taken at the scan; it decides which of two rows of a key is last.
    ordered, order = contract_rows(opened, SOURCE_SCHEMA)
    if strict:
        require_contract(opened, SALES_TYPES, SALES_KEYS)
    else:
        require_contract(opened, {DAY: SALES_TYPES[DAY]}, [])
    if raw_path:
        land_raw(opened, raw_path)
    before = read_watermark(spark, state_path, PIPELINE)
    # Everything after this reads the staged columns it needs, not the text again.
    with held(ordered, "sales") as source:
        total, late, undated, last = mark_figures(source, before)
        if undated and not allow_undated:
            raise ContractViolation(f"{DAY}: {undated} row(s) without a date")
        if total == late:
            return LoadResult(total, 0, late, before, before, True)
        fresh = newer_than(source, DAY, before)
        if before is not None and undated:
            fresh = fresh.unionByName(source.where(F.col(DAY).isNull()))
        merged = upsert(
            spark,
            table_path,
            with_audit(fresh, source_name or csv_path),
            KEY,
            DAY,
            order=[F.col(name) for name in order],
            drop=order,
        )
    if table:
        register(spark, table, table_path)
    after = advance_watermark(spark, state_path, PIPELINE, last)
    return LoadResult(total, merged.rows_merged, late, before, after, False, undated)
