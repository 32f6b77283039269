"""Turning text columns into typed rows with audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.coltypes import SPARK_TYPES, VARCHAR, read_as
from ..functions.text import blank_to_null
from ..sources.csvfiles import INGESTED_AT, SOURCE_FILE


def _reject(name: str, cell: Column, type_name: str) -> Column:
    message = F.concat(F.lit(f"column {name}: not {type_name}: "), cell)
    return F.raise_error(message).cast(SPARK_TYPES[type_name])


def typed_column(name: str, type_name: str, strict: bool = False) -> Column:
    """Blank cells are NULL. Unreadable ones are NULL too, or an error when ``strict``."""
    cell = blank_to_null(F.col(name))
    value = read_as(F.col(name), type_name)
    if strict and type_name != VARCHAR:
        value = F.when(cell.isNull() | value.isNotNull(), value).otherwise(
            _reject(name, cell, type_name)
        )
    return value.alias(name)


def typed_rows(
    rows: DataFrame, columns: list[tuple[str, str]], strict: bool = False
) -> DataFrame:
    """Typed columns, then ``_source_file`` and one load time for the whole job."""
    return rows.select(
        *[typed_column(name, t, strict) for name, t in columns],
        F.col(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT),
    )


def rejected_cells(rows: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """``column_name, rejected``: filled cells per column that do not read as the column's type."""
    counts = rows.agg(
        *[
            F.count_if(blank_to_null(F.col(n)).isNotNull() & read_as(F.col(n), t).isNull()).alias(n)
            for n, t in columns
        ]
    )
    return counts.unpivot([], [n for n, _ in columns], "column_name", "rejected")
