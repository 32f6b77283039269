"""Column type inference over text columns, per source file, in one aggregation.

The columns are turned into (column, cell) rows first, so the aggregate has the same dozen
expressions whether a file has five columns or five hundred, and each task shuffles only a handful
of rows per file and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.coltypes import (
    BIGINT,
    DOUBLE,
    MATCH_SHARE,
    MATCHING,
    READABLE,
    TYPE_ORDER,
    VARCHAR,
    kind_of,
)
from ..functions.text import strip
from ..sources.csvfiles import BAD_RECORD, SOURCE_FILE

def _slug(type_name: str) -> str:
    return type_name.lower().removesuffix("(6)")


def profile(rows: DataFrame, names: list[str], per: list[str] | None = None) -> DataFrame:
    """Counts per column (and per value of ``per``, by default the source file).

    ``row_count`` all rows, ``filled`` the non-blank cells, ``<type>_n`` the cells that match a
    type, ``<type>_ok`` the cells that can be read as it where that differs from matching.
    """
    per = [SOURCE_FILE] if per is None else per
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("cell")) for n in names]
    cells = rows.select(*per, F.inline(F.array(*pairs))).withColumn("cell", strip(F.col("cell")))
    # Counting kinds first keeps the code that runs per cell small enough to be compiled.
    kinds = (
        cells.select(
            *per,
            "column_name",
            F.coalesce(F.col("cell") != "", F.lit(False)).alias("filled"),
            kind_of(F.col("cell")).alias("kind"),
        )
        .groupBy(*per, "column_name", "filled", "kind")
        .agg(F.count("*").alias("n"))
    )

    def total(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))

    def of_kinds(wanted: tuple[int, ...]) -> Column:
        return total(F.col("kind").isin(*wanted))

    return kinds.groupBy(*per, "column_name").agg(
        F.sum("n").alias("row_count"),
        total(F.col("filled")).alias("filled"),
        *[of_kinds(MATCHING[t]).alias(f"{_slug(t)}_n") for t in TYPE_ORDER],
        *[of_kinds(READABLE[t]).alias(f"{_slug(t)}_ok") for t in (BIGINT, DOUBLE)],
    )


def match_shares(profiled: DataFrame) -> DataFrame:
    """Share of the filled cells that match each type."""
    kept = [
        c for c in profiled.columns if not c.endswith(("_n", "_ok")) and c != "row_count"
    ]
    return profiled.select(
        *kept,
        *[
            F.try_divide(F.col(f"{_slug(t)}_n"), F.col("filled")).alias(f"{_slug(t)}_share")
            for t in TYPE_ORDER
        ],
    )


def with_type(profiled: DataFrame, numeric_lattice: bool = False) -> DataFrame:
    """Add ``type``: the first type in order that reaches the share, else text.

    With ``numeric_lattice`` whole numbers count as matches for DOUBLE too, so that a column
    mixing ``10`` and ``10.5`` becomes DOUBLE instead of text.
    """
    chosen = F
    for t in TYPE_ORDER:
        matches = f"{_slug(t)}_ok" if t == DOUBLE and numeric_lattice else f"{_slug(t)}_n"
        reached = F.try_divide(F.col(matches), F.col("filled")) >= MATCH_SHARE
        chosen = chosen.when(reached, t)
    return profiled.withColumn("type", chosen.otherwise(VARCHAR))


def infer_schema(
    rows: DataFrame,
    names: list[str],
    numeric_lattice: bool = False,
) -> list[tuple[str, str]]:
    """``(name, type)`` in column order, over all rows taken together."""
    found = with_type(profile(rows, names, per=[]), numeric_lattice).select("column_name", "type")
    types = {r["column_name"]: r["type"] for r in found.collect()}
    return [(n, types.get(n, VARCHAR)) for n in names]


def types_by_first_file(profiled: DataFrame) -> dict[str, str]:
    """Type per column, taken from the first source file (in key order) that fills the column."""
    ranked = F.struct((F.col("filled") == 0).alias("blank"), F.col(SOURCE_FILE))
    columns = profiled.where(F.col("column_name") != BAD_RECORD)
    found = columns.groupBy("column_name").agg(F.min_by("type", ranked).alias("type"))
    return {r["column_name"]: r["type"] for r in found.collect()}


def file_counts(profiled: DataFrame, types: dict[str, str]) -> DataFrame:
    """``_source_file, row_count, rejected, ragged``: rows per file, filled cells unreadable as
    ``types``, and rows with too few or too many cells."""
    of_type: dict[str, list[str]] = {}
    for name, t in types.items():
        of_type.setdefault(t, []).append(name)
    # One branch for each type, however many columns there are.
    readable = F
    for t in sorted(of_type.keys() - {VARCHAR}):
        column = f"{_slug(t)}_ok" if t in (BIGINT, DOUBLE) else f"{_slug(t)}_n"
        readable = readable.when(F.col("column_name").isin(of_type[t]), F.col(column))
    readable = F.col("filled") if readable is F else readable.otherwise(F.col("filled"))
    # The text that the reader keeps of a ragged row comes as one more column.
    ragged = F.col("column_name") == BAD_RECORD
    return profiled.groupBy(SOURCE_FILE).agg(
        F.max("row_count").alias("row_count"),
        F.sum(F.when(ragged, 0).otherwise(F.col("filled") - readable)).alias("rejected"),
        F.sum(F.when(ragged, F.col("filled")).otherwise(0)).alias("ragged"),
    )
