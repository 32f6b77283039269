"""CSV reading: the fixed sales contract and files of unknown shape."""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import (
    Column,
    DataFrame,
    DataFrameReader,
    SparkSession,
    functions as F,
    types as T,
)

from ..functions.names import clean_headers
from .listing import decoded_path, relative_key
from .paths import exists, qualified
from .records import headers, placed_lines, records_of

SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
BAD_RECORD = "_bad_record"
#: Names of the columns that tell the place of a row: file, split and line.
PLACE = ("_order0", "_order1", "_order2")


class EmptySource(ValueError):
    """The source holds no data rows."""


class ContractError(ValueError):
    """The header differs from the agreed columns."""


def check_columns(actual: list[str], expected: list[str]) -> None:
    """Names and order have to be the same."""
    if list(actual) != list(expected):
        raise ContractError(f"expected columns {list(expected)}, found {list(actual)}")


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a line has an odd number of quotes, the mark of a line break inside a field.

    Spark's reader splits files without one; the others are put together to records first.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


@dataclass(frozen=True)
class CsvSource:
    """CSV files with a header, read in splits whatever their line breaks. The text is looked at once
    to see which way they have to be read."""

    spark: SparkSession
    path: str
    quoted: bool

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CsvSource:
        return cls(spark, path, has_quoted_breaks(spark, path))

    def columns(self) -> list[str]:
        """The header of the first file. Records have to have one header in all files."""
        if not self.quoted:
            return self._reader().csv(self.path).columns
        found = self._headers.select("header").distinct().take(2)
        if len(found) > 1:
            raise ContractError(f"files with different headers: {[r['header'] for r in found]}")
        return header_cells(found[0]["header"], ",") if found else []

    def rows(self, schema: T.StructType) -> DataFrame:
        """Rows by position; cells that do not fit their type become NULL."""
        ordered, order = self.ordered(schema)
        return ordered.drop(*order)

    def ordered(self, schema: T.StructType) -> tuple[DataFrame, list[str]]:
        """Rows with further columns that sort them as they stand in their files."""
        if self.quoted:
            rows = record_rows(self._lines, self._headers, schema)
            order = dict(zip(PLACE, map(F.col, PLACE)))
        else:
            # The header is compared in every file when the reader comes to it.
            rows = self._reader().options(enforceSchema=False).schema(schema).csv(self.path)
            order = dict(zip(PLACE, scan_order()))
        return rows.select(*schema.fieldNames(), *[c.alias(name) for name, c in order.items()]), list(order)

    def text(self) -> DataFrame:
        """All cells as text."""
        return self.rows(T.StructType([T.StructField(c, T.StringType()) for c in self.columns()]))

    @cached_property
    def _lines(self) -> DataFrame:
        return placed_lines(self.spark, [self.path])

    @cached_property
    def _headers(self) -> DataFrame:
        return headers(self._lines)

    def _reader(self) -> DataFrameReader:
        return self.spark.read.options(header=True, escape='"')


def scan_order() -> list[Column]:
    """Order of the rows in their files. Only valid directly on a file scan."""
    return [
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    ]


def record_rows(
    lines: DataFrame, heads: DataFrame, schema: T.StructType, delimiter: str = ",", **options: str
) -> DataFrame:
    """The records of ``lines`` below the headers as rows, with the columns ``PLACE`` for their place."""
    place = ["path", "block", "line_no"]
    below = records_of(lines).join(heads.select(place), place, "left_anti")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("text", ddl, {"sep": delimiter, "escape": '"', "mode": "PERMISSIVE", **options})
    return below.select(row.alias("row"), *[F.col(c).alias(p) for c, p in zip(place, PLACE)]).select(
        "row.*", *PLACE
    )


def read_contract_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV whose header must equal ``schema``; missing or empty files are errors.

    Cells that do not fit their type become NULL. Count them with ``contract_violations``.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return contract_rows(CsvSource.open(spark, path), schema)[0].drop(*PLACE)


def contract_rows(source: CsvSource, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """Rows of a source whose header must equal ``schema``, with the columns that order them."""
    check_columns(source.columns(), schema.fieldNames())
    rows, order = source.ordered(schema)
    if rows.isEmpty():
        raise EmptySource(source.path)
    return rows, order


def header_cells(header: str, delimiter: str) -> list[str]:
    """Split a header record, which may span lines, the way the CSV reader does."""
    return [cell.strip() for cell in next(csv.reader(io.StringIO(header), delimiter=delimiter))]


def header_record(spark: SparkSession, path: str, delimiter: str) -> str:
    """The first record of a file whose header spans lines, as one text."""
    reader = spark.read.options(sep=delimiter, escape='"', multiLine=True)
    cells = [c or "" for c in reader.csv(path).first()]
    text = io.StringIO()
    csv.writer(text, delimiter=delimiter, lineterminator="").writerow(cells)
    return text.getvalue()


def read_text_csv(
    spark: SparkSession,
    paths: list[str],
    root: str,
    header: str,
    delimiter: str,
    multi_line: bool,
) -> tuple[DataFrame, list[str]]:
    """Files of one header and delimiter as text columns with cleaned names, plus ``_source_file``.

    Short rows are padded with NULL and extra cells dropped; such rows keep their text in
    ``_bad_record``, so they can be counted.
    """
    names = clean_headers(header_cells(header, delimiter))
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in [*names, BAD_RECORD]]
    )
    if multi_line:
        lines = placed_lines(spark, paths, delimiter)
        rows = record_rows(lines, headers(lines), schema, delimiter, columnNameOfCorruptRecord=BAD_RECORD)
        file = F.col(PLACE[0])
    else:
        rows = spark.read.schema(schema).options(
            header=True,
            sep=delimiter,
            escape='"',
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=BAD_RECORD,
        ).csv(paths)
        file = decoded_path(F.col("_metadata.file_path"))
    key = relative_key(file, qualified(spark, root))
    return rows.withColumn(SOURCE_FILE, key).drop(*PLACE), names


def with_audit(df: DataFrame, source_file: str) -> DataFrame:
    """Add the two audit columns."""
    return df.withColumn(SOURCE_FILE, F.lit(source_file)).withColumn(
        INGESTED_AT, F.current_timestamp()
    )
