"""Header record, delimiter and content tag of dropped CSV files, worked out for many files at once.

All files are read as lines, whatever their size, and lines are counted by kind inside the tasks: how
often they hold each delimiter outside quoted text. Nothing is cut: the header is a whole record.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.ordered_hash import MODULI, PLACES, moved, terms
from ..session import held
from .csvfiles import header_record
from .records import BYTE_ORDER_MARK, text_lines

# The delimiters tried and the fallback.
DELIMITERS = (",", ";", "\t", "|")
FALLBACK = ","
_COUNTS = [f"c{i}" for i in range(len(DELIMITERS))]


def _occurrences(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _with_counts(lines: DataFrame) -> DataFrame:
    bare = F.regexp_replace("value", '"[^"]*"', "")
    return lines.withColumns({c: _occurrences(bare, d) for c, d in zip(_COUNTS, DELIMITERS)})


def _line_kinds(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per split of a file and kind of line: how many, the first of them, odd quotes, hash in order.

    A file that has gone meanwhile has no lines. Everything that is told of a file comes from this scan.
    """
    lines = text_lines(spark, paths).withColumn("value", F.ltrim("value", F.lit(BYTE_ORDER_MARK)))
    place = F.col("line_no").bitwiseAND(PLACES - 1)
    hashes = terms(F.col("value"), place)
    return (
        _with_counts(lines)
        .groupBy("path", "block", (F.col("value") == "").alias("blank"), *_COUNTS)
        .agg(
            F.count("*").alias("n"),
            F.min(place).alias("place"),
            *[F.sum(h).alias(f"hash{i}") for i, h in enumerate(hashes)],
            F.max(_occurrences(F.col("value"), '"') % 2).alias("odd"),
            F.min(F.struct("block", "line_no", "value")).alias("first"),
        )
    )


def _tags(kinds: DataFrame) -> DataFrame:
    """(path, tag) of all lines in their order, blank ones too, however the file was split."""
    names = [f"hash{i}" for i in range(len(MODULI))]
    splits = kinds.groupBy("path", "block").agg(
        F.sum("n").alias("n"), F.min("place").alias("place"), *[F.sum(h).alias(h) for h in names]
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("n").over(before), F.lit(0))
    placed = splits.withColumn("at", F.pmod(at, F.lit(PLACES)))
    parts = placed.select(
        "path",
        "n",
        *[h.alias(name) for h, name in zip(moved([F.col(h) for h in names], F.col("place"), F.col("at")), names)],
    )
    total = [F.sum(h) % p for h, (p, _) in zip(names, MODULI)]
    return parts.groupBy("path").agg(F.concat_ws("-", F.sum("n"), *total).alias("tag"))


def _open_quote(text: str) -> Column:
    """Whether a line break lies inside a field."""
    return _occurrences(F.col(text), '"') % 2 == 1


def _agreeing(name: str, wanted: str) -> Column:
    """Lines that hold a delimiter as often as the first; at all, if that ends inside a field."""
    same = F.when(_open_quote("value"), F.col(name) > 0).otherwise(
        (F.col(wanted) > 0) & (F.col(name) == F.col(wanted))
    )
    return F.sum(F.when(same, F.col("n")).otherwise(0))


def _with_delimiter(kinds: DataFrame) -> DataFrame:
    """``path, etag, delimiter, header, multi_line``.

    A delimiter scores the lines that hold it as often as the first line does, quoted text left out,
    provided that the first line holds it at all; where the first line ends inside a quoted field, it
    scores the lines that hold it. The best score wins, a tie goes to the order of
    ``DELIMITERS``. At least half of the lines have to agree, otherwise the fallback is used. Blank
    lines count for the tag only, which is that of all lines in their order.
    """
    tags, kinds = _tags(kinds), kinds.where("not blank")
    firsts = kinds.groupBy("path").agg(F.min("first").alias("first")).select("path", "first.value")
    wanted = {c: f"wanted_{c}" for c in _COUNTS}
    first = _with_counts(firsts).withColumnsRenamed(wanted)
    scored = kinds.join(first, "path").groupBy("path", "value").agg(
        F.sum("n").alias("lines"),
        (F.max("odd") == 1).alias("multi_line"),
        *[_agreeing(c, w).alias(f"score_{c}") for c, w in wanted.items()],
    )
    best = F.greatest(*[f"score_{c}" for c in _COUNTS])
    chosen = F.when((best == 0) | (best * 2 < F.col("lines")), FALLBACK)
    for c, d in zip(_COUNTS, DELIMITERS):
        chosen = chosen.when(F.col(f"score_{c}") == best, d)
    return scored.join(tags, "path").select(
        "path",
        F.md5("tag").alias("etag"),
        chosen.alias("delimiter"),
        F.col("value").alias("header"),
        "multi_line",
    )


@contextmanager
def fingerprint(spark: SparkSession, paths: list[str]) -> Iterator[DataFrame]:
    """``path, etag, delimiter, header, multi_line`` for the files at ``paths`` that have lines.

    ``multi_line`` says that some line has an odd number of quotes, the mark of a line break inside
    a field; the others can be read in splits later.
    """
    with held(_line_kinds(spark, paths), "lines") as kinds:
        with held(_with_delimiter(kinds), "dialects") as found:
            yield _whole_headers(spark, found)


def _whole_headers(spark: SparkSession, found: DataFrame) -> DataFrame:
    """A header whose first line leaves a quote open goes on; these few are read as records."""
    headers = [
        (r["path"], header_record(spark, r["path"], r["delimiter"]))
        for r in found.where(_open_quote("header")).select("path", "delimiter").collect()
    ]
    if not headers:
        return found
    whole = spark.createDataFrame(headers, "path string, whole string")
    return (
        found.join(whole, "path", "left")
        .withColumn("header", F.coalesce("whole", "header"))
        .drop("whole")
    )
