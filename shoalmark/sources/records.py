"""Whole CSV records out of files that are read in splits, also where fields hold line breaks.

Whether a line begins inside a quoted field depends on all lines before it, but each line only maps one
of two states to another: it leaves the state as it is, turns it, or ends outside or inside whatever came
before. Such maps are composed inside every split first, then over the splits of a file, which gives the
state at the begin of each split and so of each line. Lines that begin inside a field are put together
with the line that their record starts on. No file is ever one task, however large it is and wherever its
quotes stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import staged
from .listing import decoded_path

BYTE_ORDER_MARK = chr(0xFEFF)
QUOTE = '"'


def text_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, block, line_no, value) of all lines, blank ones included.

    ``line_no`` grows with the lines of a split; it says nothing across splits.
    """
    return (
        spark.read.option("ignoreMissingFiles", True)
        .text(paths)
        .select(
            decoded_path(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line_no"),
            "value",
        )
    )


def _closes(cell: Column) -> Column:
    """Whether a quote that is not one of a pair lies in the rest of a quoted field."""
    return F.replace(cell, F.lit(QUOTE * 2), F.lit("")).contains(QUOTE)


def state_after(value: Column, delimiter: str, inside: bool) -> Column:
    """Whether a line ends inside a quoted field, if it begins inside or outside of one.

    Only a quote at the begin of a cell opens a field; others are letters, as for Spark's reader.
    """

    def step(inside_now: Column, cell: Column) -> Column:
        opens = cell.startswith(QUOTE) & ~_closes(F.substring(cell, 2, 1 << 30))
        return F.when(inside_now, ~_closes(cell)).otherwise(opens)

    cells = F.split(value, f"\\Q{delimiter}\\E", -1)
    walked = F.aggregate(cells, F.lit(inside), step)
    return F.when(value.contains(QUOTE), walked).otherwise(F.lit(inside))


def _composed(lines: DataFrame, delimiter: str) -> DataFrame:
    """Per line, for a split that begins outside (0) and inside (1) of a field: the state after it and
    the line that its record starts on."""
    split = Window.partitionBy("path", "block").orderBy("line_no")
    upto = split.rowsBetween(Window.unboundedPreceding, 0)
    mapped = lines.withColumns(
        {
            "from_out": state_after(F.col("value"), delimiter, False).cast("int"),
            "from_in": state_after(F.col("value"), delimiter, True).cast("int"),
        }
    )
    fixed, turned = F.col("from_out") == F.col("from_in"), F.col("from_out") > F.col("from_in")
    turns = mapped.withColumn("turns", F.sum(turned.cast("int")).over(upto))
    anchor = F.last(F.when(fixed, F.struct("from_out", "turns")), ignorenulls=True).over(upto)
    after = turns.withColumn("anchor", anchor)
    known = F.col("anchor.from_out") + F.col("turns") - F.col("anchor.turns")
    for begin in (0, 1):
        after = after.withColumn(f"after{begin}", F.coalesce(known, F.col("turns") + begin) % 2)
        before = F.lag(f"after{begin}", 1, begin).over(split)
        after = after.withColumn(f"before{begin}", before)
        starts = F.when(F.col(f"before{begin}") == 0, F.col("line_no"))
        after = after.withColumn(f"start{begin}", F.last(starts, ignorenulls=True).over(upto))
    # The record of a split's last line may go on in the next one.
    is_last = F.lead("line_no").over(split).isNull().alias("is_last")
    states = [f"{name}{begin}" for begin in (0, 1) for name in ("after", "start")]
    return after.select("path", "block", "line_no", "value", *states, is_last)


def _split_starts(composed: DataFrame) -> DataFrame:
    """(path, block, inside, came): the state at the begin of every split, and the record it goes on with.

    A file has as many rows here as splits.
    """
    ends = composed.where("is_last").select(
        "path", F.struct("block", "after0", "after1", "start0", "start1").alias("s")
    )
    empty = F.expr(
        "named_struct('state', 0, 'record', cast(null as struct<block: bigint, line_no: bigint>), "
        "'found', cast(array() as array<struct<block: bigint, inside: int, "
        "came: struct<block: bigint, line_no: bigint>>>))"
    )

    def step(acc: Column, s: Column) -> Column:
        outside = acc["state"] == 0
        start = F.when(outside, s["start0"]).otherwise(s["start1"])
        own = F.when(
            start.isNotNull(), F.struct(s["block"].alias("block"), start.alias("line_no"))
        ).otherwise(acc["record"])
        at = F.struct(s["block"].alias("block"), acc["state"].alias("inside"), acc["record"].alias("came"))
        return F.struct(
            F.when(outside, s["after0"]).otherwise(s["after1"]).cast("int").alias("state"),
            own.alias("record"),
            F.concat(acc["found"], F.array(at)).alias("found"),
        )

    folded = ends.groupBy("path").agg(F.sort_array(F.collect_list("s")).alias("splits"))
    found = folded.select("path", F.inline(F.aggregate("splits", empty, step, lambda acc: acc["found"])))
    return found.select("path", "block", "inside", "came")


def placed_lines(spark: SparkSession, paths: list[str], delimiter: str = ",") -> DataFrame:
    """(path, record, line, single): the lines of the files, with the place of the line their record begins on.

    ``single`` lines are records of their own. The lines are written to the scratch folder once, with their
    states, and so are the few rows for the begins of the splits: Spark then knows their size, and the lines
    need no exchange to meet them.
    """
    composed = staged(_composed(text_lines(spark, paths), delimiter), "lines")
    placed = composed.join(staged(_split_starts(composed), "splits"), ["path", "block"])
    inside = F.col("inside") == 1
    start = F.when(inside, F.col("start1")).otherwise(F.col("start0"))
    after = F.when(inside, F.col("after1")).otherwise(F.col("after0"))
    own = F.struct("block", start.alias("line_no"))
    return placed.select(
        "path",
        F.when(start.isNotNull(), own).otherwise(F.col("came")).alias("record"),
        F.struct("block", "line_no", "value").alias("line"),
        (~F.col("is_last") & (after == 0) & (start == F.col("line_no"))).alias("single"),
    )


def _without_mark(text: str) -> Column:
    return F.ltrim(text, F.lit(BYTE_ORDER_MARK))


def records_of(lines: DataFrame) -> DataFrame:
    """(path, block, line_no, text): the records of ``placed_lines``, at the place where each begins.

    Records that are blank are left out. The lines of a record are joined by line feeds. ``block`` and
    ``line_no`` are those of its first line, so a file's records come in their order.
    """
    # A line that begins and ends outside of a field is a record; only the others are brought together.
    whole = lines.where(F.coalesce("single", F.lit(False))).select("path", "record", F.col("line.value").alias("text"))
    parts = (
        lines.where(~F.coalesce("single", F.lit(False)))
        .groupBy("path", "record")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
        .select("path", "record", F.array_join("lines.value", "\n").alias("text"))
    )
    return (
        whole.unionAll(parts)
        .select("path", "record.*", _without_mark("text").alias("text"))
        .where(F.trim("text") != "")
    )


def csv_records(spark: SparkSession, paths: list[str], delimiter: str = ",") -> DataFrame:
    """``records_of`` the lines of the files."""
    return records_of(placed_lines(spark, paths, delimiter))


def headers(lines: DataFrame) -> DataFrame:
    """(path, block, line_no, header): the first record of every file of ``placed_lines``.

    Its place is found by the lines that records begin on, so only its own lines are brought together. A
    record that is blank has one line. The result, one row for each file, is written to the scratch folder.
    """
    begins = (F.col("line.block") == F.col("record.block")) & (F.col("line.line_no") == F.col("record.line_no"))
    first = (
        lines.where(begins & (F.trim(_without_mark("line.value")) != ""))
        .groupBy("path")
        .agg(F.min("record").alias("at"))
        .select("path", F.col("at.block").alias("block"), F.col("at.line_no").alias("line_no"))
    )
    placed = lines.select("path", "record.block", "record.line_no", "record", "line", F.lit(False).alias("single"))
    own = placed.join(staged(first, "firsts"), ["path", "block", "line_no"], "left_semi")
    return staged(records_of(own).withColumnRenamed("text", "header"), "headers")
