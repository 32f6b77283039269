"""Removal of boilerplate lines, found by how many distinct sites carry them.

HyperLogLog sketches of the sites of each line are built inside the tasks and merged by aggregation.
Where the estimate is near the threshold, sites are counted exactly. Everything is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged

_BLANK = " \t\r"


def lines_of(text: Column) -> Column:
    """Lines of a text without blanks at their ends; none for null."""
    return F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)))


def _key(text: str = "text") -> Column:
    return F.xxhash64(text)


def boilerplate_places(
    documents: DataFrame, site: str, min_sites: int, rsd: float, keep_first: bool
) -> DataFrame:
    """(doc_id, text_key, places): the lines to remove from each document that has any."""
    rows = documents.select("doc_id", "text", F.col(site).cast("string").alias("site"))
    spread = (
        rows.select("site", F.explode(lines_of(F.col("text"))).alias("line"))
        .where("line <> ''")
        .select("site", F.xxhash64("line").alias("line_key"))
        .groupBy("line_key")
        .agg(F.approx_count_distinct("site", rsd).alias("sites"))
    )
    band = 4 * rsd
    likely = staged(
        spread.where(F.col("sites") >= min_sites * (1 - band)).select(
            "line_key", (F.col("sites") > min_sites * (1 + band)).alias("sure")
        ),
        "lines",
    )
    carried = staged(
        rows.select(
            "doc_id", _key().alias("text_key"), "site",
            F.posexplode(lines_of(F.col("text"))).alias("place", "line"),
        )
        .where("line <> ''")
        .select("doc_id", "text_key", "site", "place", F.xxhash64("line").alias("line_key"))
        .join(likely, "line_key"),
        "carried",
    )
    counted = (
        carried.where("NOT sure").select("line_key", "site").distinct()
        .groupBy("line_key").agg(F.count("site").alias("sites"))
        .where(F.col("sites") >= min_sites).select("line_key")
    )
    boilerplate = likely.where("sure").select("line_key").union(counted)
    removed = carried.join(boilerplate, "line_key")
    if keep_first:
        place = F.struct("doc_id", "text_key", "place")
        first = removed.groupBy("line_key").agg(F.min(place).alias("first"))
        removed = removed.join(first, "line_key").where(~place.eqNullSafe(F.col("first")))
    return removed.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))


def remove_boilerplate(
    documents: DataFrame, site: str = "source", min_sites: int = 10, rsd: float = 0.1,
    keep_first: bool = True,
) -> DataFrame:
    """All rows as (row, text, n_lines, n_removed): ``row`` holds the columns of ``documents``.

    A line is what stands between line breaks, without blanks, tabs and carriage returns at its
    ends; empty lines are never boilerplate. A line on at least ``min_sites`` distinct sites is
    removed wherever it stands; with ``keep_first`` its first place, by doc_id and position, stays,
    so that nothing is lost from the corpus. ``rsd`` is the relative error of the sketches; counts
    within four times that of the threshold are made exactly. ``text`` is the text without those
    lines; other lines stay as they are.

    A null text stays null, with no lines; a null site is no site; rows with the same doc_id and
    text are cleaned alike; an empty table gives an empty result; further columns stay in ``row``.
    """
    places = boilerplate_places(documents, site, min_sites, rsd, keep_first)
    all_rows = documents.select(F.struct("*").alias("row"), F.col("text").alias("old"))
    own, other = F.col("row.doc_id"), places["doc_id"]
    joined = all_rows.join(
        places, own.eqNullSafe(other) & (_key("old") == places["text_key"]), "left"
    )
    parts = F.split("old", "\n")
    none = F.array().cast("array<int>")
    places_col = F.coalesce("places", none)
    kept = F.filter(parts, lambda _, i: ~F.array_contains(places_col, i))
    cleaned = F.when(F.size(places_col) > 0, F.array_join(kept, "\n")).otherwise(F.col("old"))
    return joined.select(
        "row",
        cleaned.alias("text"),
        F.when(F.col("old").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.size(places_col).cast("long").alias("n_removed"),
    )


def cleaned_documents(documents: DataFrame, **options) -> DataFrame:
    """The columns of ``documents`` with cleaned texts; those that only held removed lines go."""
    made = remove_boilerplate(documents, **options)
    emptied = (F.col("n_removed") > 0) & ~F.coalesce(F.rlike("text", F.lit(r"[^ \t\r\n]")), F.lit(True))
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns]
    return made.where(~emptied).select(*columns)
