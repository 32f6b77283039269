"""Ingest of a folder of CSV files: new files become rows of the table named by their folder."""

from __future__ import annotations

import logging
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.coltypes import SPARK_TYPES, TYPE_OF_SPARK, VARCHAR
from ..operators import metadata
from ..operators.evolve import missing_columns, united
from ..operators.inference import file_counts, profile, types_by_first_file, with_type
from ..operators.replace import BUCKETS, SOURCE_BUCKET, replace_by_source, table_schema
from ..operators.typed_load import typed_rows
from ..session import held
from ..sources import catalog
from ..sources.csvfiles import BAD_RECORD, INGESTED_AT, SOURCE_FILE, read_text_csv
from ..sources.delimiter import fingerprint
from ..sources.filemeta import data_files
from ..sources.listing import list_csv, warn_large
from ..sources.paths import exists, qualified

log = logging.getLogger(__name__)

FILES_PER_WAVE = 10_000
# What can go wrong with some files of many: errors of Spark and of file systems, bad content.
_PROBLEMS = (PySparkException, Py4JJavaError, ValueError, OSError)
AUDIT = [
    T.StructField(SOURCE_FILE, T.StringType()),
    T.StructField(INGESTED_AT, T.TimestampType()),
]


@dataclass(frozen=True)
class Options:
    """Settings of a run."""

    database: str
    strict: bool = False
    numeric_lattice: bool = False
    delimiter: str | None = None
    buckets: int = BUCKETS
    files_per_wave: int = FILES_PER_WAVE
    tables_at_once: int = 4
    dialects_at_once: int = 32


@dataclass(frozen=True)
class FileCounts:
    """Rows of a file, cells that could not be read, rows with too few or too many cells."""

    row_count: int = 0
    rejected: int = 0
    ragged: int = 0


@dataclass(frozen=True)
class TableResult:
    """What loading some files did to one table; ``refused`` says why a file was left out."""

    created: bool
    columns_added: list[str]
    files: dict[str, FileCounts]
    refused: dict[str, str]


def _waves(files: list[Any], size: int) -> list[list[Any]]:
    return [files[i : i + size] for i in range(0, len(files), size)]


def _dialect(f: Any) -> tuple:
    """Files of one dialect can be taken by one reader."""
    return f["header"], f["delimiter"], f["multi_line"]


def _groups(files: list[Any]) -> dict[tuple, list[Any]]:
    groups: dict[tuple, list[Any]] = defaultdict(list)
    for f in files:
        groups[_dialect(f)].append(f)
    return groups


def _portions(files: list[Any], opts: Options) -> list[list[Any]]:
    """Portions with a limited number of dialects and files each, which bounds a plan's size."""
    groups = list(_groups(files).values())
    joined = [
        [f for group in groups[i : i + opts.dialects_at_once] for f in group]
        for i in range(0, len(groups), opts.dialects_at_once)
    ]
    return [wave for portion in joined for wave in _waves(portion, opts.files_per_wave)]


def _known_types(spark: SparkSession, table: str) -> dict[str, str]:
    fields = spark.table(table).schema.fields
    return {
        f.name: TYPE_OF_SPARK.get(f.dataType.simpleString(), VARCHAR)
        for f in fields
        if f.name not in (SOURCE_FILE, INGESTED_AT, SOURCE_BUCKET)
    }


def _register_existing(spark: SparkSession, table: str, path: str) -> None:
    """Bring a table back that has its files but is not in the catalog (any more)."""
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    catalog.create_table(spark, table, table_schema(found), path, [SOURCE_BUCKET])
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _frames(
    spark: SparkSession, root: str, files: list[Any], opts: Options
) -> list[tuple[DataFrame, list[str]]]:
    """Text rows and column names of the files, a frame for each dialect."""
    return [
        read_text_csv(
            spark, [f["path"] for f in group], root, header, opts.delimiter or delimiter, multi_line
        )
        for (header, delimiter, multi_line), group in _groups(files).items()
    ]


def ingest_files(
    spark: SparkSession, root: str, lake: str, table_name: str, files: list[Any], opts: Options
) -> TableResult:
    """Infer, create or evolve, and replace the rows of ``files`` in one table.

    ``files`` are entries with key, path, header, delimiter and multi_line, all of one table.
    An existing column keeps its type. A new one gets the type found in the first file, by key, that
    fills it; all files are looked at before the first is loaded, so it does not matter in which
    portions they are taken. With ``strict``, files with unreadable cells are left out.
    """
    if any(not f["header"] for f in files):
        raise ValueError("no header row")
    table = f"`{opts.database}`.`{table_name}`"
    path = f"{lake}/{table_name}"
    created = not catalog.table_exists(spark, f"{opts.database}.{table_name}")
    if created and exists(spark, path) and not data_files(spark, path).isEmpty():
        _register_existing(spark, table, path)
        created = False
    known = {} if created else _known_types(spark, table)

    portions = _portions(files, opts)
    columns: dict[str, None] = {}
    with ExitStack() as stack:
        profiles = []
        for portion in portions:
            found = []
            for rows, names in _frames(spark, root, portion, opts):
                columns.update(dict.fromkeys(names))
                typed = with_type(profile(rows, [*names, BAD_RECORD]), opts.numeric_lattice)
                found.append(typed)
            profiles.append(stack.enter_context(held(united(found), "profile")))
        profiled = united(profiles)
        types = {c: VARCHAR for c in columns} | types_by_first_file(profiled) | known
        counts = {
            r[SOURCE_FILE]: FileCounts(r["row_count"], r["rejected"], r["ragged"])
            for r in file_counts(profiled, types).collect()
        }
    refused = {
        key: f"{n.rejected} cell(s) that cannot be read"
        for key, n in counts.items()
        if opts.strict and n.rejected
    }
    portions = [p for p in ([f for f in p if f["key"] not in refused] for p in portions) if p]
    if not portions:
        return TableResult(False, [], counts, refused)

    added = [] if created else missing_columns([(c, types[c]) for c in columns], list(known))
    ddl = ", ".join(f"`{c}` {SPARK_TYPES[types[c]]}" for c in columns)
    fields = T.StructType.fromDDL(ddl).fields
    if created:
        schema = table_schema(T.StructType([*fields, *AUDIT]))
        catalog.create_table(spark, table, schema, path, [SOURCE_BUCKET])
    elif added:
        new = {name for name, _ in added}
        catalog.add_columns(spark, table, [f for f in fields if f.name in new])
    schema = spark.table(table).schema

    for portion in portions:
        typed = united(
            [
                typed_rows(rows, [(n, types[n]) for n in names], opts.strict)
                for rows, names in _frames(spark, root, portion, opts)
            ]
        )
        absent = [f for f in schema.fields if f.name not in (*typed.columns, SOURCE_BUCKET)]
        typed = typed.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
        keys = spark.createDataFrame([(f["key"],) for f in portion], f"{SOURCE_FILE} string")
        replace_by_source(spark, path, schema, typed, keys, opts.buckets)
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(f"{opts.database}.{table_name}")
    return TableResult(created, [name for name, _ in added], counts, refused)


def _record(f: Any, run_id: str, status: str, counts: FileCounts, error: str = "") -> dict:
    return {
        "file_key": f["key"],
        "etag": f["etag"],
        "table_name": f["table_name"],
        "row_count": counts.row_count,
        "status": status,
        "error_message": error,
        "run_id": run_id,
        "size": f["size"],
        "modified_at": f["modified_at"],
        "rejected": counts.rejected,
        "ragged": counts.ragged,
    }


def _failed(f: Any, run_id: str, problem: str) -> dict:
    log.warning("%s failed: %s", f["key"], problem)
    return _record(f, run_id, "failed", FileCounts(), problem)


def _load_table(
    spark: SparkSession, root: str, lake: str, name: str, files: list[Any], run_id: str, opts: Options
) -> list[dict]:
    """Registry records of one table's files. If they fail together, each half is tried alone."""
    headless = [f for f in files if not f["header"]]
    if headless:
        rest = [f for f in files if f["header"]]
        records = [_failed(f, run_id, "no header row") for f in headless]
        return records + (_load_table(spark, root, lake, name, rest, run_id, opts) if rest else [])
    try:
        done = ingest_files(spark, root, lake, name, files, opts)
        log.info("%s: %d file(s), %s", name, len(files), "created" if done.created else done.columns_added)
        return [
            _failed(f, run_id, done.refused[f["key"]])
            if f["key"] in done.refused
            else _record(f, run_id, "success", done.files.get(f["key"], FileCounts()))
            for f in files
        ]
    except _PROBLEMS as problem:
        if len(files) == 1:
            return [_failed(files[0], run_id, str(problem))]
        middle = len(files) // 2
        return [
            record
            for half in (files[:middle], files[middle:])
            for record in _load_table(spark, root, lake, name, half, run_id, opts)
        ]


def _described(
    spark: SparkSession, candidates: DataFrame, wave: list[Any], registry: DataFrame
) -> tuple[list[Any], list[Any], list[Any]]:
    """Listing entries of changed files with tag and dialect, of files that could not be read, and of
    files that only look changed."""
    try:
        with fingerprint(spark, [f["path"] for f in wave]) as probed:
            with held(candidates.join(probed, "path"), "described") as described:
                changed = metadata.changed_files(described, registry).collect()
                seen = described.collect()
        loaded, read = {f["path"] for f in changed}, {f["path"] for f in seen}
        return (
            changed,
            [f for f in wave if f["path"] not in read],
            [f for f in seen if f["path"] not in loaded],
        )
    except _PROBLEMS:
        if len(wave) == 1:
            return [], wave, []
        middle = len(wave) // 2
        halves = [_described(spark, candidates, w, registry) for w in (wave[:middle], wave[middle:])]
        return tuple(one + other for one, other in zip(*halves))


def ingest_folder(
    spark: SparkSession, root: str, lake: str, run_id: str, opts: Options
) -> list[dict]:
    """Load all new and changed CSV files below ``root``; returns their registry records.

    Files whose size and time are in the registry are not opened. The others are read as lines for a
    content tag, which also gives delimiter and header. Those with the content loaded last are put in
    the registry with their new time, and not returned. All files of a table that a run finds are
    typed together. The driver holds the listing entries of the new files, as a reader takes its
    paths as a list; whatever happens to one table, the records of the others are stored.
    """
    root = qualified(spark, root)
    catalog.create_database(spark, opts.database)
    registry = metadata.read(spark, lake, metadata.REGISTRY)
    records: list[dict] = []
    touched: list[dict] = []
    with held(metadata.new_files(list_csv(spark, root), registry), "candidates") as candidates:
        warn_large(candidates)
        by_table: dict[str, list[Any]] = defaultdict(list)
        listed = candidates.orderBy("key").collect()
        for wave in _waves(listed, opts.files_per_wave):
            changed, unread, same = _described(spark, candidates, wave, registry)
            for f in changed:
                by_table[f["table_name"]].append(f)
            touched += [_record(f, run_id, metadata.UNCHANGED, FileCounts()) for f in same]
            for f in unread:
                there = exists(spark, f["path"])
                problem = "no header row" if there else "the file is gone"
                records.append(_failed({**f.asDict(), "etag": None}, run_id, problem))
        # Tables are independent, so their jobs may share the cluster.
        with ThreadPoolExecutor(opts.tables_at_once) as pool:
            loads = [
                pool.submit(
                    _load_table, spark, root, lake, name,
                    sorted(files, key=lambda f: f["key"]), run_id, opts,
                )
                for name, files in by_table.items()
            ]
        for load in loads:
            if load.exception() is None:
                records.extend(load.result())
        metadata.append(spark, lake, metadata.REGISTRY, records + touched)
        for load in loads:
            load.result()
    return records
