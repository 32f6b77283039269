"""Names, types, delimiters, typed load and the ingest of CSV folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import clean_name_column
from ..functions.text import blank_to_null
from ..operators import metadata
from ..operators.evolve import reconcile
from ..operators.inference import match_shares, profile, with_type
from ..operators.replace import SOURCE_BUCKET, replace_by_source, table_schema
from ..operators.typed_load import rejected_cells, typed_rows
from ..plans.autoingest import Options, ingest_folder
from ..plans.incremental import land_raw
from ..session import scratch_path, staged
from ..sources.csvfiles import CsvSource, check_columns
from ..sources.delimiter import fingerprint
from ..sources.listing import list_csv, list_files
from ..sources.paths import move, remove
from .common import load, plain

BUCKETS = 16


def sanitise_names(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned page addresses and part labels, counted."""
    pages = load(spark, folder, "pages").select("url")
    parts = load(spark, folder, "part").select(
        F.concat_ws(" ", "p_size", "p_name", F.lit("#"), "p_brand").alias("url")
    )
    cleaned = pages.unionByName(parts).select(clean_name_column(F.col("url")).alias("name"))
    return cleaned.groupBy("name").agg(F.count("*").alias("n"))


def blank_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document as a cell; blank ones become NULL."""
    lines = load(spark, folder, "documents").select(
        "lang", F.explode(F.split("text", "\n")).alias("line")
    )
    return lines.groupBy("lang").agg(
        F.count("*").alias("lines"),
        F.count(blank_to_null(F.col("line"))).alias("filled"),
        F.sum(F.length(blank_to_null(F.col("line")))).alias("characters"),
    )


_TEXT_TABLES = ("orders", "events", "customer", "part")


def _as_text(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table = load(spark, folder, name)
    return table.select(*[F.col(c).cast("string").alias(c) for c in table.columns])


def type_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Share of cells per type for every column of four tables."""
    found = None
    for name in _TEXT_TABLES:
        text = _as_text(spark, folder, name)
        shares = match_shares(profile(text, text.columns, per=[])).withColumn(
            "table_name", F.lit(name)
        )
        found = shares if found is None else found.unionByName(shares)
    return found


def infer_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Inferred type for every column of four tables."""
    found = None
    for name in _TEXT_TABLES:
        text = _as_text(spark, folder, name)
        typed = with_type(profile(text, text.columns, per=[])).select(
            F.lit(name).alias("table_name"), "column_name", "filled", "type"
        )
        found = typed if found is None else found.unionByName(typed)
    return found


def _messy(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text cells: other date styles, blanks and values that do not fit."""
    orders = load(spark, folder, "orders")
    priority = F.col("o_orderpriority")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(priority == "5-LOW", F.lit("n/a"))
        .when(priority == "1-URGENT", F.lit(" \t"))
        .otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
        .alias("price"),
        F.when(priority == "2-HIGH", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "M-d-yyyy"))
        .when(priority == "5-LOW", F.lit("1999-02-29"))
        .otherwise(F.date_format("o_orderdate", "yyyy/M/d"))
        .alias("day"),
        F.when(F.col("o_orderstatus") == "F", F.lit("YES"))
        .when(F.col("o_orderstatus") == "O", F.lit("0"))
        .otherwise(F.lit("maybe"))
        .alias("done"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:30:00.5Z")).alias("at"),
        priority.alias("_source_file"),
    )


_MESSY_TYPES = [
    ("id", "INTEGER"),
    ("price", "DOUBLE"),
    ("day", "DATE"),
    ("done", "BOOLEAN"),
    ("at", "TIMESTAMP(6)"),
]


def typed_load(spark: SparkSession, folder: str) -> DataFrame:
    typed = typed_rows(_messy(spark, folder), _MESSY_TYPES)
    return plain(typed.drop("_ingested_at"))


def rejects(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_cells(_messy(spark, folder), _MESSY_TYPES)


# Delimiter under which each table is dropped.
_DROPS = {"orders": ",", "customer": ";", "part": "\t", "supplier": "|"}


def _write_csv(table: DataFrame, path: str, delimiter: str = ",") -> None:
    table.write.option("header", True).option("sep", delimiter).csv(path)


def detect_delimiter(spark: SparkSession, folder: str) -> DataFrame:
    """Four tables dropped as CSV with four delimiters."""
    root = scratch_path(spark, "drops")
    for name, delimiter in _DROPS.items():
        _write_csv(_as_text(spark, folder, name), f"{root}/{name}", delimiter)
    files = list_csv(spark, root)
    paths = [r["path"] for r in files.select("path").collect()]
    with fingerprint(spark, paths) as probed:
        found = files.join(probed, "path").select("table_name", "delimiter", "header").distinct()
        return staged(found, "dialects")


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a file. Those with status F were seen before, low priority ones failed."""
    orders = load(spark, folder, "orders")
    key = F.concat_ws("/", F.col("o_custkey"), F.col("o_orderkey"))
    files = orders.select(
        key.alias("key"), F.col("o_orderstatus").alias("etag"), "o_orderpriority"
    )
    registry = orders.select(
        key.alias("file_key"),
        F.lit("F").alias("etag"),
        F.when(F.col("o_orderpriority") == "5-LOW", "failed").otherwise("success").alias("status"),
        F.length("o_orderpriority").cast("bigint").alias("size"),
        F.col("o_orderdate").alias("modified_at"),
        F.col("o_orderdate").alias("ingested_at"),
    )
    return metadata.changed_files(files, registry)


def replace_source(spark: SparkSession, folder: str) -> DataFrame:
    """A table of five source files, one of which comes again with other rows."""
    path = scratch_path(spark, "table")
    rows = load(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderpriority").alias("_source_file")
    )
    schema = table_schema(rows.schema)
    sources = rows.select("_source_file").distinct()
    replace_by_source(spark, path, schema, rows, sources, BUCKETS)
    urgent = (F.col("_source_file") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    again = rows.where(urgent).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    only = sources.where(F.col("_source_file") == "1-URGENT")
    replace_by_source(spark, path, schema, again, only, BUCKETS)
    return spark.read.schema(schema).parquet(path).drop(SOURCE_BUCKET)


def replace_source_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The sources of a table come again, one after the other, each time with other buckets."""
    path = scratch_path(spark, "table")
    rows = load(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("_source_file")
    )
    schema = table_schema(rows.schema)
    sources = rows.select("_source_file").distinct()
    replace_by_source(spark, path, schema, rows, sources, BUCKETS)
    dearer = rows.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    replace_by_source(spark, path, schema, dearer, sources, 4 * BUCKETS)
    low = F.col("_source_file") == "5-LOW"
    replace_by_source(spark, path, schema, rows.where(low), sources.where(low), 1)
    return spark.read.schema(schema).parquet(path).drop(SOURCE_BUCKET)


WIDE = [f"column_{n:04d}_{'x' * 34}" for n in range(200)]


def autoingest_wide(spark: SparkSession, folder: str) -> DataFrame:
    """A header of more than 8192 characters, and one with line breaks inside its cells."""
    root, lake, opts = _lake(spark)
    supplier = load(spark, folder, "supplier")
    key = F.col("s_suppkey")
    wide = supplier.select(*[(key + n + 2).cast("string").alias(c) for n, c in enumerate(WIDE)])
    _write_csv(wide, f"{root}/wide")
    names = {"s_suppkey": "key\nof it", "s_name": "name", "s_acctbal": 'the "balance"\nin\nmoney'}
    broken = supplier.select(*[F.col(c).cast("string").alias(n) for c, n in names.items()])
    broken.write.options(header=True, sep=";", escape='"').csv(f"{root}/broken")
    ingest_folder(spark, root, lake, "run-1", opts)
    one = spark.table(f"{opts.database}.wide").agg(
        F.lit("wide").alias("table_name"), F.count("*").alias("rows"),
        F.sum(WIDE[0]).alias("first"), F.sum(WIDE[-1]).cast("double").alias("last"),
    )
    two = spark.table(f"{opts.database}.broken").agg(
        F.lit("broken").alias("table_name"), F.count("*").alias("rows"),
        F.sum("key_of_it").alias("first"),
        F.sum(F.col("the_balance_in_money").cast("decimal(18,2)")).cast("double").alias("last"),
    )
    return one.unionByName(two)


def autoingest_failures(spark: SparkSession, folder: str) -> DataFrame:
    """One file of many is broken, is tried again after repair, and another changes its content."""
    root, lake, opts = _lake(spark)
    orders = _as_text(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    for n in range(1, 6):
        part = orders.where(F.col("o_orderpriority").startswith(str(n)))
        _write_csv(part.coalesce(1), f"{root}/orders/p{n}")
    spark.createDataFrame([("",)], "value string").coalesce(1).write.text(f"{root}/orders/bad")
    for file in list_files(spark, f"{root}/orders/bad", "*.txt").select("path").collect():
        move(spark, file["path"], f"{root}/orders/bad/f.csv")
    ingest_folder(spark, root, lake, "run-1", opts)
    remove(spark, f"{root}/orders/bad")
    extra = orders.where("o_orderpriority = '5-LOW'").withColumn("o_orderkey", F.lit("7"))
    _write_csv(extra.coalesce(1), f"{root}/orders/bad")
    for file in list_files(spark, f"{root}/orders/bad", "*.csv").select("path").collect():
        move(spark, file["path"], f"{root}/orders/bad/f.csv")
    changed = list_files(spark, f"{root}/orders/p1", "*.csv").first()["path"]
    remove(spark, f"{root}/orders/p1")
    _write_csv(orders.where("o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0").coalesce(1), f"{root}/orders/p1")
    for file in list_files(spark, f"{root}/orders/p1", "*.csv").select("path").collect():
        move(spark, file["path"], changed)
    ingest_folder(spark, root, lake, "run-2", opts)
    tally = (
        metadata.read(spark, lake, metadata.REGISTRY).groupBy("run_id", "status")
        .agg(F.count("*").alias("files"), F.sum("row_count").alias("loaded"))
    )
    table = spark.table(f"{opts.database}.orders").agg(
        F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum")
    )
    figures = table.first()
    return tally.select(
        "*", F.lit(figures["rows"]).alias("rows"), F.lit(figures["key_sum"]).alias("key_sum")
    )


def _lake(spark: SparkSession) -> tuple[str, str, Options]:
    base = scratch_path(spark, "lake")
    database = f"drops_{uuid.uuid4().hex[:10]}"
    return f"{base}/uploads", f"{base}/tables", Options(database=database, buckets=BUCKETS)


def autoingest(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers dropped as CSV; row counts and inferred columns of their tables."""
    root, lake, opts = _lake(spark)
    _write_csv(_as_text(spark, folder, "orders"), f"{root}/Orders 2024")
    _write_csv(_as_text(spark, folder, "customer"), f"{root}/customer", ";")
    ingest_folder(spark, root, lake, "run-1", opts)
    ingest_folder(spark, root, lake, "run-2", opts)
    registry = metadata.read(spark, lake, metadata.REGISTRY)
    loaded = registry.groupBy("table_name", "status", "run_id").agg(
        F.sum("row_count").alias("row_count"), F.sum("rejected").alias("rejected")
    )
    orders = spark.table(f"{opts.database}.orders_2024").agg(
        F.lit("orders_2024").alias("table_name"),
        F.count("*").alias("rows"),
        F.sum("o_orderkey").alias("key_sum"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("money"),
        F.max(F.to_date("o_orderdate")).alias("last_date"),
    )
    customers = spark.table(f"{opts.database}.customer").agg(
        F.lit("customer").alias("table_name"),
        F.count("*").alias("rows"),
        F.sum("c_custkey").alias("key_sum"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("money"),
        F.lit(None).cast("date").alias("last_date"),
    )
    return plain(loaded.join(orders.unionByName(customers), "table_name"))


def evolve_add_column(spark: SparkSession, folder: str) -> DataFrame:
    """A second drop brings a column that the first did not have, and lacks another."""
    root, lake, opts = _lake(spark)
    orders = _as_text(spark, folder, "orders")
    first = orders.where("o_orderstatus = 'F'").drop("o_orderpriority")
    _write_csv(first, f"{root}/orders/first")
    ingest_folder(spark, root, lake, "run-1", opts)
    _write_csv(orders.where("o_orderstatus <> 'F'").drop("o_custkey"), f"{root}/orders/second")
    ingest_folder(spark, root, lake, "run-2", opts)
    table = spark.table(f"{opts.database}.orders")
    return table.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


def evolve_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile(
        load(spark, folder, "part"),
        drop=["p_type"],
        rename={"p_name": "label", "p_retailprice": "price"},
        widen={"p_size": "bigint"},
        order=["p_partkey", "price"],
    )


def quoted_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with line breaks in their cells, dropped as CSV, landed as raw copy and read back."""
    base = scratch_path(spark, "quoted")
    documents = load(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    documents.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{base}/drop")
    dropped = CsvSource.open(spark, f"{base}/drop")
    check_columns(dropped.columns(), documents.columns)
    land_raw(dropped, f"{base}/raw")
    landed = CsvSource.open(spark, f"{base}/raw").rows(documents.schema)
    text = F.coalesce("text", F.lit(""))
    return landed.select(
        "doc_id", "lang", "source", F.md5(text).alias("text_md5"),
        F.char_length(text).cast("bigint").alias("n_chars"),
    )


QUERIES = {
    "load_quoted_breaks": quoted_breaks,
    "sanitise_names": sanitise_names,
    "blank_to_null": blank_cells,
    "type_match_shares": type_shares,
    "infer_schema_strings": infer_schema,
    "typed_load": typed_load,
    "typed_load_rejects": rejects,
    "detect_delimiter": detect_delimiter,
    "new_files_antijoin": new_files,
    "replace_by_source": replace_source,
    "replace_by_source_twice": replace_source_twice,
    "autoingest_wide": autoingest_wide,
    "autoingest_failures": autoingest_failures,
    "autoingest_dir": autoingest,
    "evolve_add_column": evolve_add_column,
    "evolve_reconcile": evolve_reconcile,
}

_COLUMNS = {
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "events": "event_id ts user_id event_type value props",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
}
# A double prints with a decimal point in either engine, so its text is only looked at for shape.
_CELLS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
    f"CAST({column} AS VARCHAR) AS cell FROM {table}"
    for table, columns in _COLUMNS.items()
    for column in columns.split()
)
_SHARES = f"""
WITH cells AS ({_CELLS}),
shares AS (
SELECT table_name, column_name, COUNT(*) AS filled,
  COUNT(*) FILTER (WHERE lower(cell) IN ('true','yes','1','false','no','0')) AS b,
  COUNT(*) FILTER (WHERE regexp_matches(cell, '^-?[0-9]+$') AND TRY_CAST(cell AS INTEGER) IS NOT NULL) AS i,
  COUNT(*) FILTER (WHERE regexp_matches(cell, '^-?[0-9]+$')) AS l,
  COUNT(*) FILTER (WHERE regexp_matches(cell, '^-?[0-9]+(\\.[0-9]*([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)$')) AS d,
  COUNT(*) FILTER (WHERE regexp_matches(cell, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$')) AS t,
  COUNT(*) FILTER (WHERE regexp_matches(cell, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9:]{{8}}(\\.[0-9]{{1,6}})?$')) AS m
FROM cells WHERE trim(cell) <> '' GROUP BY ALL)"""

_MESSY_SQL = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderpriority NOT IN ('5-LOW', '1-URGENT') THEN o_totalprice END AS price,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL
       WHEN o_orderpriority = '3-MEDIUM' AND month(o_orderdate) <= 12 AND day(o_orderdate) <= 12
       THEN strftime(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), '%Y-%m-%d')
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS done,
  strftime(o_orderdate, '%Y-%m-%d') || ' 10:30:00.500000' AS "at",
  o_orderpriority AS _source_file
FROM orders"""

ORACLES = {
    "load_quoted_breaks": """
SELECT doc_id, lang, source, md5(coalesce(text, '')) AS text_md5,
  CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM documents""",
    "replace_by_source_twice": """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice ELSE o_totalprice + 1 END
  AS o_totalprice, o_orderpriority AS _source_file FROM orders""",
    "autoingest_wide": """
SELECT 'wide' AS table_name, COUNT(*) AS rows, CAST(SUM(s_suppkey + 2) AS BIGINT) AS first,
  CAST(SUM(s_suppkey + 201) AS DOUBLE) AS last FROM supplier
UNION ALL SELECT 'broken', COUNT(*), CAST(SUM(s_suppkey) AS BIGINT),
  CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) FROM supplier""",
    "autoingest_failures": """
WITH t AS (SELECT o_orderkey AS k FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderkey % 2 = 0
  UNION ALL SELECT 7 FROM orders WHERE o_orderpriority = '5-LOW'),
f AS (SELECT COUNT(*) AS rows, CAST(SUM(k) AS BIGINT) AS key_sum FROM t)
SELECT 'run-1' AS run_id, 'success' AS status, CAST(5 AS BIGINT) AS files, COUNT(*) AS loaded,
  any_value(rows) AS rows, any_value(key_sum) AS key_sum FROM orders, f
UNION ALL SELECT 'run-1', 'failed', 1, 0, rows, key_sum FROM f
UNION ALL SELECT 'run-2', 'success', 2, COUNT(*), any_value(rows), any_value(key_sum) FROM orders, f
  WHERE o_orderpriority = '5-LOW' OR (o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0)""",
    "sanitise_names": """
WITH raw AS (SELECT url FROM pages UNION ALL
  SELECT p_size || ' ' || p_name || ' # ' || p_brand FROM part),
core AS (SELECT trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') AS c FROM raw)
SELECT CASE WHEN regexp_matches(c, '^[a-z]') THEN c ELSE 'col_' || c END AS name, COUNT(*) AS n
FROM core GROUP BY 1""",
    "blank_to_null": r"""
WITH lines AS (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT lang, COUNT(*) AS lines,
  COUNT(*) FILTER (WHERE NOT regexp_matches(line, '^\s*$')) AS filled,
  CAST(SUM(length(line)) FILTER (WHERE NOT regexp_matches(line, '^\s*$')) AS BIGINT) AS characters
FROM lines GROUP BY lang""",
    "type_match_shares": f"""{_SHARES}
SELECT table_name, column_name, filled, b / filled AS boolean_share, i / filled AS integer_share,
  l / filled AS bigint_share, d / filled AS double_share, t / filled AS date_share,
  m / filled AS timestamp_share FROM shares""",
    "infer_schema_strings": f"""{_SHARES}
SELECT table_name, column_name, filled,
  CASE WHEN b / filled >= 0.9 THEN 'BOOLEAN' WHEN i / filled >= 0.9 THEN 'INTEGER'
       WHEN l / filled >= 0.9 THEN 'BIGINT' WHEN d / filled >= 0.9 THEN 'DOUBLE'
       WHEN t / filled >= 0.9 THEN 'DATE' WHEN m / filled >= 0.9 THEN 'TIMESTAMP(6)'
       ELSE 'VARCHAR' END AS type FROM shares""",
    "typed_load": _MESSY_SQL,
    "typed_load_rejects": """
SELECT 'id' AS column_name, CAST(0 AS BIGINT) AS rejected
UNION ALL SELECT 'price', COUNT(*) FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'day', COUNT(*) FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'done', COUNT(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'at', 0""",
    "detect_delimiter": """
WITH names AS (SELECT column_name, table_name, column_index FROM duckdb_columns()
  WHERE table_name IN ('orders', 'customer', 'part', 'supplier')),
delimiters AS (SELECT * FROM (VALUES ('orders', ','), ('customer', ';'), ('part', chr(9)),
  ('supplier', '|')) AS t(table_name, delimiter))
SELECT table_name, delimiter,
  replace(string_agg(column_name, ',' ORDER BY column_index), ',', delimiter) AS header
FROM names JOIN delimiters USING (table_name) GROUP BY table_name, delimiter""",
    "new_files_antijoin": """
SELECT o_custkey || '/' || o_orderkey AS key, o_orderstatus AS etag, o_orderpriority
FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority = '5-LOW'""",
    "replace_by_source": """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END
  AS o_totalprice, o_orderstatus, o_orderpriority AS _source_file
FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus = 'F'""",
    "autoingest_dir": """
SELECT 'orders_2024' AS table_name, 'success' AS status, 'run-1' AS run_id,
  COUNT(*) AS row_count, CAST(0 AS BIGINT) AS rejected, COUNT(*) AS rows,
  CAST(SUM(o_orderkey) AS BIGINT) AS key_sum,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS money,
  strftime(MAX(o_orderdate), '%Y-%m-%d') AS last_date FROM orders
UNION ALL SELECT 'customer', 'success', 'run-1', COUNT(*), 0, COUNT(*),
  CAST(SUM(c_custkey) AS BIGINT), CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), NULL
FROM customer""",
    "evolve_add_column": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey, o_orderstatus,
  o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders""",
    "evolve_reconcile": """
SELECT p_partkey, p_retailprice AS price, p_name AS label, p_brand, CAST(p_size AS BIGINT) AS p_size
FROM part""",
}
