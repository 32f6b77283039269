"""Databases and tables of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, path: str, partitions: list[str]
) -> None:
    """A Parquet table at ``path``, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    clause = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)}) " if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {clause}LOCATION '{path}'"
    )


def add_columns(spark: SparkSession, table: str, fields: list[T.StructField]) -> None:
    if fields:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def describe(spark: SparkSession, table: str) -> dict[str, str]:
    """Column name in lower case to type in upper case."""
    return {
        f.name.lower(): f.dataType.simpleString().upper() for f in spark.table(table).schema.fields
    }


def databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def user_tables(spark: SparkSession, database: str) -> list[str]:
    """Sorted table names; those with a leading underscore hold metadata and are left out."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return sorted(n for n in names if not n.startswith("_"))


def place(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def read_path(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet at a path. With a schema, columns that older files lack read as NULL."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
