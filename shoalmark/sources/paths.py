"""Small file operations on whatever file system a path belongs to (through Hadoop's client)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _client(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _client(spark, path)
    return fs.exists(jpath)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, the way file listings show it."""
    fs, jpath = _client(spark, path)
    return fs.makeQualified(jpath).toString()


def children(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the direct children; empty when the folder is absent."""
    fs, jpath = _client(spark, path)
    if not fs.exists(jpath):
        return []
    return [status.getPath().toString() for status in fs.listStatus(jpath)]


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change (milliseconds) of all files in a folder and its subfolders."""
    fs, jpath = _client(spark, path)
    if not fs.getFileStatus(jpath).isDirectory():
        return []
    found, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return found


def remove(spark: SparkSession, path: str) -> bool:
    fs, jpath = _client(spark, path)
    return fs.delete(jpath, True)


def remove_if_empty(spark: SparkSession, path: str) -> None:
    """Remove a folder that holds nothing but hidden files."""
    left = [c for c in children(spark, path) if c.rsplit("/", 1)[1][:1] not in "._"]
    if not left:
        remove(spark, path)


def remove_empty(spark: SparkSession, path: str) -> None:
    """Remove a folder; one that has got a child in the meantime stays."""
    fs, jpath = _client(spark, path)
    try:
        fs.delete(jpath, False)
    except Exception:
        if not children(spark, path):
            raise


def changed_at(spark: SparkSession, path: str) -> int:
    """Time of change in milliseconds."""
    fs, jpath = _client(spark, path)
    return fs.getFileStatus(jpath).getModificationTime()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _client(spark, path)
    fs.mkdirs(jpath)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, jsource = _client(spark, source)
    if not fs.rename(jsource, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")
