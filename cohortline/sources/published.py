"""Tables that are replaced as a whole: versions under one path, and a pointer that is swapped last.

A writer fills a new version folder that no reader looks at, and publishes it by renaming a small pointer file
over the old one, which the file system does at once or not at all. A reader follows the pointer when it
opens the table and keeps its version. The version before the current one stays for readers that have it
open; the one before that is removed. A path without a pointer is an ordinary table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    """(package, folder, file system) of a path."""
    package = spark._jvm.org.apache.hadoop.fs
    folder = package.Path(path)
    return package, folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the current version and the one before it, as far as there are any."""
    package, folder, files = _hadoop(spark, path)
    pointer = package.Path(folder, POINTER)
    if not files.exists(pointer):
        return []
    java = spark._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(files.open(pointer), "UTF-8"))
    try:
        return reader.readLine().split(" ")
    finally:
        reader.close()


def exists(spark: SparkSession, path: str) -> bool:
    _, folder, files = _hadoop(spark, path)
    return bool(versions(spark, path)) or (
        files.exists(folder) and any(not s.getPath().getName().startswith(("_", ".", "version-"))
                                     for s in files.listStatus(folder)))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now."""
    known = versions(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/{known[0]}" if known else path)


def new_version(path: str) -> str:
    """Where a writer may put the next version."""
    return f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a written version the current one."""
    package, folder, files = _hadoop(spark, path)
    before = versions(spark, path)
    name = version.rpartition("/")[2]
    draft = package.Path(folder, f"_draft-{uuid.uuid4().hex}")
    out = files.create(draft)
    out.writeBytes(" ".join([name, *before[:1]]))
    out.close()
    kind = getattr(package, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    package.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration()).rename(
        files.makeQualified(draft), files.makeQualified(package.Path(folder, POINTER)), overwrite)
    for old in before[1:]:
        files.delete(package.Path(folder, old), True)
