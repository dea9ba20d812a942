"""Tables that are replaced as a whole under one name: versions side by side and a pointer to the current one.

A new version is written to a folder of its own. Only then does the pointer, a small file, move to it in one rename
that replaces the old one. Whoever reads before sees the old version whole, whoever reads after sees the new one, and
a writer that dies leaves the old one in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from runwaylens.sources.scratch import remove

POINTER = "_current"


class ChangedMeanwhile(RuntimeError):
    """Another writer replaced the table after this one had read it."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _context(spark: SparkSession, path: str):
    uri = _files(spark, path).makeQualified(_path(spark, path)).toUri()
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, table: str) -> str | None:
    """Name of the version that the pointer names, None where there is no versioned table."""
    pointer = f"{table.rstrip('/')}/{POINTER}"
    files = _files(spark, table)
    if not files.exists(_path(spark, pointer)):
        return None
    stream = files.open(_path(spark, pointer))
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def current_path(spark: SparkSession, table: str) -> str:
    """Where the rows of a table are: its current version, or the path itself for a plain file or folder."""
    version = current_version(spark, table)
    return f"{table.rstrip('/')}/{version}" if version else table


def _point_to(spark: SparkSession, table: str, version: str) -> None:
    draft = f"{table}/{POINTER}-{uuid.uuid4().hex}"
    stream = _files(spark, table).create(_path(spark, draft))
    stream.write(bytearray(version.encode()))
    stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options
    kinds = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    kinds[0] = getattr(options, "Rename").OVERWRITE
    _context(spark, table).rename(_path(spark, draft), _path(spark, f"{table}/{POINTER}"), kinds)


def replace_table(
    spark: SparkSession, table: str, rows: DataFrame, write: Callable[[DataFrame, str], None], read_from: str | None = None
) -> str:
    """Make ``rows`` the next version of ``table`` and return its folder.

    ``rows`` may be made from the current version. ``read_from`` is the version that they are made from (None: none);
    where the table has moved on since, nothing is replaced and ChangedMeanwhile is raised. A plain file or folder
    in the place of the table is an error. Versions before the last two are removed.
    """
    table = table.rstrip("/")
    files = _files(spark, table)
    if files.exists(_path(spark, table)) and current_version(spark, table) is None and _listed(files, _path(spark, table)):
        raise ValueError(f"{table} is no versioned table")
    version = f"v-{uuid.uuid4().hex}"
    write(rows, f"{table}/{version}")
    if current_version(spark, table) != read_from:
        remove(spark, f"{table}/{version}")
        raise ChangedMeanwhile(f"{table} was replaced after it had been read")
    _point_to(spark, table, version)
    _tidy(spark, table, {version, read_from})
    return f"{table}/{version}"


def _listed(files, path) -> list:
    """Names in a folder, or the path itself for a file, without unfinished versions."""
    if not files.getFileStatus(path).isDirectory():
        return [path.getName()]
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return [n for n in names if not n.startswith(("v-", f"{POINTER}-", "."))]


def _tidy(spark: SparkSession, table: str, kept: set[str | None]) -> None:
    """Remove versions that are neither the current one nor the one before it."""
    files = _files(spark, table)
    for status in files.listStatus(_path(spark, table)):
        name = status.getPath().getName()
        if name.startswith(("v-", f"{POINTER}-")) and name not in kept:
            remove(spark, f"{table}/{name}")
