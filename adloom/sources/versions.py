"""Versions of a table: a new one is written beside the one in use and takes its place at once.

In a folder a version is complete when its marker file is there, which is made when all data are; the
newest complete version is the table.  In the catalog a version is a table and the model a view of
the newest.  Either way a reader sees the old rows or the new ones, and a job that dies while it
writes leaves the old ones in use.  The version before stays until the next rebuild, for readers that
have begun with it.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

COMPLETE = "_COMPLETE"

# Complete versions that stay after a rebuild, and the age from which incomplete ones go.
KEPT = 2
ABANDONED_SECONDS = 7 * 24 * 3600

_FOLDER = re.compile(r"version-(\d{9})-[0-9a-f]{8}")
_TABLE = r"__version_(\d{9})_[0-9a-f]{8}"


@dataclass(frozen=True)
class FolderVersion:
    name: str
    complete: bool
    changed: float

    @property
    def number(self) -> int:
        return int(_FOLDER.fullmatch(self.name)[1])


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = _path(spark, path)
    files.delete(folder, True)


def folder_versions(spark: SparkSession, path: str) -> list[FolderVersion]:
    """All versions in a table's folder, the oldest first."""
    files, folder = _path(spark, path)
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and _FOLDER.fullmatch(name):
            done = files.exists(_path(spark, f"{path}/{name}/{COMPLETE}")[1])
            found.append(FolderVersion(name, done, status.getModificationTime() / 1000))
    return sorted(found, key=lambda v: v.name)


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the version in use; the path itself for a table that has no versions."""
    found = folder_versions(spark, path)
    complete = [version.name for version in found if version.complete]
    if found and not complete:
        raise FileNotFoundError(f"{path} has no complete version")
    return f"{path}/{complete[-1]}" if complete else path


@contextmanager
def new_folder_version(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write the next version to, which takes its place when the block ends.

    If the block fails, what it wrote is deleted and the table stays as it was.
    """
    number = max((v.number for v in folder_versions(spark, path)), default=0) + 1
    folder = f"{path}/version-{number:09d}-{uuid.uuid4().hex[:8]}"
    try:
        yield folder
        files, marker = _path(spark, f"{folder}/{COMPLETE}")
        files.create(marker, False).close()
    except BaseException:
        delete_folder(spark, folder)
        raise
    found = folder_versions(spark, path)
    old = [v for v in found if v.complete][:-KEPT]
    # Another job may be writing a version right now; one that died is older.
    old += [
        v for v in found if not v.complete and v.changed < time.time() - ABANDONED_SECONDS
    ]
    for version in old:
        delete_folder(spark, f"{path}/{version.name}")


def table_versions(spark: SparkSession, schema: str, model: str) -> list[str]:
    """Names of the catalog tables that hold versions of a model, the oldest first."""
    names = (row.tableName for row in spark.sql(f"SHOW TABLES IN {schema}").collect())
    return sorted(n for n in names if re.fullmatch(re.escape(model.lower()) + _TABLE, n.lower()))


@contextmanager
def new_table_version(spark: SparkSession, schema: str, model: str) -> Iterator[str]:
    """The name of a catalog table to write the next version to; then the model is a view of it."""
    before = table_versions(spark, schema, model)
    number = int(re.search(_TABLE, before[-1])[1]) + 1 if before else 1
    name = f"{schema}.{model}__version_{number:09d}_{uuid.uuid4().hex[:8]}".lower()
    try:
        yield name
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    view = f"{schema}.{model}"
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        # Written before there were versions.
        spark.sql(f"DROP TABLE {view}")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {name}")
    for old in table_versions(spark, schema, model)[:-KEPT]:
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{old}")
