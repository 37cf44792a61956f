"""Schemas of single Parquet files, read by tasks from the files' footers.

Spark takes the schema of a folder from one of its files.  A file that lacks a column then reads as
NULL, and one with another type fails deep inside a scan; which of the two happens depends on the file
that Spark looked at.  Here every footer is looked at before a row is read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Deviating files that an error names.
NAMED_FILES = 5


def _footer(uri: str) -> T.StructType:
    """The schema of one Parquet file, as Spark would read it."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    files, path = fs.FileSystem.from_uri(uri)
    with files.open_input_file(path) as file:
        return from_arrow_schema(pq.read_schema(file))


def file_problems(
    spark: SparkSession, path: str, problem: Callable[[T.StructType], str | None]
) -> DataFrame:
    """Rows ``path, problem`` for all files under a path whose schemas have one.

    The files are listed and their footers read by tasks.  A file that cannot be read has a problem
    as well.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column("path").to_pylist():
                try:
                    wrong = problem(_footer(uri))
                except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
                    wrong = f"cannot be read: {error}"
                except PySparkException as error:
                    wrong = f"has a column of a type that Spark lacks: {error}"
                if wrong:
                    found.append((uri, wrong))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.string()) for k in range(2)],
                ["path", "problem"],
            )

    # Contents are not asked for, so they are not read.
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path").mapInArrow(look, "path string, problem string")


def require_files(
    spark: SparkSession, path: str, problem: Callable[[T.StructType], str | None], table: str
) -> None:
    """Raise if a file under the path has a problem, with the names of the first few."""
    # A few rows, whatever the number of files.
    wrong = file_problems(spark, path, problem).orderBy("path").take(NAMED_FILES)
    if wrong:
        files = "; ".join(f"{json.dumps(row.path)} {row.problem}" for row in wrong)
        raise ValueError(f"raw table {table} has deviating files: {files}")
