"""Result documents of check runs, and the messages for what failed.

A result document is one JSON object whose ``results`` array holds, per check or source, a
status and a dotted id.  Its size follows the number of checks, not the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.text import identifier, literal
from adloom.operators.checks import ERROR, FAIL, PASS
from adloom.sources.registry import SourceTable

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("status", T.StringType()),
                        T.StructField("unique_id", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

PROJECT = "adloom"


def result_document(results: DataFrame) -> DataFrame:
    """One row with all check results, ids as ``test.<project>.<check name>``."""
    unique_id = F.concat_ws(".", F.lit("test"), F.lit(PROJECT), F.col("check"))
    entry = F.struct(F.col("status"), unique_id.alias("unique_id"))
    return results.agg(F.collect_list(entry).alias("results"))


def source_results(
    raw: Mapping[str, DataFrame], sources: Iterable[SourceTable], stale_before: datetime
) -> DataFrame:
    """One row per source with a time column: its newest time, and ``error`` if that is too old.

    Each source is read once, its time column alone.  A source without any time is stale.
    """
    limit = f"TIMESTAMP{literal(stale_before.isoformat(sep=' '))}"
    parts = [
        raw[source.name.lower()]
        .selectExpr(f"max(CAST({identifier(source.time)} AS TIMESTAMP)) AS newest")
        .selectExpr(
            f"{literal(source.group)} AS source_group",
            f"{literal(source.name.lower())} AS table_name",
            "newest",
            f"IF(coalesce(newest < {limit}, true), {literal(ERROR)}, {literal(PASS)}) AS status",
        )
        for source in sources
        if source.time is not None
    ]
    return reduce(DataFrame.unionByName, parts)


def source_document(results: DataFrame) -> DataFrame:
    """One row with all source results, ids as ``source.<project>.<group>.<table>``."""
    unique_id = F.concat_ws(".", F.lit("source"), F.lit(PROJECT), "source_group", "table_name")
    entry = F.struct(F.col("status"), unique_id.alias("unique_id"))
    return results.agg(F.collect_list(entry).alias("results"))


def write_source_document(results: DataFrame, path: str) -> None:
    source_document(results).coalesce(1).write.mode("overwrite").json(path)


def write_document(results: DataFrame, path: str) -> None:
    result_document(results).coalesce(1).write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """Read a result document; a run that wrote none counts as one without results.

    A damaged document raises when it is read.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    try:
        document = reader.schema(DOCUMENT_SCHEMA).json(path)
        return document.withColumn(
            "results",
            F.coalesce("results", F.raise_error(F.lit(f"no results in {path}"))),
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DOCUMENT_SCHEMA)


def _messages(
    document: DataFrame, status: str, part: int, before_name: str, kind: str | None = None
) -> DataFrame:
    parts = F.split(F.col("unique_id"), r"\.")
    name: Column = parts[part]
    text = F.concat(F.lit(before_name), name)
    rows = document.select(F.inline("results")).where(F.col("status") == status)
    return (
        (rows if kind is None else rows.where(parts[0] == kind))
        .select(name.alias("check"), text.alias("message"))
    )


def failed_checks(document: DataFrame) -> DataFrame:
    """Name and message of every failed check; one that could not run is no failure."""
    return _messages(document, FAIL, 2, "Failure in test ")


def errored_checks(document: DataFrame) -> DataFrame:
    """Name and message of every check that could not run."""
    return _messages(document, ERROR, 2, "Error in test ", "test")


def stale_sources(document: DataFrame) -> DataFrame:
    """Name and message of every source whose freshness check reports an error."""
    return _messages(document, ERROR, 3, "Failure in test freshness of source ")
