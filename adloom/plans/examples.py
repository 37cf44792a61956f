"""Starter models: two literal rows, and a filter on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXAMPLE_SCHEMA = T.StructType([T.StructField("id", T.IntegerType())])


def example_first(spark: SparkSession) -> DataFrame:
    """Rows 1 and NULL; the NULL is there for the not-null check to find."""
    row = spark.range(0, 1, 1, 1)
    one = row.selectExpr("1 AS id")
    unknown = row.selectExpr("CAST(NULL AS INT) AS id")
    return one.unionByName(unknown)


def example_second(first: DataFrame) -> DataFrame:
    return first.where(F.col("id") == 1)
