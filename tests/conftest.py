from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adloom.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.checkpoint.dir", str(checkpoints))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before: dict[str, str | None] = {}

    def change(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate a SQL expression over ``x`` for some values, in order."""

    def evaluate(sql: str, values: list, dtype: str = "string") -> list:
        rows = list(enumerate(values))
        frame = spark.createDataFrame(rows, f"i int, x {dtype}").selectExpr("i", f"{sql} AS y")
        return [row.y for row in sorted(frame.collect())]

    return evaluate
