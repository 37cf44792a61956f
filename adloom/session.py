"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024

REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.parser.escapedStringLiterals": "false",
    "spark.sql.adaptive.enabled": "true",
}

# Bytes one task should take: they fit in memory next to a sort or hash map.
TASK_BYTES = 256 * MIB

# A shuffle of Parquet rows takes about this many times the bytes of their files.
SHUFFLE_GROWTH = 3


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results and plans rely on.

    Days are UTC days, bad dates and overflows raise, column names ignore case, string literals
    have escapes.  Adaptive execution splits a hot day when a partitioned table is written.
    """
    for name, value in REQUIRED.items():
        spark.conf.set(name, value)
    return spark


def cluster_settings(
    input_bytes: int,
    shuffle_bytes: int | None = None,
    *,
    fewest_tasks: int = 200,
    most_tasks: int = 50_000,
) -> dict[str, str]:
    """Settings for a session by its largest input and largest shuffle.

    Start with enough partitions for the largest shuffle and let adaptive execution merge
    the small ones, so that one setting serves the raw tables and the small aggregates.  The driver
    keeps a size for every pair of map and reduce tasks; beyond ``most_tasks`` tasks grow instead,
    and spill.  A driver with more memory can have more of them.
    """
    if shuffle_bytes is None:
        shuffle_bytes = input_bytes
    partitions = min(most_tasks, max(fewest_tasks, -(-shuffle_bytes // TASK_BYTES)))
    split_bytes = max(TASK_BYTES, -(-input_bytes // most_tasks))
    return REQUIRED | {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }


def input_bytes(frames: Iterable[DataFrame]) -> int:
    """Bytes that Spark expects to scan for all frames, by the sizes of their files or tables."""
    plans = (frame._jdf.queryExecution().optimizedPlan() for frame in frames)
    return sum(int(str(plan.stats().sizeInBytes())) for plan in plans)


@contextmanager
def settings_for(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold within the block."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


# The temporary folder of each local session that names none.
_LOCAL_FOLDERS: dict[str, str] = {}


def working_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints and tables written on the way.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may go without:
    there every task sees the same disk, and a fresh temporary folder is made.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = context.getConf().get("spark.checkpoint.dir") or _LOCAL_FOLDERS.get(
            context.applicationId
        )
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="adloom-")
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the working folder."""
    return f"{working_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
