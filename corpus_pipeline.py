"""The corpus pipeline: quality rules, near duplicates, personal data, mixing, packing.

Each stage takes the documents that the one before it kept and returns documents; the last returns
the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import jaccard, mixing, packing, pii, quality
from adloom.llm.common import drop_saved, prepare, saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near duplicates share four fifths of their five-word shingles; op2's rule is a contract of its own.
NEAR_DUPLICATES = jaccard.JaccardRule(width=5, percent=80)


# Python workers outlive a stage, next to a heap that is full by then.  What they free goes back to
# the system at once, instead of staying with them until the next stage; other settings win.
LEAN_WORKERS = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
}
BATCH_ROWS = 1000


def _prepare(spark: SparkSession) -> None:
    prepare(spark)
    environment = spark.sparkContext.environment
    environment.update({name: value for name, value in LEAN_WORKERS.items() if name not in environment})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def _measured(docs: DataFrame) -> DataFrame:
    """Bring the length column up to date with the texts."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rules and their host's verdict let pass."""
    _prepare(spark)
    return quality.good_documents(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of similar ones, that with the least id; rows without id stay."""
    _prepare(spark)
    return jaccard.one_of_each_group(docs, NEAR_DUPLICATES)


def without_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    _prepare(spark)
    return _measured(pii.redacted(docs))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents repeated and cut so that every source comes to its target of words."""
    _prepare(spark)
    return _measured(mixing.mixed_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    _prepare(spark)
    return packing.pack_documents(docs, packing.PackRule.from_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("pii", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

# SQL can express neither the learned redaction nor the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, folder, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, folder), f"pipeline-{name}")
        if before is not None:
            drop_saved(before)
        before = docs
    return STAGES[-1][1](spark, docs, folder)
