"""Helpers that the operators share: session settings, words, tables written on the way."""

from __future__ import annotations

import os
from collections.abc import Iterable
from pathlib import Path
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import session

# One word: a run of anything but ASCII white space.  The same class splits ``bytes``.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\f\r"

# Rows of texts that one Arrow batch holds, so that a batch of long texts fits in memory.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and small Arrow batches because texts can be long.

    Python workers on this machine find the package where the driver did; a cluster gets it with
    ``--py-files`` or has it installed.
    """
    session.prepare(spark)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


# Where each frame that ``saved`` returned has its files.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def saved(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared working folder and read it back, which cuts its lineage."""
    spark = frame.sparkSession
    folder = session.new_folder(spark, purpose)
    frame.write.parquet(folder)
    read = spark.read.schema(frame.schema).parquet(folder)
    _FOLDERS[read] = folder
    return read


def drop_saved(*frames: DataFrame) -> None:
    """Delete the files of frames that ``saved`` returned and nothing reads any more."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(frame))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name that is not taken, by adding underscores."""
    known = {column.lower() for column in taken}
    while name.lower() in known:
        name += "_"
    return name


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, pa.Array]:
    """All words of a batch of texts in a row, and where each text's words begin and end.

    Words are split at ASCII white space; ``lower`` lower-cases A-Z.  A null text has no words.
    """
    # Trimming makes a new array; lower-casing a slice of one gives wrong texts in some versions.
    texts = pc.ascii_trim_whitespace(texts.cast(pa.large_string()))
    if lower:
        texts = pc.ascii_lower(texts)
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), None, texts)
    lists = pc.ascii_split_whitespace(texts)
    bounds = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0))))
    return bounds.astype(np.int64), lists.flatten()


def distinct_words(flat: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """The place of each word in the list of different words, and that list."""
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary()).to_pylist()


def vocabulary_path(name: str) -> str:
    """Where the driver finds a public vocabulary; its content is what is sent to the tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)
