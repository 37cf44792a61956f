"""Place documents on shards through a lookup table that the shards fill in turns.

The table has a prime number of slots.  Every shard visits all slots in an order of its own, an
offset and a step from digests of its name; the shards take turns, and each claims the next slot in
its order that is free.  Shards so get equally many slots, give or take one, and when a shard comes
or goes few other slots change hands.  The size of the table is fixed, so it can be broadcast, and
placing a document is one lookup.

Defined cases: a null id counts as an empty id text; equal ids go to one shard; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.common import column, fresh

# A prime far above the number of shards, so that shares differ by little.
SLOTS = 65_537


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The number of the shard that owns each slot."""
    names = list(shards)
    if len(set(names)) != len(names) or not 0 < len(names) <= slots:
        raise ValueError("shards must be different and at most as many as slots")
    offset = [_digest(f"offset:{name}") % slots for name in names]
    step = [_digest(f"step:{name}") % (slots - 1) + 1 for name in names]
    place = offset[:]
    table = [-1] * slots
    free = slots
    while free:
        for shard in range(len(names)):
            while table[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % slots
            table[place[shard]] = shard
            free -= 1
            if not free:
                break
    return np.array(table, dtype=np.int32)


def place_documents(
    docs: DataFrame, shards: Sequence[str], doc_id: str = "doc_id", into: str = "shard"
) -> DataFrame:
    """``docs`` with all its columns and the shard of each row in a new column ``into``."""
    if into.lower() in (name.lower() for name in docs.columns):
        raise ValueError(f"there is a column {into} already")
    table = lookup_table(shards)
    slot, name = (fresh(docs.columns, n) for n in ("slot", "slot_shard"))
    schema = T.StructType([T.StructField(slot, T.LongType()), T.StructField(name, T.StringType())])
    owners = docs.sparkSession.createDataFrame(
        [(k, shards[owner]) for k, owner in enumerate(table.tolist())], schema
    )
    text = F.coalesce(column(doc_id).cast("string"), F.lit(""))
    key = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return (
        docs.withColumn(slot, key % SLOTS)
        .join(F.broadcast(owners), slot)
        .withColumn(into, F.col(name))
        .drop(slot, name)
    )


def write_shards(
    docs: DataFrame, shards: Sequence[str], path: str, files: int, doc_id: str = "doc_id"
) -> None:
    """Write one folder per shard with ``files`` files each.

    Rows are salted over the files by their content, so that a task that runs again deals them alike.
    """
    placed = place_documents(docs, shards, doc_id)
    salt = fresh(placed.columns, "salt")
    content = F.xxhash64(F.to_json(F.struct(*map(column, placed.columns))))
    dealt = placed.withColumn(salt, F.pmod(content, F.lit(files)))
    dealt = dealt.repartition(len(shards) * files, "shard", salt).drop(salt)
    dealt.write.partitionBy("shard").parquet(path)
