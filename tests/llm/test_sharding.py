"""Sharding: shares, stability and placement."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from adloom.llm import sharding

SHARDS = [f"s{k}" for k in range(20)]


def test_shares_differ_by_one_slot_and_few_slots_move():
    table = sharding.lookup_table(SHARDS)
    counts = Counter(table.tolist())
    assert len(table) == sharding.SLOTS and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(SHARDS[:-1])
    stayed = sum(a == b for a, b in zip(table, fewer) if a != 19)
    assert stayed > 0.9 * sum(counts[k] for k in range(19))


def test_small_table_by_hand():
    def digest(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    names, slots = ["a", "b", "c"], 7
    orders = [
        [(digest(f"offset:{n}") + k * (digest(f"step:{n}") % 6 + 1)) % slots for k in range(slots)]
        for n in names
    ]
    owner: dict[int, int] = {}
    while len(owner) < slots:
        for shard, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(s for s in order if s not in owner)] = shard
    assert sharding.lookup_table(names, slots).tolist() == [owner[k] for k in range(slots)]


def test_wrong_shards_are_refused():
    for shards in ([], ["a", "a"], [str(k) for k in range(8)]):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, 7)


def test_every_row_is_placed_by_its_id(spark, tmp_path):
    rows = [(k, "x", k) for k in range(3000)] + [(5, "y", 1), (None, "z", 2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, slot string, slot_shard int")
    placed = sharding.place_documents(frame, SHARDS)
    assert placed.columns == [*frame.columns, "shard"]
    found = placed.collect()
    assert len(found) == len(rows)
    table = sharding.lookup_table(SHARDS)
    for row in found:
        text = "" if row.doc_id is None else str(row.doc_id)
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert row.shard == SHARDS[table[slot]]
    sharding.write_shards(frame, SHARDS, str(tmp_path / "out"), files=2)
    again = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.shard) for r in again.collect()) == Counter(
        (r.doc_id, r.shard) for r in found
    )
    with pytest.raises(ValueError):
        sharding.place_documents(placed, SHARDS)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint")
    assert sharding.place_documents(frame, SHARDS).collect() == []
