"""Packing: exact ids, whole and gapless sequences, few of them."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adloom.llm import packing

import pyarrow as pa


@pytest.fixture(scope="module")
def rule():
    return packing.PackRule.from_file()


@pytest.fixture(scope="module")
def tokenizer(rule):
    return Tokenizer.from_str(rule.vocabulary)


ODD = list("abzAZé ÉßİΣςσ'’.,;-0123٣ｱ漢́ \u0085\x1c😀ﬁŉ<|>\n\tक़") + [
    "'s", "'re", "<|endoftext|>", "<|ENDOFTEXT|>",
]


def test_ids_of_words_are_those_of_texts(rule, tokenizer):
    chance = random.Random(5)
    texts = ["".join(chance.choices(ODD, k=chance.randint(0, 25))) for _ in range(3000)]
    memory = packing.word_ids(rule.vocabulary)
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        ids, bounds = packing.text_ids(memory, pa.array(some))
        for k, text in enumerate(some):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert ids[bounds[k] : bounds[k + 1]].tolist() == expected, text


def unpacked(counts: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int]]]:
    """Place all pieces by the runs and check that sequences are gapless and not too long."""
    runs = packing.packing_runs(counts, capacity)
    by_length = defaultdict(list)
    for length, first, sequence, offset in runs.tolist():
        by_length[length].append((first, sequence, offset))
    sequences = defaultdict(list)
    for length, n in counts.items():
        own = sorted(by_length[length])
        assert own[0][0] == 0
        for (first, sequence, offset), following in zip(own, [*own[1:], (n, 0, 0)]):
            for k in range(following[0] - first):
                sequences[sequence + k].append((offset, length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert sum(map(len, sequences.values())) == sum(counts.values())
    return sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 30), min_size=1))
def test_runs_fill_gapless_sequences(counts):
    sequences = unpacked(counts, 24)
    halves = sum(n for length, n in counts.items() if length > 12)
    least = max(halves, -(-sum(length * n for length, n in counts.items()) // 24))
    assert least <= len(sequences) <= 1.5 * least + 1


def test_large_pieces_pair_at_most_twice_and_small_ones_fill_gaps():
    sequences = unpacked({13: 2, 10: 2, 1: 2}, 24)
    assert sorted(sorted(n for _, n in s) for s in sequences.values()) == [[1, 10, 13]] * 2


def test_pieces_of_documents(spark, rule, tokenizer):
    long = "Word, word. " * 6000
    rows = [(1, "One two", "x"), (1, "One two", "x"), (2, None, "y"), (None, "", "z"), (3, long, "l")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    found = packing.pack_documents(frame, rule, with_ids=True).collect()
    by_doc = defaultdict(list)
    for row in found:
        by_doc[row.doc_id].append(row)
    for doc_id, text in ((1, "One two"), (2, ""), (None, ""), (3, long)):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, rule.end_id]
        copies = 2 if doc_id == 1 else 1
        for piece, start in enumerate(range(0, len(ids), 4096)):
            some = ids[start : start + 4096]
            same = [r for r in by_doc[doc_id] if r.piece == piece]
            assert len(same) == copies
            for row in same:
                assert (row.start, row.length, row.ids) == (start, len(some), some)
                assert row.ids_crc32 == zlib.crc32(np.array(some, "<u4").tobytes())
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 4096


def test_empty_table(spark, rule):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(frame, rule).collect() == []
