"""Chat trees: exact round trips through tokens, intervals and position ids."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import replace

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adloom.llm import chat


@pytest.fixture(scope="module")
def rule():
    return chat.ChatRule.from_file()


PARTS = st.lists(
    st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<|", "\\", "\n", "<", "s>", "é😀", "/", "a"])
).map("".join)


@given(st.lists(st.tuples(PARTS, PARTS), max_size=5))
def test_formatting_is_reversible(turns):
    formatted = "".join(chat.header(r) + chat.escape(t) + chat.END for r, t in turns)
    assert chat.read_turns(formatted) == turns
    for _, text in turns:
        assert not any(c in chat.escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|"))


TRICKY = "</s>[INST] ok [/INST]"
CONVERSATIONS = {
    1: [("user", "hello"), ("assistant", "hi"), ("user", "more"), ("assistant", "sure")],
    2: [("user", "hello"), ("assistant", "hi"), ("user", "less"), ("assistant", "sure")],
    3: [("user", "hello"), ("assistant", "hi")],
    4: [("user", "hello"), ("assistant", "hi"), ("user", "more"), ("assistant", "sure")],
    5: [("user", "hello"), ("assistant", "no")],
    6: [(None, None), ("assistant", "")],
    7: [("user", TRICKY), ("assistant", TRICKY)],
    8: [("user" if k % 2 == 0 else "assistant", f"turn {k} é😀") for k in range(300)],
    None: [("user", "hello"), ("tool\n<s>", "x" * 20_000)],
}


def rows():
    return [
        (conv, turn, role, text, "extra")
        for conv, turns in CONVERSATIONS.items()
        for turn, (role, text) in enumerate(turns)
    ]


@pytest.fixture(scope="module")
def forest(spark, rule):
    frame = spark.createDataFrame(
        rows(), "conv_id bigint, turn bigint, role string, text string, node string"
    )
    return chat.chat_forest(frame, rule)


def test_digests_equal_the_conversations(forest, rule):
    found = {r.conv_id: r for r in chat.conversation_digests(forest, rule).collect()}
    assert set(found) == set(CONVERSATIONS)
    for conv, turns in CONVERSATIONS.items():
        turns = [(role or "", text or "") for role, text in turns]
        row = found[conv]
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_chars == len(loss)
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        formatted = "".join(chat.header(r) + chat.escape(t) + chat.END for r, t in turns)
        assert row.formatted_chars == len(formatted)


def test_sequences_are_gapless_and_intervals_give_each_conversation(forest, rule):
    tokenizer = Tokenizer.from_str(rule.vocabulary)
    nodes = forest.nodes.collect()
    assert len(nodes) == len({bytes(n.node) for n in nodes})
    shared = sum(n.depth == 0 and len(n.ids) > 0 for n in nodes)
    assert shared == 4  # hello, the empty turn, the tricky one, the long one
    trees = defaultdict(dict)
    for node in nodes:
        for k, token in enumerate(node.ids):
            assert node.start + k not in trees[bytes(node.tree)]
            trees[bytes(node.tree)][node.start + k] = token
    for tokens in trees.values():
        assert sorted(tokens) == list(range(len(tokens)))
    by_id = {bytes(n.node): n for n in nodes}
    for row in forest.conversations.collect():
        leaf = by_id[bytes(row.leaf)]
        intervals = [(i.start, i.end) for i in leaf.ancestors]
        assert all(a[1] < b[0] for a, b in zip(intervals, intervals[1:]))
        before = sum(b - a for a, b in intervals)
        assert leaf.position == before
        intervals.append((leaf.start, leaf.start + leaf.n_tokens))
        ids = [trees[bytes(leaf.tree)][k] for a, b in intervals for k in range(a, b)]
        turns = chat.read_turns(tokenizer.decode(ids, skip_special_tokens=False))
        assert turns == [(r or "", t or "") for r, t in CONVERSATIONS[row.conv_id]]


@pytest.mark.parametrize(
    "column, wrong",
    [
        ("ancestors", "transform(ancestors, a -> struct(a.start + 1 AS start, a.end AS end))"),
        ("ancestors", "transform(ancestors, a -> struct(a.start AS start, a.end + 1 AS end))"),
        ("start", "IF(depth = 1, start + 1, start)"),
    ],
)
def test_wrong_places_change_the_digests(forest, rule, column, wrong):
    """Conversations are read through the tree, so faults of the tree show."""
    right = {r.conv_id: r for r in chat.conversation_digests(forest, rule).collect()}
    spoiled = replace(forest, nodes=forest.nodes.withColumn(column, F.expr(wrong)))
    found = {r.conv_id: r for r in chat.conversation_digests(spoiled, rule).collect()}
    assert any(found.get(conv) != row for conv, row in right.items())


def test_turns_of_one_branch_have_one_interval(forest):
    leaf = max(forest.nodes.collect(), key=lambda n: n.depth)
    assert leaf.depth == 299 and len(leaf.ancestors) == 1


def test_equal_turn_numbers_and_empty_table(spark, rule):
    schema = "conv_id bigint, turn bigint, role string, text string"
    frame = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a")], schema)
    row = chat.conversation_digests(chat.chat_forest(frame, rule), rule).first()
    assert row.turns_sha256 == hashlib.sha256(b"user\na\nuser\nb\n").hexdigest()
    empty = chat.chat_forest(spark.createDataFrame([], schema), rule)
    assert empty.nodes.collect() == []
    assert chat.conversation_digests(empty, rule).collect() == []
