"""Format conversations as chat text and merge those that share their first turns into trees.

Every turn becomes ``<s>role\\ntext</s>``.  Inside roles and texts a backslash follows the first
character of any control string, and backslashes are doubled, so that the formatted text can be
read back exactly whatever the texts hold.

Conversations with the same first turn form a tree whose nodes are turns; turns with equal paths
from the root are one node.  A tree is one token sequence, written depth first: ``start`` is the
place of a node's first token in it, ``position`` that token's position id, which goes on from the
node's parent, and ``ancestors`` are the intervals of the sequence that the node's tokens attend
to besides the node itself.  Intervals that touch are one, so a long conversation without branches
has few.

Trees are never held as a whole.  A conversation's path is a row of digests, each of the turns so
far; sorted by path, the conversations through a node stand side by side.  The first
of them owns the node.  Tokens that a conversation owns follow those of the conversations before
it, so places are sums over sorted ranges.

Defined cases: a null text or role is empty; turns with equal numbers are ordered by role and text;
a null conversation id is one conversation; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adloom.llm.common import column, drop_saved, saved, vocabulary_path

BEGIN, END = "<s>", "</s>"

# No control string may stand in a text as it is: the template's own, [INST], [/INST] and <|.
_ESCAPE = re.compile(r"\\|<(?=/?s>|\|)|\[(?=/?INST\])")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n(.*?)</s>", re.DOTALL)

NODE_BYTES = 16

# Tokens of a tree's sequence that make one join key when intervals are read back.
STRETCH = 1024


@dataclass(frozen=True)
class ChatRule:
    """``vocabulary`` is the content of a byte-level tokenizer file; ``learned`` is the role whose
    texts are under the loss mask."""

    vocabulary: str
    learned: str = "assistant"

    @staticmethod
    def from_file(path: str | None = None) -> ChatRule:
        with open(path or vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as file:
            return ChatRule(file.read())


@dataclass(frozen=True)
class ChatForest:
    """``nodes``: the turns of all trees, each once, with their tokens and attention intervals.
    ``paths``: for every different conversation (``leaf``) its nodes by depth.
    ``conversations``: the leaf of each conversation."""

    nodes: DataFrame
    paths: DataFrame
    conversations: DataFrame


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda found: found[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda found: found[1], text)


def header(role: str) -> str:
    return BEGIN + escape(role).replace("\n", "\\\n") + "\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns, the inverse of formatting."""
    return [(unescape(found[1]), unescape(found[2])) for found in _TURN.finditer(formatted)]


def _formatted_turns(turns: DataFrame) -> DataFrame:
    """One row per turn with its node, a digest of the path to it; the last has the whole path."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        conversation, digest, path, depth = None, b"", [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = ["conversation", "depth", "node", "role", "text", "path"]
            types = [pa.string(), pa.int64(), pa.binary(), pa.string(), pa.string(), pa.binary()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names
            )

        for batch in batches:
            rows = []
            for name, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held and name != conversation:
                    rows.append((*held, b"".join(path)))
                    held = None
                elif held:
                    rows.append((*held, None))
                if name != conversation:
                    conversation, digest, path, depth = name, b"", [], 0
                turn = f"{header(role)}{escape(text)}{END}".encode()
                digest = hashlib.blake2b(digest + turn, digest_size=NODE_BYTES).digest()
                path.append(digest)
                held = (name, depth, digest, role, text)
                depth += 1
            yield batch_of(rows)
        if held:
            yield batch_of([(*held, b"".join(path))])

    ordered = (
        turns.select("conversation", "role", "text", "turn")
        .repartition("conversation")
        .sortWithinPartitions("conversation", "turn", "role", "text")
        .select("conversation", "role", "text")
    )
    return ordered.mapInArrow(
        chain,
        "conversation string, depth bigint, node binary, role string, text string, path binary",
    )


def _tokenizer(vocabulary: str) -> Tokenizer:
    """The tokenizer on one thread: Spark's tasks are the threads, and more cost more than they do."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _tokenized(nodes: DataFrame, rule: ChatRule) -> DataFrame:
    """Add the tokens of each node: those of its header, its text and its end in a row."""
    shared = nodes.sparkSession.sparkContext.broadcast(rule.vocabulary)
    learned = rule.learned

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value)

        def ids(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

        end = ids([END])[0]
        headers: dict[str, list[int]] = {}
        for batch in batches:
            roles = batch.column("role").to_pylist()
            bodies = ids([escape(text) for text in batch.column("text").to_pylist()])
            tokens, loss_from, loss_to = [], [], []
            for role, body in zip(roles, bodies):
                head = headers.get(role)
                if head is None:
                    head = headers[role] = ids([header(role)])[0]
                tokens.append([*head, *body, *end])
                loss_from.append(len(head))
                loss_to.append(len(head) + (len(body) if role == learned else 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("depth"),
                    pa.array(tokens, pa.list_(pa.int32())),
                    pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array(loss_from, pa.int32()),
                    pa.array(loss_to, pa.int32()),
                ],
                ["node", "depth", "ids", "n_tokens", "loss_from", "loss_to"],
            )

    return nodes.mapInArrow(
        encode,
        "node binary, depth bigint, ids array<int>, n_tokens bigint, loss_from int, loss_to int",
    )


def _sorted_paths(leaves: DataFrame) -> DataFrame:
    """Rank the different conversations by path, and list their nodes.

    Ranks are the range and the place in it; ranges follow each other in the order of paths.
    """

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for path in batch.column(0).to_pylist():
                nodes = [path[k : k + NODE_BYTES] for k in range(0, len(path), NODE_BYTES)]
                columns[0] += [place] * len(nodes)
                columns[1] += [nodes[0]] * len(nodes)
                columns[2] += range(len(nodes))
                columns[3] += nodes
                place += 1
            types = [pa.int64(), pa.binary(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["rank", "tree", "depth", "node"]
            )

    ordered = leaves.select("path").repartitionByRange("path").sortWithinPartitions("path")
    return ordered.mapInArrow(rank, "rank bigint, tree binary, depth bigint, node binary")


def _with_ancestors(steps: DataFrame) -> DataFrame:
    """For the nodes a conversation owns, the intervals of the tokens before them on its path."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, intervals = None, []
        for batch in batches:
            nodes, found = [], []
            for own, node, owner, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                if own != rank:
                    rank, intervals = own, []
                if owner == rank:
                    nodes.append(node)
                    found.append([{"start": a, "end": b} for a, b in intervals])
                if intervals and intervals[-1][1] == start:
                    intervals[-1] = (intervals[-1][0], start + n)
                else:
                    intervals.append((start, start + n))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(found, kind)], ["node", "ancestors"]
            )

    ordered = (
        steps.select("rank", "depth", "node", "owner", "start", "n_tokens")
        .repartition("rank")
        .sortWithinPartitions("rank", "depth")
        .select("rank", "node", "owner", "start", "n_tokens")
    )
    return ordered.mapInArrow(
        walk, "node binary, ancestors array<struct<start: bigint, end: bigint>>"
    )


def chat_forest(
    conversations: DataFrame,
    rule: ChatRule,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> ChatForest:
    """Format and merge conversations; see the module's text for the columns."""
    turns = conversations.select(
        F.coalesce(F.concat(F.lit("s"), column(conv_id).cast("string")), F.lit("n")).alias(
            "conversation"
        ),
        column(turn).alias("turn"),
        F.coalesce(column(role), F.lit("")).alias("role"),
        F.coalesce(column(text), F.lit("")).alias("text"),
    )
    formatted = saved(_formatted_turns(turns), "chat-turns")
    different = formatted.groupBy("node").agg(
        F.first("depth").alias("depth"), F.first("role").alias("role"), F.first("text").alias("text")
    )
    tokens = saved(_tokenized(different, rule), "chat-tokens")
    ends = formatted.where("path IS NOT NULL")
    leaves = ends.groupBy("node").agg(F.first("path").alias("path"))
    paths = saved(_sorted_paths(leaves), "chat-paths")

    owners = paths.groupBy("node").agg(F.min("rank").alias("owner"))
    known = saved(tokens.select("node", "n_tokens").join(owners, "node"), "chat-owners")
    by_rank = "OVER (PARTITION BY rank ORDER BY depth)"
    steps = saved(
        paths.join(known, "node").selectExpr(
            "*", f"sum(n_tokens) {by_rank} - n_tokens AS position"
        ),
        "chat-steps",
    )
    # Tokens each conversation owns, summed over those before it: by range, then within the range.
    owned = steps.groupBy("tree", "rank").agg(
        F.sum(F.expr("IF(owner = rank, n_tokens, 0)")).alias("owned"),
        F.min(F.expr("IF(owner = rank, position, NULL)")).alias("first_position"),
    ).withColumn("range", F.shiftright("rank", 40))
    ranges = owned.groupBy("tree", "range").agg(F.sum("owned").alias("range_owned"))
    ranges = ranges.selectExpr(
        "tree",
        "range",
        "sum(range_owned) OVER (PARTITION BY tree ORDER BY range) - range_owned AS before",
    )
    starts = owned.join(ranges, ["tree", "range"]).selectExpr(
        "rank AS owner",
        "before + sum(owned) OVER (PARTITION BY tree, range ORDER BY rank) - owned"
        " - first_position AS shift",
    )
    placed = saved(
        steps.where("owner = rank")
        .join(starts, "owner")
        .selectExpr("node", "tree", "position + shift AS start", "position"),
        "chat-places",
    )
    ancestors = _with_ancestors(steps.join(placed.select("node", "start"), "node"))
    nodes = saved(
        placed.join(tokens, "node").join(ancestors, "node"), "chat-nodes"
    )
    drop_saved(tokens, known, steps, placed)
    return ChatForest(
        nodes,
        paths.select("rank", "depth", "node"),
        ends.select(
            F.when(
                F.col("conversation") != "n", F.expr("substr(conversation, 2)")
            ).cast(conversations.schema[conv_id].dataType).alias(conv_id),
            F.col("node").alias("leaf"),
        ),
    )


def _attended(forest: ChatForest) -> DataFrame:
    """The tokens that the last node of every different conversation attends to, and its own.

    They are found by their places in the tree's sequence alone.  Sequences are cut into stretches,
    so that a long interval and a tree that many conversations share spread over many keys.
    """
    places = forest.nodes.select(
        F.col("node").alias("leaf"),
        "tree",
        F.expr(
            "concat(ancestors, array(named_struct('start', start, 'end', start + n_tokens)))"
        ).alias("spans"),
    )
    stretches = (
        forest.conversations.select("leaf")
        .distinct()
        .join(places, "leaf")
        .select("leaf", "tree", F.explode("spans").alias("span"))
        .selectExpr(
            "leaf",
            "tree",
            "span.start AS begin",
            "span.end AS end",
            f"explode(sequence(span.start DIV {STRETCH}, (span.end - 1) DIV {STRETCH})) AS stretch",
        )
    )
    tokens = forest.nodes.selectExpr(
        "tree", f"start DIV {STRETCH} AS stretch", "start", "ids", "loss_from", "loss_to"
    )
    return stretches.join(tokens, ["tree", "stretch"]).where("begin <= start AND start < end")


def conversation_digests(forest: ChatForest, rule: ChatRule, conv_id: str = "conv_id") -> DataFrame:
    """Read every conversation back from the tree's tokens by its intervals and sum it up."""
    shared = forest.nodes.sparkSession.sparkContext.broadcast(rule.vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value)
        leaf = None
        whole, loss = hashlib.sha256(), hashlib.sha256()
        turns, loss_chars, chars = 0, 0, 0
        names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names
            )

        def decoded(ids: list[list[int]]) -> list[str]:
            return tokenizer.decode_batch(ids, skip_special_tokens=False)

        for batch in batches:
            rows = []
            ids = [own.values.to_numpy().tolist() for own in batch.column("ids")]
            spans = zip(batch.column("loss_from").to_pylist(), batch.column("loss_to").to_pylist())
            under_loss = decoded([own[a:b] for own, (a, b) in zip(ids, spans)])
            for own, formatted, learned in zip(
                batch.column("leaf").to_pylist(), decoded(ids), under_loss
            ):
                if own != leaf:
                    if leaf is not None:
                        rows.append(
                            (leaf, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars)
                        )
                    leaf, turns, loss_chars, chars = own, 0, 0, 0
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in read_turns(formatted):
                    whole.update(f"{role}\n{text}\n".encode())
                    turns += 1
                learned = unescape(learned)
                loss.update(learned.encode())
                loss_chars += len(learned)
                chars += len(formatted)
            yield batch_of(rows)
        if leaf is not None:
            yield batch_of([(leaf, turns, whole.hexdigest(), loss_chars, loss.hexdigest(), chars)])

    ordered = (
        _attended(forest)
        .select("leaf", "start", "ids", "loss_from", "loss_to")
        .repartition("leaf")
        .sortWithinPartitions("leaf", "start")
        .select("leaf", "ids", "loss_from", "loss_to")
    )
    digests = saved(
        ordered.mapInArrow(
            read,
            "leaf binary, n_turns bigint, turns_sha256 string, loss_chars bigint,"
            " loss_sha256 string, formatted_chars bigint",
        ),
        "chat-digests",
    )
    return forest.conversations.join(digests, "leaf").select(
        conv_id,
        "n_turns",
        "turns_sha256",
        "loss_chars",
        "loss_sha256",
        "formatted_chars",
    )
