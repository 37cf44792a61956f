"""Pack tokenized documents into sequences of fixed capacity by large-item matching and best fit.

What fits together depends on lengths alone, and there are at most ``capacity`` different lengths.
So the packing is decided on the number of pieces of each length, a table that does not grow with
the documents.  Pieces longer than a third of the capacity are matched first, the longest with the
longest that still fits, at most two per sequence; shorter ones then go, longest first, to the
sequence with the smallest gap that takes them.  The decisions are runs: "pieces number p to q of
length n go to sequences s, s + 1, ... at offset o".  Each piece is numbered among those of its
length by sums over (task, length), and looks up its run.

Defined cases: a null or empty text is one piece that holds the end id alone; repeated rows are
packed each; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from adloom.llm.common import column, distinct_words, saved, vocabulary_path, words

# Words of which a worker remembers the ids, twice at most, and the longest such word in bytes.
MEMO_WORDS = 500_000
MEMO_BYTES = 64


@dataclass(frozen=True)
class PackRule:
    """``vocabulary`` is the content of a tokenizer file that splits texts at white space."""

    vocabulary: str
    capacity: int = 4096
    end_id: int = 1

    @staticmethod
    def from_file(path: str | None = None, **other: int) -> PackRule:
        with open(path or vocabulary_path("word_bpe_49k.json"), encoding="utf-8") as file:
            return PackRule(file.read(), **other)


def _ends_in_letter(word: bytes) -> bool:
    """Whether the tokenizer, which normalizes and lower-cases, sees a letter at the end."""
    if word.isascii():
        return word[-1:].isalpha()
    return unicodedata.normalize("NFC", word.decode()).lower()[-1:].isalpha()


class WordIds:
    """The ids of words, remembered from batch to batch.

    The tokenizer splits at white space, between a letter and a comma or full stop, and drops the
    white space; so the ids of a text are those of its words in a row, and those of a word with a
    comma are its own and the comma's.  Two dictionaries take turns: when the young one is full it
    becomes the old one, and words still in use move on.
    """

    def __init__(self, vocabulary: str) -> None:
        self.vocabulary = vocabulary
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.marks = {mark: self._plain(mark) for mark in (b",", b".")}

    def _plain(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _known(self, word: bytes) -> bytes | None:
        ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is not None:
                self.young[word] = ids
        return ids

    def of(self, found: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian bytes."""
        if len(self.young) > MEMO_WORDS:
            self.old, self.young = self.young, {}
        ids = [self._known(word) for word in found]
        missing = [k for k, known in enumerate(ids) if known is None]
        cores, marks = {}, []
        for k in missing:
            word, mark = found[k], found[k][-1:]
            split = mark in self.marks and _ends_in_letter(word[:-1])
            core = word[:-1] if split else word
            marks.append((core, mark if split else b""))
            if core not in cores:
                cores[core] = self._known(core)
        new = [core for core, known in cores.items() if known is None]
        cores.update((core, self._plain(core)) for core in new)
        self.young.update((core, cores[core]) for core in new if len(core) <= MEMO_BYTES)
        for k, (core, mark) in zip(missing, marks):
            ids[k] = cores[core] + self.marks[mark] if mark else cores[core]
        return ids


_word_ids: list[WordIds] = []


def word_ids(vocabulary: str) -> WordIds:
    """The worker's memory for this vocabulary."""
    if not _word_ids or _word_ids[0].vocabulary != vocabulary:
        _word_ids[:] = [WordIds(vocabulary)]
    return _word_ids[0]


def text_ids(memory: WordIds, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch of texts in a row, and where each text's ids begin and end.

    The tokenizer lower-cases anyway; doing so for A-Z first leaves fewer different words.  Only
    its special tokens are matched before that, so a batch that may hold one is left as it is.
    """
    special = pc.any(pc.match_substring(texts, "<|")).as_py()
    bounds, flat = words(texts, lower=not special)
    places, found = distinct_words(flat)
    ids = memory.of(found)
    pool = np.frombuffer(b"".join(ids), dtype="<u4")
    lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    starts = np.cumsum(lengths) - lengths
    length, start = lengths[places], starts[places]
    ends = np.concatenate(([0], np.cumsum(length)))
    take = np.arange(ends[-1]) - np.repeat(ends[:-1] - start, length)
    return pool[take], ends[bounds]


def pieces(docs: DataFrame, rule: PackRule, doc_id: str, text: str, with_ids: bool) -> DataFrame:
    """One row per piece, with its task (``part``) and its number among the task's equally long."""
    narrow = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(rule.vocabulary)
    capacity, end_id = rule.capacity, rule.end_id

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = word_ids(shared.value)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            ids, bounds = text_ids(memory, batch.column("text"))
            rows: list[tuple[int, int, int, int, int]] = []
            held: list[np.ndarray] = []
            for row, (first, last) in enumerate(zip(bounds[:-1], bounds[1:])):
                own = np.concatenate((ids[first:last], end))
                for piece, start in enumerate(range(0, len(own), capacity)):
                    some = own[start : start + capacity]
                    rows.append((row, piece, start, len(some), zlib.crc32(some.tobytes())))
                    if with_ids:
                        held.append(some)
            if not rows:
                continue
            row, piece, start, length, crc = map(list, zip(*rows))
            numbers = []
            for n in length:
                numbers.append(seen[n])
                seen[n] += 1
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array([part] * len(row), pa.int32()),
                pa.array(numbers, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
            if with_ids:
                offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                values = pa.array(np.concatenate(held).astype(np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), values))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType(
        [
            T.StructField("doc_id", narrow.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("number", T.LongType()),
        ]
    )
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return narrow.mapInArrow(cut, schema)


def packing_runs(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Decide the packing for so many pieces of each length.

    Returns rows (length, first piece number, first sequence, offset), each for the pieces up to
    the next row of that length, one per sequence.  There are at most as many steps as lengths can
    be used up and runs of sequences be filled, whatever the counts.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, dtype=np.int64)
    runs: list[tuple[int, int, int, int]] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    has_gap = np.zeros(capacity + 1, dtype=bool)
    opened = 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, int(used[length]), sequence, offset))
        used[length] += n
        left[length] -= n

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            gaps[gap].append((first, n))
            has_gap[gap] = True

    third = capacity // 3
    for long in range(capacity, third, -1):
        while left[long]:
            most = min(long, capacity - long)
            partners = np.flatnonzero(left[third + 1 : most + 1])
            partner = int(partners[-1]) + third + 1 if len(partners) else 0
            if partner == long and left[long] == 1:
                partner = int(partners[-2]) + third + 1 if len(partners) > 1 else 0
            if not partner:
                n = int(left[long])
                place(long, n, opened, 0)
            else:
                n = int(left[long]) // 2 if partner == long else int(min(left[long], left[partner]))
                place(long, n, opened, 0)
                place(partner, n, opened, long)
            keep(capacity - long - partner, opened, n)
            opened += n
    for short in range(third, 0, -1):
        while left[short]:
            fitting = has_gap[short:]
            gap = int(np.argmax(fitting)) + short
            if has_gap[gap]:
                first, n = gaps[gap].pop()
                has_gap[gap] = bool(gaps[gap])
                filled = int(min(n, left[short]))
                place(short, filled, first, capacity - gap)
                keep(gap, first + filled, n - filled)
                keep(gap - short, first, filled)
            else:
                n = int(left[short])
                each = min(capacity // short, n)
                full = n // each
                for k in range(each):
                    place(short, full, opened, k * short)
                keep(capacity - each * short, opened, full)
                opened += full
    if not runs:
        return np.zeros((0, 4), dtype=np.int64)
    return np.array(sorted(runs), dtype=np.int64)


def pack_documents(
    docs: DataFrame,
    rule: PackRule,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place: sequence and offset, and their ids if asked for."""
    cut = saved(pieces(docs, rule, doc_id, text, with_ids), "pieces")
    by_task = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    by_length = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    runs = packing_runs({row.length: row.n for row in by_length}, rule.capacity)
    shared = docs.sparkSession.sparkContext.broadcast(runs)
    before = by_task.selectExpr(
        "part",
        "length",
        "sum(n) OVER (PARTITION BY length ORDER BY part) - n AS before",
    )
    numbered = cut.join(before, ["part", "length"]).withColumn(
        "number", F.col("number") + F.col("before")
    )
    numbered = numbered.drop("part", "before")
    schema = T.StructType([f for f in numbered.schema if f.name != "number"])
    schema = schema.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        # Lengths and numbers in one sortable key: numbers stay far below 2 ** 48.
        keys = (table[:, 0] << 48) | table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            run = table[np.searchsorted(keys, (length << 48) | number, side="right") - 1]
            names = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(run[:, 2] + number - run[:, 1]), pa.array(run[:, 3])],
                [*names, "sequence_id", "offset"],
            )

    placed = numbered.mapInArrow(place, schema)
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    order += ["ids"] if with_ids else []
    return placed.select(
        F.col("doc_id").alias(doc_id), *[F.col(name) for name in order if name != "doc_id"]
    )
