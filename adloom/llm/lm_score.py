"""Score documents with a language model over all segmentations of their words into subwords.

The model: an existing vocabulary of pieces, each with a probability learned from the training
documents.  A text is a row of words and one end; a word, with the word-start mark before it, may
be cut into pieces in any way, and its probability is the sum over all ways, worked out by forward
recursion in log space.  As no piece crosses a word start, the text's probability is the product
over its words.  A character that is no piece is spelled with byte pieces.

The work: words are counted over all documents, every different word is scored once, and documents
add up their words.  Words so frequent that they would make hot join keys are few by construction
(at most ``HOT_WORDS``); they are sent to the tasks.  All other words are joined by key.

Defined cases: a null or empty text has the end token alone; a null id counts as an empty id text;
repeated rows are scored each; without training documents every count is 0; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import column, distinct_words, drop_saved, saved, vocabulary_path, words

WORD_START = "▁"

# Most words whose counts and scores are sent to all tasks; a fixed bound of a few megabytes.
HOT_WORDS = 65_536
HOT_BYTES = 64

# Counted words a task holds before it sums and emits them.
FLUSH_WORDS = 1_000_000


@dataclass(frozen=True)
class LatticeRule:
    """``model`` is the content of a sentencepiece file; documents whose checksum of the id has
    remainder ``held_out`` modulo ``folds`` are not learned from."""

    model: bytes
    folds: int = 5
    held_out: int = 1
    added: float = 0.5

    @staticmethod
    def from_file(path: str | None = None) -> LatticeRule:
        with open(path or vocabulary_path("piece_bpe_32k.model"), "rb") as file:
            return LatticeRule(file.read())


@dataclass(frozen=True)
class Lattice:
    """Pieces with their log probabilities; ``spelled`` has those of the 256 bytes."""

    pieces: dict[str, float]
    spelled: list[float]
    longest: int

    def log_probability(self, word: str) -> float:
        """Natural log of the summed probability of all ways to cut a word into pieces."""
        text = WORD_START + word
        pieces, longest = self.pieces, self.longest
        reached = [0.0]
        for end in range(1, len(text) + 1):
            ways = []
            for start in range(max(0, end - longest), end):
                score = pieces.get(text[start:end])
                if score is not None:
                    ways.append(reached[start] + score)
            if text[end - 1] not in pieces:
                spelled = sum(self.spelled[b] for b in text[end - 1].encode())
                ways.append(reached[end - 1] + spelled)
            best = max(ways)
            if len(ways) > 1:
                best += math.log(sum(math.exp(way - best) for way in ways))
            reached.append(best)
        return reached[-1]


def count_words(docs: DataFrame, text: str, learned: str) -> DataFrame:
    """Each different lower-cased word with its counts in training (``c``) and in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> Iterator[pa.RecordBatch]:
            if held:
                total = pa.concat_tables(held).group_by("word").aggregate(
                    [("c", "sum"), ("n", "sum")]
                )
                held.clear()
                total = total.rename_columns(
                    {"word": "word", "c_sum": "c", "n_sum": "n"}
                ).select(["word", "c", "n"])
                yield from total.to_batches(max_chunksize=100_000)

        for batch in batches:
            bounds, flat = words(batch.column(0), lower=True)
            coded = flat.dictionary_encode()
            places = coded.indices.to_numpy()
            learn = np.repeat(
                batch.column(1).to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds)
            )
            size = len(coded.dictionary)
            if not size:
                continue
            held.append(
                pa.table(
                    {
                        "word": coded.dictionary.cast(pa.large_binary()).cast(pa.binary()),
                        "c": np.bincount(places[learn], minlength=size).astype(np.int64),
                        "n": np.bincount(places, minlength=size).astype(np.int64),
                    }
                )
            )
            if sum(part.num_rows for part in held) > FLUSH_WORDS:
                yield from summed()
        yield from summed()

    counted = docs.select(text, learned).mapInArrow(count, "word binary, c bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def learn_lattice(counted: DataFrame, documents: int, rule: LatticeRule) -> tuple[Lattice, float]:
    """Piece probabilities from the vocabulary's own cut of each training word, and the end's.

    The counts that come back have one row per piece at most.
    """
    shared = counted.sparkSession.sparkContext.broadcast(rule.model)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        total = np.zeros(processor.get_piece_size(), dtype=np.int64)
        for batch in batches:
            found = [word.decode() for word in batch.column(0).to_pylist()]
            times = batch.column(1).to_numpy()
            for ids, n in zip(processor.encode(found, num_threads=1), times):
                for piece in ids:
                    total[piece] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["piece", "n"])

    learned = counted.where("c > 0").select("word", "c").mapInArrow(cut, "piece bigint, n bigint")
    times = {row.piece: row.n for row in learned.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    processor = sentencepiece.SentencePieceProcessor(model_proto=rule.model)
    size = processor.get_piece_size()
    end = processor.eos_id()
    times[end] = times.get(end, 0) + documents
    total = sum(times.values()) + rule.added * size
    pieces: dict[str, float] = {}
    spelled = [0.0] * 256
    for piece in range(size):
        score = math.log((times.get(piece, 0) + rule.added) / total)
        name = processor.id_to_piece(piece)
        if processor.is_byte(piece):
            spelled[int(name[1:-1], 16)] = score
        elif not (processor.is_control(piece) or processor.is_unknown(piece)):
            pieces[name] = score
    ending = math.log((times[end] + rule.added) / total)
    return Lattice(pieces, spelled, max(map(len, pieces))), ending


def score_words(counted: DataFrame, lattice: Lattice) -> DataFrame:
    """Add ``score``, the natural log probability of each different word."""
    shared = counted.sparkSession.sparkContext.broadcast(lattice)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = batch.column("word").to_pylist()
            scores = [model.log_probability(word.decode()) for word in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"]
            )

    return counted.mapInArrow(score, "word binary, c bigint, n bigint, score double")


def hot_words(scored: DataFrame) -> pa.Table:
    """The most frequent words, as many whole classes of frequency as the bound allows."""
    classed = scored.where(F.length("word") <= HOT_BYTES).withColumn(
        "class", F.expr("CAST(floor(8 * log2(n)) AS INT)")
    )
    classes = classed.groupBy("class").agg(F.count(F.lit(1)).alias("words")).collect()
    least, total = 8 * 64, 0
    for row in sorted(classes, key=lambda row: -row["class"]):
        total += row["words"]
        if total > HOT_WORDS:
            break
        least = row["class"]
    return classed.where(F.col("class") >= least).select("word", "c", "score").toArrow()


def score_documents(
    docs: DataFrame, rule: LatticeRule, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs`` with the base score, the lattice score and the counts."""
    id_type = docs.schema[doc_id].dataType
    chosen = docs.select(
        column(doc_id).alias("doc_id"),
        column(text).alias("text"),
        (
            F.crc32(F.coalesce(column(doc_id).cast("string"), F.lit("")).cast("binary"))
            % rule.folds
            == rule.held_out
        ).alias("held_out"),
    )
    counted = saved(
        count_words(chosen.withColumn("learned", ~F.col("held_out")), "text", "learned"), "words"
    )
    training = chosen.where("NOT held_out").count()
    sums = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")
    ).first()
    train_tokens, different = sums.n + training, sums.v + (1 if training else 0)
    lattice, ending = learn_lattice(counted, training, rule)
    scored = saved(score_words(counted, lattice), "scored-words")
    drop_saved(counted)
    hot = docs.sparkSession.sparkContext.broadcast(hot_words(scored))
    added = rule.added

    def sum_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = hot.value
        place_of = {word: k for k, word in enumerate(table["word"].to_pylist())}
        # One more entry for words that are not here; it adds nothing.
        counts = np.append(table["c"].to_numpy(), 0)
        base = np.append(np.log10(counts[:-1] + added), 0.0)
        score = np.append(table["score"].to_numpy(), 0.0)
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            size = batch.num_rows
            bounds, flat = words(batch.column("text"), lower=True)
            places, found = distinct_words(flat)
            of_doc = np.repeat(np.arange(size), np.diff(bounds))
            known = np.fromiter(
                (place_of.get(word, len(place_of)) for word in found), np.int64, len(found)
            )
            at = known[places]
            cold = at == len(place_of)
            pairs, times = np.unique(
                of_doc[cold] * max(1, len(found)) + places[cold], return_counts=True
            )
            cold_doc, cold_word = np.divmod(pairs, max(1, len(found)))
            ends = np.searchsorted(cold_doc, np.arange(size + 1))
            cold_words = pa.array(found, pa.binary()).take(pa.array(cold_word))
            entries = pa.StructArray.from_arrays(
                [cold_words, pa.array(times.astype(np.int64))], ["word", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row_id, row_id + size)),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(np.diff(bounds) + 1),
                    pa.array(np.bincount(of_doc, counts[at] > 0, size).astype(np.int64)),
                    pa.array(np.bincount(of_doc, base[at], size)),
                    pa.array(np.bincount(of_doc, score[at], size)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), entries),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "cold"],
            )
            row_id += size

    schema = (
        f"row bigint, doc_id {id_type.simpleString()}, held_out boolean, n_tokens bigint,"
        " known bigint, base double, score double, cold array<struct<word: binary, times: bigint>>"
    )
    parts = saved(chosen.mapInArrow(sum_hot, schema), "scored-parts")
    cold = (
        parts.select("row", F.explode("cold").alias("cold"))
        .select("row", "cold.word", "cold.times")
        .join(scored, "word")
        .groupBy("row")
        .agg(
            F.sum(F.expr("IF(c > 0, times, 0)")).alias("known_cold"),
            F.sum(F.col("times") * F.log10(F.col("c") + F.lit(added))).alias("base_cold"),
            F.sum(F.col("times") * F.col("score")).alias("score_cold"),
        )
    )
    end_known = 1 if training else 0
    end_base = math.log10(training + added)
    total = math.log10(train_tokens + added * (different + 1))
    return (
        parts.drop("cold")
        .join(cold, "row", "left")
        .select(
            F.col("doc_id").alias(doc_id),
            "held_out",
            "n_tokens",
            F.expr(f"known + coalesce(known_cold, 0) + {end_known}").alias("n_known"),
            F.lit(train_tokens).cast("bigint").alias("train_tokens"),
            (
                F.col("base")
                + F.coalesce("base_cold", F.lit(0.0))
                + F.lit(end_base)
                - F.col("n_tokens") * F.lit(total)
            ).alias("base_score"),
            (
                (F.col("score") + F.coalesce("score_cold", F.lit(0.0)) + F.lit(ending))
                / F.lit(math.log(10))
            ).alias("score"),
        )
    )
