"""Rank documents for queries by a weighted sum over shared terms: short lists first, then long.

Two passes over the documents.  The first writes, per document, its length and the counts of the
terms that some query asks for; numbers of documents and of terms, and how many documents hold a
term, follow from that table.  The second deals its rows into shards of bounded size and answers
all queries in each shard:

1. Every term's documents in the shard are a list with exact contributions; long lists also keep
   the largest contribution of each block of documents.
2. Of a query's lists the short ones are summed into accumulators, term at a time.  What comes out
   is one more list, with the largest sum of each block as its bound.
3. The long lists and that list are walked together in order of documents, block by block.  A
   block is skipped if the bounds of all lists in it add up to less than the lowest score that
   still counts; within a block lists are added from the largest bound down, and the block is
   left as soon as what is to come cannot lift any document over that score.

The lowest score that counts starts at the accumulators' own k-th largest sum, as a score is never
less than a part of it, rises while the walk goes on, and is kept from shard to shard of a task.
Documents at that very score stay until ids decide.  Tasks send k documents a query; they are cut
to k in two steps, first per query and hash of the document.

Queries are worked off in blocks with a bounded number of terms, which the tasks hold in memory.

Defined cases: null texts have no terms; rows with equal or null ids are documents each, and among
equal scores null ids come last; rows of queries with one id, or with none, are one query; a query
without a term that occurs has no rows; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import column, saved, words

# What each byte becomes: A-Z as a-z, other ASCII characters that are in no term as blanks.
_TERM_BYTES = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() else ord(" ") for b in range(0x80)
) + bytes(range(0x80, 0x100))


@dataclass(frozen=True)
class SearchRule:
    top: int = 50
    # Terms of queries, each counted once a query, that a block of queries holds on average.
    block_terms: int = 1_000_000
    # A shard ends with so many documents or entries of lists.
    shard_documents: int = 32_768
    shard_entries: int = 4_000_000
    # Documents whose contributions share a bound.
    block: int = 128
    # A list is short if it holds at most this part of the shard's documents.
    short: float = 1 / 32
    # Parts in which a query's candidates are cut before all of them are.
    parts: int = 64


def terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """All terms of a batch of texts in a row, and where each text's terms begin and end."""
    texts = texts.cast(pa.large_string())
    known, offsets, data = texts.buffers()
    if data is not None:
        plain = pa.py_buffer(data.to_pybytes().translate(_TERM_BYTES))
        texts = pa.Array.from_buffers(
            pa.large_string(), len(texts), [known, offsets, plain], offset=texts.offset
        )
    return words(texts, lower=False)


def query_terms(queries: DataFrame) -> DataFrame:
    """Rows ``item_id, term``: each term of a query once."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, flat = terms(batch.column("text"))
            of = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(bounds)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(of), flat.cast(pa.string())], ["item_id", "term"]
            )

    return queries.mapInArrow(split, "item_id bigint, term string").distinct()


def counted_terms(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per document with terms: ``n`` of them, and places in the vocabulary with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(pa.array(vocabulary, pa.large_string()))
    size = max(1, len(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            bounds, flat = terms(batch.column("text"))
            coded = flat.dictionary_encode()
            places = pc.fill_null(pc.index_in(coded.dictionary, wanted), -1).to_numpy()
            of_term = places[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.int32)
            lengths = np.diff(bounds)
            known = of_term >= 0
            of = np.repeat(np.arange(len(lengths)), lengths)[known]
            entries, counts = np.unique(of * size + of_term[known], return_counts=True)
            ends = np.searchsorted(entries, np.arange(len(lengths) + 1) * size).astype(np.int32)
            found = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(ends, pa.array((entries % size).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
                ],
                ["doc_id", "n", "terms", "counts"],
            )
            yield found.filter(pa.array(lengths > 0))

    return docs.mapInArrow(
        count, "doc_id bigint, n bigint, terms array<int>, counts array<int>"
    )


@dataclass
class Best:
    """The best documents of a query so far, in order."""

    top: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    missing: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def least(self) -> int:
        """The lowest score that can still count."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores = np.concatenate((self.scores, scores))
        ids, missing = np.concatenate((self.ids, ids)), np.concatenate((self.missing, missing))
        order = np.lexsort((ids, missing, -scores))[: self.top]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


class Shard:
    """The lists of some documents, by term, with contributions and bounds."""

    def __init__(self, ids, missing, norms, ends, terms, counts, weights, rule: SearchRule):
        self.ids, self.missing, self.rule = ids, missing, rule
        self.size = len(ids)
        docs = np.repeat(np.arange(self.size, dtype=np.int32), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        of_term, self.docs = terms[order], docs[order]
        counts = counts[order].astype(np.int64)
        parts = (10**9 * counts) // (1000 * counts + 20 * norms[self.docs])
        self.given = weights[of_term] * parts
        self.terms, first = np.unique(of_term, return_index=True)
        self.bounds = np.append(first, len(of_term))
        self.blocks = -(-self.size // rule.block)
        lengths = np.diff(self.bounds)
        self.long = np.flatnonzero(lengths > rule.short * self.size)
        self.long_place = np.full(len(self.terms), -1)
        self.long_place[self.long] = np.arange(len(self.long))
        # Entries of long lists are in order of list and block; each such run has its bound.
        at = np.concatenate([np.arange(*self.bounds[k : k + 2]) for k in self.long] or [[]])
        at = at.astype(np.int64)
        run = np.repeat(np.arange(len(self.long)), lengths[self.long]) * self.blocks
        run = run + self.docs[at] // rule.block
        self.starts = np.searchsorted(run, np.arange(len(self.long) * self.blocks + 1))
        self.long_docs, self.long_given = self.docs[at], self.given[at]
        self.block_most = np.zeros(len(self.long) * self.blocks, np.int64)
        filled = np.flatnonzero(np.diff(self.starts))
        if len(filled):
            self.block_most[filled] = np.maximum.reduceat(self.long_given, self.starts[filled])
        self.block_most = self.block_most.reshape(len(self.long), self.blocks)

    def accumulated(self, lists: np.ndarray) -> np.ndarray:
        """The sums of short lists, term at a time, for each document of the shard."""
        sums = np.zeros(self.blocks * self.rule.block, np.int64)
        for k in lists:
            begin, end = self.bounds[k], self.bounds[k + 1]
            sums[self.docs[begin:end]] += self.given[begin:end]
        return sums

    def search(self, query: np.ndarray, best: Best) -> None:
        """Add the shard's documents that can be among the query's best."""
        at = np.minimum(np.searchsorted(self.terms, query), len(self.terms) - 1)
        lists = at[self.terms[at] == query]
        places = self.long_place[lists]
        sums = self.accumulated(lists[places < 0])
        places = places[places >= 0]
        least = best.least
        if np.count_nonzero(sums) >= best.top:
            least = max(least, int(np.partition(sums, -best.top)[-best.top]))
        width = self.rule.block
        most = self.block_most[places]
        bounds = sums.reshape(-1, width).max(axis=1) + most.sum(axis=0)
        for block in np.flatnonzero(bounds >= least):
            if bounds[block] < least:
                continue
            begin = block * width
            scores = sums[begin : begin + width].copy()
            own = most[:, block]
            left = int(own.sum())
            for k in np.argsort(-own, kind="stable"):
                if not own[k] or int(scores.max()) + left < least:
                    break
                run = places[k] * self.blocks + block
                entries = slice(self.starts[run], self.starts[run + 1])
                scores[self.long_docs[entries] - begin] += self.long_given[entries]
                left -= int(own[k])
            if left:
                continue
            found = np.flatnonzero(scores >= least)
            if len(found):
                docs = begin + found
                best.add(scores[found], self.ids[docs], self.missing[docs])
                least = max(least, best.least)


def norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """How much a document's length counts, 50 for an empty and 100 for a usual one."""
    if 50 * int(n.max(initial=0)) * n_docs >= 2**63:
        return (50 + 50 * n.astype(object) * n_docs // n_terms).astype(np.int64)
    return 50 + (50 * n * n_docs) // n_terms


def searched(
    counted: DataFrame,
    queries: list[tuple[int | None, np.ndarray]],
    weights: np.ndarray,
    n_docs: int,
    n_terms: int,
    rule: SearchRule,
) -> DataFrame:
    """Rows ``item_id, doc_id, score``: the best documents of each query from each task."""
    shared = counted.sparkSession.sparkContext.broadcast((queries, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best = [Best(rule.top) for _ in queries]
        held: list[pa.RecordBatch] = []

        def answer() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            lists = table["terms"].combine_chunks()
            shard = Shard(
                pc.fill_null(table["doc_id"], 0).to_numpy(),
                table["doc_id"].is_null().to_numpy(),
                norms(table["n"].to_numpy(), n_docs, n_terms),
                np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))),
                lists.flatten().to_numpy(),
                table["counts"].combine_chunks().flatten().to_numpy(),
                weights,
                rule,
            )
            for (_, query), own in zip(queries, best):
                shard.search(query, own)

        docs = entries = 0
        step = min(1000, rule.shard_documents)
        for piece in (b.slice(k, step) for b in batches for k in range(0, b.num_rows, step)):
            held.append(piece)
            docs += piece.num_rows
            entries += len(piece.column("terms").flatten())
            if docs >= rule.shard_documents or entries >= rule.shard_entries:
                answer()
                docs = entries = 0
        if held:
            answer()
        for (item, _), own in zip(queries, best):
            if len(own.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(own.scores), pa.int64()),
                        pa.array(own.ids, mask=own.missing),
                        pa.array(own.scores),
                    ],
                    ["item_id", "doc_id", "score"],
                )

    return counted.where("size(terms) > 0").mapInArrow(
        search, "item_id bigint, doc_id bigint, score bigint"
    )


def _answered(docs: DataFrame, block: DataFrame, rule: SearchRule) -> DataFrame:
    """The best documents of the queries of a block, given as their distinct terms."""
    given = block.groupBy("item_id").agg(F.collect_list("term").alias("terms")).toArrow()
    lists = given["terms"].to_pylist()
    vocabulary = sorted({term for own in lists for term in own})
    place = {term: k for k, term in enumerate(vocabulary)}
    counted = saved(counted_terms(docs, vocabulary), "lexical-counts")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in zip(holding["term"].to_pylist(), holding["count"].to_pylist()):
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    queries = [
        (item, np.array(sorted(map(place.__getitem__, own)), np.int32))
        for item, own in zip(given["item_id"].to_pylist(), lists)
    ]
    return searched(counted, queries, weights, n_docs, max(1, n_terms), rule)


def ranked(found: DataFrame, rule: SearchRule) -> DataFrame:
    """The best of all candidates, with their rank; cut per part of the documents first."""
    in_order = "ORDER BY score DESC, doc_id ASC NULLS LAST"
    part = f"pmod(xxhash64(doc_id), {rule.parts})"
    first = found.selectExpr(
        "*", f"row_number() OVER (PARTITION BY item_id, {part} {in_order}) AS rank"
    ).where(F.col("rank") <= rule.top)
    return (
        first.drop("rank")
        .selectExpr("*", f"row_number() OVER (PARTITION BY item_id {in_order}) AS rank")
        .where(F.col("rank") <= rule.top)
        .select("item_id", "rank", "doc_id", "score")
    )


def best_documents(
    docs: DataFrame,
    queries: DataFrame,
    rule: SearchRule = SearchRule(),
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    query: str = "text",
) -> DataFrame:
    """Each query's ``top`` documents by score: its id, ``rank``, the document's id, ``score``."""
    narrow = docs.select(
        column(doc_id).cast("bigint").alias("doc_id"), column(text).alias("text")
    )
    asked = saved(
        query_terms(
            queries.select(
                column(item_id).cast("bigint").alias("item_id"), column(query).alias("text")
            )
        ),
        "lexical-queries",
    )
    n_blocks = max(1, -(-asked.count() // rule.block_terms))
    answers = [
        _answered(narrow, asked.where(f"pmod(xxhash64(item_id), {n_blocks}) = {k}"), rule)
        for k in range(n_blocks)
    ]
    best = ranked(reduce(DataFrame.union, answers), rule)
    return best.withColumnsRenamed({"item_id": item_id, "doc_id": doc_id})
