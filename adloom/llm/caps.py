"""Link embeddings of one label by cosine with spherical-cap filters from random product codes.

Vectors are turned by a random rotation and cut into blocks; every block has a few random unit
directions, and a filter is one direction per block, so that few numbers describe very many
filters.  Each vector lives under the filter it exceeds most.  It is also list-decoded, block by
block with partial sums cut off early, to all filters that it exceeds nearly as much: those that
may be the best filter of a vector within the angle asked for.  A vector is compared with the
vectors that live under its listed filters; each ordered pair meets once at most.

How near "nearly" is: for vectors at the limiting angle, the difference between two filters'
products changes by a normal deviate of known size, because the rotation is random; ``margin`` of
its standard deviations are allowed for.  At 6 a pair at the very limit is lost about once in
1e8, closer pairs far more rarely.  What is linked is decided by cosines in double precision.

Equal vectors are one node, with a number of its own and a number of copies.  Hot filters are cut into a grid of blocks of
vectors that live there and vectors that look there; blocks are compared as matrices, homes in
memory and lookers passing by, and leave only sums and a spanning forest of the links.

Defined cases: a vector that is null, empty, zero or holds null or non-finite numbers, a null label
or a null id link with nothing; a null id has no component and is not kept; vectors of different
lengths are not compared; rows with equal ids are vectors each, and link as their own vectors do; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.llm.common import column, drop_saved, saved
from adloom.llm.components import components


@dataclass(frozen=True)
class CapRule:
    cosine: float = 0.98
    margin: float = 6.0
    seed: int = 11
    # Vectors of the largest label that live under a filter on average.  A vector looks under about
    # the square root of all filters, so cost is least, at any number of vectors, where comparing it
    # with those who live under one takes as long as sending it there: some 500 comparisons.
    per_filter: int = 512
    # Sides of a block that is compared at once.
    homes: int = 2048
    lookers: int = 2048


@dataclass(frozen=True)
class ProductCode:
    """A rotation and, for each block of rotated coordinates, its directions and their gaps."""

    rotation: np.ndarray
    blocks: list[tuple[slice, np.ndarray, np.ndarray]]
    allowed: float

    def best(self, vectors: np.ndarray) -> np.ndarray:
        turned = vectors @ self.rotation
        code = np.zeros(len(vectors), np.int64)
        for part, directions, _ in self.blocks:
            code = code * len(directions) + np.argmax(turned[:, part] @ directions.T, axis=1)
        return code

    def listed(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and filters: all that each vector exceeds nearly as much as its best.

        A partial filter stays while its loss against the best one may still be made up for by
        the distance that the blocks to come can add.
        """
        turned = vectors @ self.rotation
        rows = np.arange(len(vectors))
        codes = np.zeros(len(vectors), np.int64)
        loss = np.zeros(len(vectors))
        apart = np.zeros(len(vectors))
        still = np.cumsum([gaps.max() for _, _, gaps in self.blocks][::-1])[::-1]
        still = np.append(still[1:], 0.0)
        for (part, directions, gaps), rest in zip(self.blocks, still):
            products = turned[:, part] @ directions.T
            best = products.argmax(axis=1)
            lost = products.max(axis=1)[:, None] - products
            distance = gaps[best]
            size = len(directions)
            loss = (loss[:, None] + lost[rows]).ravel()
            apart = (apart[:, None] + distance[rows]).ravel()
            codes = (codes[:, None] * size + np.arange(size)).ravel()
            rows = np.repeat(rows, size)
            stay = loss <= self.allowed * np.sqrt(apart + rest) + 1e-12
            rows, codes, loss, apart = rows[stay], codes[stay], loss[stay], apart[stay]
        return rows, codes


@cache
def product_code(dimension: int, bits: int, rule: CapRule) -> ProductCode:
    """The code for vectors of a length with about 2 ** bits filters, the same in every task."""
    random = np.random.default_rng([rule.seed, dimension, bits])
    rotation = np.linalg.qr(random.normal(size=(dimension, dimension)))[0]
    n_blocks = min(dimension, 2 if bits <= 12 else 4)
    blocks = []
    for k, part in enumerate(np.array_split(np.arange(dimension), n_blocks)):
        own_bits = bits // n_blocks + (k < bits % n_blocks)
        directions = random.normal(size=(1 << own_bits, len(part)))
        directions /= np.linalg.norm(directions, axis=1, keepdims=True)
        gaps = np.square(directions[:, None] - directions[None]).sum(axis=2)
        blocks.append((slice(int(part[0]), int(part[-1]) + 1), directions, gaps))
    tangent = math.sqrt(1 - rule.cosine**2) / rule.cosine
    return ProductCode(rotation, blocks, rule.margin * tangent / math.sqrt(max(1, dimension - 1)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _number_type(vectors: DataFrame, embedding: str) -> str:
    """Singles travel as singles; products are made in double precision."""
    return "<f4" if vectors.schema[embedding].dataType.elementType == T.FloatType() else "<f8"


def _prepared(frame: DataFrame, kind: str) -> DataFrame:
    """Vectors as bytes, with a digest of label and vector; null where they can't link."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("vec_id").to_pylist(), batch.column("label").to_pylist()
            digests, vectors = [], []
            for own, label, values in zip(ids, labels, batch.column("vector")):
                vector = digest = None
                if own is not None and label is not None and values.is_valid and len(values):
                    if not values.values.null_count:
                        numbers = values.values.to_numpy().astype(kind)
                        if np.isfinite(numbers).all() and numbers.any():
                            vector = numbers.tobytes()
                            digest = hashlib.blake2b(
                                f"{label}:".encode() + vector, digest_size=16
                            ).digest()
                digests.append(digest)
                vectors.append(vector)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array(digests, pa.binary()),
                    pa.array(vectors, pa.binary()),
                ],
                ["vec_id", "label", "digest", "vector"],
            )

    return frame.mapInArrow(prepare, "vec_id bigint, label string, digest binary, vector binary")


def _decoded(nodes: DataFrame, bits: int, kind: str, rule: CapRule) -> DataFrame:
    """Per node one row for the filter it lives under and one for each filter it looks under."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("node").to_numpy()
            raw = batch.column("vector").to_pylist()
            lengths = np.array([len(vector) for vector in raw]) // np.dtype(kind).itemsize
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                vectors = np.frombuffer(b"".join(raw[k] for k in at), kind).reshape(len(at), length)
                code = product_code(int(length), bits, rule)
                unit = _unit(vectors)
                homes = code.best(unit)
                rows, filters = code.listed(unit)
                size = len(homes) + len(rows)
                of = at[np.concatenate((np.arange(len(at)), rows))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[of]),
                        batch.column("label").take(pa.array(of)),
                        pa.array(np.full(size, length, np.int32)),
                        pa.array(np.concatenate((homes, filters))),
                        pa.array(np.arange(size) >= len(homes)),
                    ],
                    ["node", "label", "length", "filter", "looks"],
                )

    return nodes.select("node", "label", "vector").mapInArrow(
        decode, "node bigint, label string, length int, filter bigint, looks boolean"
    )


def _compared(blocks: DataFrame, kind: str, rule: CapRule) -> DataFrame:
    """Rows ``node, links, other``: sums of copies linked, and links that span all that are found.

    ``blocks`` holds, sorted, the homes of each block before its lookers.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        homes: list[tuple[int, int, bytes]] = []
        known: tuple | None = None
        out: list[tuple[int, int, int | None]] = []

        def look(ids: np.ndarray, vectors: np.ndarray) -> None:
            nonlocal known
            if known is None:
                known = (
                    np.array([h[0] for h in homes]),
                    np.array([h[1] for h in homes]),
                    _unit(np.frombuffer(b"".join(h[2] for h in homes), kind).reshape(len(homes), -1)),
                    np.arange(len(homes)),
                )
            nodes, copies, matrix, group = known
            linked = _unit(vectors) @ matrix.T >= rule.cosine
            linked &= ids[:, None] != nodes
            sums = linked @ copies
            for row in np.flatnonzero(sums):
                found = np.flatnonzero(linked[row])
                first = found[0]
                out.append((int(ids[row]), int(sums[row]), int(nodes[first])))
                groups = group[found]
                for k in np.flatnonzero(groups != groups[0]):
                    if group[found[k]] != group[first]:
                        out.append((int(nodes[found[k]]), 0, int(nodes[first])))
                        group[group == group[found[k]]] = group[first]

        def flushed() -> Iterator[pa.RecordBatch]:
            columns = list(zip(*out)) if out else [[], [], []]
            out.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["node", "links", "other"]
            )

        for batch in batches:
            of = list(zip(*(batch.column(k).to_pylist() for k in range(5))))
            looks = batch.column("looks").to_pylist()
            ids = batch.column("node").to_pylist()
            copies = batch.column("copies").to_pylist()
            raw = batch.column("vector").to_pylist()
            begin = 0
            while begin < len(of):
                end = begin
                while end < len(of) and of[end] == of[begin] and looks[end] == looks[begin]:
                    end += 1
                if of[begin] != key:
                    key, homes, known = of[begin], [], None
                if not looks[begin]:
                    homes += zip(ids[begin:end], copies[begin:end], raw[begin:end])
                elif homes:
                    vectors = np.frombuffer(b"".join(raw[begin:end]), kind).reshape(end - begin, -1)
                    for k in range(0, end - begin, rule.lookers):
                        look(np.array(ids[begin:end][k : k + rule.lookers]),
                             vectors[k : k + rule.lookers])
                begin = end
            yield from flushed()

    return blocks.mapInArrow(compare, "node bigint, links bigint, other bigint")


def near_vectors(
    vectors: DataFrame,
    rule: CapRule = CapRule(),
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``."""
    kind = _number_type(vectors, embedding)
    rows = saved(
        _prepared(
            vectors.select(
                column(vec_id).cast("bigint").alias("vec_id"),
                column(label).cast("string").alias("label"),
                column(embedding).alias("vector"),
            ),
            kind,
        ),
        "caps-rows",
    )
    nodes = saved(
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("vec_id").alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "caps-nodes",
    )
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = min(24, max(0, round(math.log2(largest / rule.per_filter))))
    decoded = saved(_decoded(nodes, bits, kind, rule), "caps-filters")

    cell = ["label", "length", "filter"]
    sides = (
        decoded.groupBy(*cell)
        .agg(F.count_if(F.col("looks")).alias("q"), F.count_if(~F.col("looks")).alias("h"))
        .where("h > 0")
        .selectExpr(
            *cell,
            f"CAST(ceil(h / {rule.homes}) AS INT) AS home_blocks",
            f"CAST(ceil(q / {rule.lookers}) AS INT) AS look_blocks",
        )
    )
    sides = saved(sides, "caps-cells")
    own = "CAST(pmod(xxhash64(node), {}) AS INT)"
    placed = decoded.join(sides, cell).selectExpr(
        "*",
        f"explode(IF(looks, transform(sequence(0, home_blocks - 1), i -> struct(i AS i,"
        f" {own.format('look_blocks')} AS j)), transform(sequence(0, look_blocks - 1),"
        f" j -> struct({own.format('home_blocks')} AS i, j AS j)))) AS block",
    )
    key = [*cell, "i", "j"]
    blocks = (
        placed.selectExpr("node", *cell, "looks", "block.i", "block.j")
        .join(nodes.select("node", "copies", "vector"), "node")
        .select(*key, "looks", "node", "copies", "vector")
        .repartition(*key)
        .sortWithinPartitions(*key, "looks")
    )
    found = saved(_compared(blocks, kind, rule), "caps-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.where("other IS NOT NULL"), "node", "other")
    placed_nodes = saved(
        nodes.select("digest", "node", "copies", "least")
        .join(links, "node", "left")
        .join(grouped, "node", "left")
        .selectExpr(
            "digest",
            "coalesce(links, 0) + copies - 1 AS n_links",
            "coalesce(component, node) AS component",
            "least",
        ),
        "caps-placed",
    )
    # Components are of nodes; each is called by the least id of all its vectors.
    names = placed_nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = saved(
        placed_nodes.join(names, "component").select("digest", "n_links", "component_id"),
        "caps-found",
    )
    drop_saved(nodes, decoded, sides, found, placed_nodes)
    lone = rows.where("digest IS NULL").selectExpr(
        "vec_id", "CAST(0 AS BIGINT) AS n_links", "vec_id AS component_id"
    )
    joined = (
        rows.where("digest IS NOT NULL")
        .select("vec_id", "digest")
        .join(of_node, "digest")
        .select("vec_id", "n_links", "component_id")
    )
    return joined.union(lone).select(
        F.col("vec_id").alias(vec_id),
        "n_links",
        "component_id",
        F.expr("coalesce(vec_id = component_id, false)").alias("kept"),
    )
