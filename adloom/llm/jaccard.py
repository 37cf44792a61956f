"""Link documents whose sets of word shingles are similar, by adaptive multi-match prefixes.

Shingles of all sets have one order, the rare ones first.  If two sets are similar enough, then for
any number m up to their overlap they share m shingles within their prefixes, each of which is m
shingles longer than what the set can lose.  A longer prefix finds more candidates by itself but
asks for more shared shingles.  For every document, the length is chosen that costs least: shared
prefix entries to walk, and sets to compare, estimated by the entries over the matches asked for.
A pair must share as many prefix shingles as the smaller of its two numbers of matches.

Steps, each over all documents:

1. A sketch of fixed size counts shingles in hashed buckets; it gives the order.
2. Every document leaves its longest prefix and a digest of its set; equal sets become one node.
3. Prefix shingles that occur once are dropped; the others choose each node's prefix length.
4. Each node is compared with one leader, the nearest of those that stand first in its shingles'
   lists, then with the nearest of other delegates of the lists that are still of several
   components.  So a large group of near copies costs a few comparisons per copy.
5. Of the shingles' lists, only entries outside the largest component are then paired with those
   of larger components, once for all lists with the same members, if places in the prefixes and
   bitmaps leave room for enough common shingles, and are compared.

Every set has a bitmap in which each shingle flips one bit.  Two sets differ in at least as many
shingles as their bitmaps differ in bits, which is an exact bound, and a sharp one for near copies.

Comparisons are exact: sets are made again from the whole texts of the nodes concerned.

Defined cases: a null or empty text has an empty set and is linked with nothing; rows with equal ids
are documents each, linked by their own texts; documents without an id are linked with nothing and
have no component, but near duplicates among them are told apart from others by their texts alike;
an empty table gives an empty result.  Shingles are told apart by 64-bit hashes.

Where ids repeat or are missing, the rows are written with a number of their own first, and the
steps above work on the numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import column, distinct_words, drop_saved, fresh, saved, words
from adloom.llm.components import components

# Buckets of the counting sketch: 2 ** 20 counters of 8 bytes, whatever the input.
SKETCH_BITS = 20
CHUNK_BITS = 12

# Bits that tell which documents must be read again; a fixed size, too.
FILTER_BITS = 23

# 64-bit words of a set's bitmap, and of the one it is folded to where there are many entries.
BITMAP_WORDS = 32
FOLDED_WORDS = 8

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class JaccardRule:
    """Documents are linked if 100 * intersection >= percent * union.

    Every set is asked for one match and one more per ``per_match`` shingles; a cost estimate may
    ask for up to ``extra_matches`` beyond these.
    ``compare_cost`` is the cost of one comparison of sets in prefix entries walked.
    """

    width: int = 4
    percent: int = 85
    per_match: int = 16
    extra_matches: int = 7
    compare_cost: int = 20
    # Comparisons of each node with one delegate before the rest of the lists is paired.
    rounds: int = 1


def _mixed(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        state = (state ^ value) * _MIX
        state ^= state >> np.uint64(29)
        state = state * _MIX2
        return state ^ (state >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words is one shingle."""
    bounds, flat = words(texts, lower=True)
    places, found = distinct_words(flat)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))[places]
    whole = np.zeros(max(0, len(codes) - width + 1), np.uint64)
    for k in range(width):
        whole = _mixed(whole, codes[k : k + len(whole)])
    sets = []
    for first, last in zip(bounds[:-1], bounds[1:]):
        n = last - first
        if n >= width:
            sets.append(np.unique(whole[first : last - width + 1]))
        else:
            short = np.full(min(n, 1), n, np.uint64)
            for code in codes[first:last]:
                short = _mixed(short, code)
            sets.append(short)
    return sets


def bitmap(own: np.ndarray) -> np.ndarray:
    """The bits that an odd number of the set's shingles flip."""
    bits = np.bincount((own & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64),
                       minlength=64 * BITMAP_WORDS)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def _bitmap_names(words_held: int = FOLDED_WORDS) -> list[str]:
    return [f"bits{k}" for k in range(words_held)]


def _folded() -> list[str]:
    """The words of the folded bitmap from those of the whole one, as SQL expressions."""
    return [
        " ^ ".join(f"bits{k}" for k in range(place, BITMAP_WORDS, FOLDED_WORDS)) + f" AS bits{place}"
        for place in range(FOLDED_WORDS)
    ]


def _needed(size: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of this size with any set linked to it."""
    return (percent * size + 99) // 100


def sketch(docs: DataFrame, rule: JaccardRule) -> np.ndarray:
    """How many documents have a shingle in each hashed bucket."""
    width = rule.width
    chunk = 1 << CHUNK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            sets = shingle_sets(batch.column("text"), width)
            if sets:
                buckets = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
                total += np.bincount(buckets.astype(np.int64), minlength=len(total))
        for k, part in enumerate(total.reshape(-1, chunk)):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    ["chunk", "counts"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.frombuffer(counts, np.int64)
                total[k] = total[k] + counts if k in total else counts
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(total), pa.int32()),
                pa.array([part.tobytes() for part in total.values()], pa.binary()),
            ],
            ["chunk", "counts"],
        )

    schema = "chunk int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema).repartition("chunk")
    result = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in parts.mapInArrow(add, schema).collect():
        result[row.chunk * chunk : (row.chunk + 1) * chunk] += np.frombuffer(row.counts, np.int64)
    return result


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """0 for buckets that hold no more than chance puts there, else the count's power of two."""
    usual = counts.mean()
    frequent = counts > usual + 6 * np.sqrt(usual) + 6
    return np.where(frequent, np.log2(np.maximum(counts, 1)).astype(np.int64) + 1, 0).astype(np.uint8)


def signatures(docs: DataFrame, rule: JaccardRule, classes: np.ndarray) -> DataFrame:
    """Per document: the size of its set, a digest, a bitmap, and its longest prefix in order."""
    width, percent = rule.width, rule.percent
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    names = _bitmap_names(BITMAP_WORDS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of = shared.value
        for batch in batches:
            sets = shingle_sets(batch.column("text"), width)
            prefixes, digests = [], []
            for own in sets:
                rank = class_of[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                ordered = own[np.argsort(rank, kind="stable")]
                size = len(own)
                most = 1 + size // rule.per_match + rule.extra_matches
                prefixes.append(ordered[: size - int(_needed(size, percent)) + most])
                digests.append(xxhash.xxh3_128_digest(own.tobytes()) if size else None)
            bitmaps = np.array([bitmap(own) for own in sets]).reshape(-1, BITMAP_WORDS).T
            ends = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                    *(pa.array(column) for column in bitmaps),
                ],
                ["doc_id", "size", "digest", "prefix", *names],
            )

    return docs.select("doc_id", "text").mapInArrow(
        sign,
        "doc_id bigint, size bigint, digest binary, prefix array<bigint>, "
        + ", ".join(f"{name} bigint" for name in names),
    )


def postings(nodes: DataFrame, rule: JaccardRule) -> tuple[DataFrame, DataFrame]:
    """The prefix entries that can lead to candidates: ``token, node, size, place, rank, matches``.

    ``place`` counts all shingles of the node up to the entry, ``rank`` those that other prefixes
    share.  ``matches`` is the node's number of shared shingles asked for.

    A set that may be linked to this one is asked for at least ``1 + least // per_match`` matches,
    where ``least`` is the smallest size it can have.  A set that shares fewer entries than that
    with all others together is linked with nothing and left out.  As so many entries are common to both, all
    but one of that number may be left out on one side: ``skip`` marks those of the longest lists,
    ``skipped`` is their number.

    Also returns the table of shared tokens, which the entries read.
    """
    entries = nodes.select("node", "size", F.posexplode("prefix").alias("place", "token"))
    entries = entries.withColumn("place", F.col("place") + 1)
    often = saved(
        entries.groupBy("token").agg(F.count(F.lit(1)).alias("listed")).where("listed > 1"),
        "jaccard-tokens",
    )
    shared = entries.join(often, "token")
    needed = f"(({rule.percent} * size + 99) DIV 100)"
    asked = [f"(1 + size DIV {rule.per_match} + {m})" for m in range(rule.extra_matches + 1)]
    costs = ", ".join(
        f"""IF({m} > {needed} AND {m} > 1, NULL, struct(
            sum(IF(place <= size - {needed} + {m}, listed - 1, 0)) OVER (PARTITION BY node)
                * (1 + {rule.compare_cost} / {m}) AS cost, {m} AS matches))"""
        for m in asked
    )
    entries = (
        shared.selectExpr(
            "token",
            "node",
            "size",
            "place",
            "listed",
            "row_number() OVER (PARTITION BY node ORDER BY place) AS rank",
            f"array_min(filter(array({costs}), x -> x IS NOT NULL)).matches AS matches",
        )
        .where(f"place <= size - {needed} + matches")
        .selectExpr(
            "token", "node", "size", "place", "rank", "matches",
            f"{needed} DIV {rule.per_match} AS skipped",
            "row_number() OVER (PARTITION BY node ORDER BY listed DESC, token)"
            f" <= {needed} DIV {rule.per_match} AS skip",
            "count(1) OVER (PARTITION BY node) AS shared",
        )
        .where(f"shared > {needed} DIV {rule.per_match}")
        .drop("shared")
    )
    return entries, often


def _room(rule: JaccardRule) -> str:
    """Whether entries x and y of one token leave room for enough common shingles.

    Before the entry, only shared shingles can be common; after it, no more than either set has.
    """
    common = "(least(x.rank, y.rank) + least(x.size - x.place, y.size - y.place))"
    return f"100 * {common} >= {rule.percent} * (x.size + y.size - {common})"


def _apart(words_held: int = FOLDED_WORDS) -> str:
    """A lower bound of the number of shingles that only one of x and y has."""
    return " + ".join(f"bit_count(x.{name} ^ y.{name})" for name in _bitmap_names(words_held))


def _near(rule: JaccardRule, words_held: int = FOLDED_WORDS) -> str:
    """Whether the bitmaps of x and y leave room for enough common shingles."""
    common = f"((x.size + y.size - ({_apart(words_held)})) DIV 2)"
    return f"100 * {common} >= {rule.percent} * (x.size + y.size - {common})"


def read_sets(docs: DataFrame, ids: DataFrame, rule: JaccardRule) -> DataFrame:
    """The sets of the documents whose ``id`` is given, and of a few others.

    Which texts to read is told by a bitmap of fixed size, so that texts are not shuffled.
    """
    spark = docs.sparkSession
    mask = (1 << FILTER_BITS) - 1
    marked = (
        ids.selectExpr(f"(id & {mask}) DIV 32 AS word", "CAST(id & 31 AS INT) AS bit")
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(CAST(1 AS BIGINT), bit))").alias("bits"))
        .toArrow()
    )
    table = np.zeros((mask + 1) // 32, np.uint32)
    table[marked["word"].to_numpy()] = marked["bits"].to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little"))
    width = rule.width

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            batch = batch.filter(pa.array(bits[ids & mask].astype(bool)))
            sets = shingle_sets(batch.column("text"), width)
            ends = np.concatenate(([0], np.cumsum([len(own) for own in sets]))).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                ],
                ["id", "shingles"],
            )

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(
        read, "id bigint, shingles array<bigint>"
    )


def linked_pairs(pairs: DataFrame, sets: DataFrame, rule: JaccardRule) -> DataFrame:
    """The pairs (a, b) of different ids that are linked, by their whole sets."""
    first = sets.selectExpr("id AS a", "shingles AS x")
    second = sets.selectExpr("id AS b", "shingles AS y")
    common = pairs.join(first, "a").join(second, "b").selectExpr(
        *pairs.columns, "size(x) + size(y) AS sizes", "size(array_intersect(x, y)) AS common"
    )
    return common.where(f"100 * common >= {rule.percent} * (sizes - common)").select(*pairs.columns)


def _entry(bits: list[str]) -> Column:
    return F.struct("place", "size", "rank", *bits)


def _open(lists: DataFrame) -> DataFrame:
    """The lists that have entries outside their leader's component."""
    tokens = lists.where("component != leading").select("token").distinct()
    return lists.join(tokens, "token", "left_semi")


def _delegates(lists: DataFrame, turn: int) -> DataFrame:
    """An entry of each list, picked by digest."""
    chance = F.xxhash64("node", "token", F.lit(turn)).alias("chance")
    left_out = ("token", "node", "matches", "leading", "skip", "skipped")
    own = [name for name in lists.columns if name not in left_out]
    return lists.groupBy("token").agg(F.min(F.struct(chance, "node", *own)).alias("delegate"))


def _alike_lists(weighed: DataFrame) -> DataFrame:
    """One entry per node for all lists that hold the very same nodes.

    Two long near copies share hundreds of shingles that nobody else has; this makes them meet once.
    The first of the shared shingles is the same for all nodes, as their order is, so the least
    place and rank belong together.  Lists are told apart by two digests and their length.
    """
    lists = saved(
        weighed.groupBy("token").agg(
            F.struct(
                F.bit_xor(F.xxhash64("node")).alias("one"),
                F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
                F.count(F.lit(1)).alias("n"),
            ).alias("members"),
            F.max("weight").alias("largest"),
        ),
        "jaccard-members",
    )
    same = ["size", "matches", "skipped", "component", "weight", "largest"]
    return (
        weighed.join(lists, "token")
        .groupBy("members", "node")
        .agg(
            F.min("place").alias("place"),
            F.min("rank").alias("rank"),
            F.count_if(~F.col("skip")).alias("kept"),
            *(F.first(name).alias(name) for name in same),
        )
    )


def _with_label(frame: DataFrame, name: str, merged: DataFrame) -> DataFrame:
    """Replace the components in a column by those they have become part of."""
    labels = merged.select(F.col("node").alias(name), F.col("component").alias("label"))
    return frame.join(labels, name, "left").withColumn(
        name, F.coalesce("label", name)
    ).drop("label")


def _relabelled(lists: DataFrame, merged: DataFrame) -> DataFrame:
    return _with_label(_with_label(lists, "component", merged), "leading", merged)


def _merged(pairs: DataFrame, sets: DataFrame, rule: JaccardRule) -> DataFrame:
    """Compare pairs (a, b) of components (ca, cb); which components are one now."""
    pairs = saved(pairs, "jaccard-candidates")
    links = saved(linked_pairs(pairs, sets, rule).select("ca", "cb"), "jaccard-links")
    merged = saved(components(links, "ca", "cb"), "jaccard-merged")
    drop_saved(pairs, links)
    return merged


def _led(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add to every entry the leader of its token's list, the entry with the smallest place.

    Also returns the table of leaders, which the result reads.
    """
    leaders = saved(
        entries.groupBy("token").agg(
            F.min(F.struct("place", "node", "size", "rank")).alias("leader")
        ),
        "jaccard-leaders",
    )
    return entries.join(leaders, "token"), leaders


def _has_own_ids(ids: DataFrame) -> bool:
    """Whether no id is missing or stands on two rows."""
    counts = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return not counts.where("n > 1 OR doc_id IS NULL").limit(1).count()


def _numbered(docs: DataFrame, number: str) -> DataFrame:
    """The rows as written to the shared folder, so that their numbers stay."""
    return saved(docs.withColumn(number, F.monotonically_increasing_id()), "jaccard-rows")


def similar_documents(
    docs: DataFrame,
    rule: JaccardRule = JaccardRule(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: its id, ``n_shingles`` and ``component_id``, the least id it is linked to."""
    narrow = docs.select(
        column(doc_id).cast("bigint").alias("doc_id"), column(text).alias("text")
    )
    if _has_own_ids(narrow.select("doc_id")):
        found = _linked(narrow, rule)
    else:
        rows = _numbered(narrow, "row")
        linked = _linked(rows.selectExpr("IF(doc_id IS NULL, NULL, row) AS doc_id", "text"), rule)
        known = linked.where("doc_id IS NOT NULL").withColumnsRenamed(
            {"doc_id": "row", "component_id": "component"}
        )
        of_row = saved(known.join(rows.select("row", "doc_id"), "row"), "jaccard-documents")
        least = of_row.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        found = (
            of_row.join(least, "component")
            .select("doc_id", "n_shingles", "component_id")
            .union(linked.where("doc_id IS NULL"))
        )
    return found.withColumnRenamed("doc_id", doc_id)


def _linked(narrow: DataFrame, rule: JaccardRule) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of documents whose ids are their own, or null."""
    bits, whole = _bitmap_names(), _bitmap_names(BITMAP_WORDS)
    classes = frequency_classes(sketch(narrow, rule))
    signed = saved(signatures(narrow, rule, classes), "jaccard-signatures")
    nodes = saved(
        signed.where("size > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("size").alias("size"),
            F.first("prefix").alias("prefix"),
            *(F.first(name).alias(name) for name in whole),
        ),
        "jaccard-nodes",
    )
    entries, often = postings(nodes, rule)
    entries = saved(entries, "jaccard-entries")
    drop_saved(often)
    led, leaders = _led(entries)
    led = saved(led, "jaccard-led")
    drop_saved(entries, leaders)

    bitmaps = nodes.selectExpr("node", "size", *_folded())

    # One comparison per node: with the nearest leader of its entries that leave room.
    x, y = "struct(place, size, rank) AS x", "leader AS y"
    starred = (
        led.where("leader.node != node")
        .selectExpr("node", "leader.node AS other", x, y)
        .where(_room(rule))
        .select("node", "other")
        .distinct()
        .join(bitmaps.select("node", F.struct("size", *bits).alias("x")), "node")
        .join(bitmaps.select(F.col("node").alias("other"), F.struct("size", *bits).alias("y")), "other")
        .where(_near(rule))
        .selectExpr("node", f"struct({_apart()} AS apart, other) AS near")
        .groupBy("node")
        .agg(F.min("near").alias("best"))
        .selectExpr("node AS a", "best.other AS b")
    )
    starred = saved(starred, "jaccard-stars")
    ends = starred.selectExpr("inline(array(struct(a AS id), struct(b AS id)))")
    stars = saved(linked_pairs(starred, read_sets(narrow, ends, rule), rule), "jaccard-links")
    grouped = saved(components(stars, "a", "b"), "jaccard-groups")
    lists = led.join(grouped, "node", "left").selectExpr(
        "token", "node", "size", "place", "rank", "matches", "skip", "skipped",
        "leader.node AS leading",
        "coalesce(component, node) AS component",
    )
    labels = grouped.select(F.col("node").alias("leading"), F.col("component").alias("label"))
    lists = lists.join(labels, "leading", "left").withColumn(
        "leading", F.expr("coalesce(label, leading)")
    )
    known = saved(lists.drop("label"), "jaccard-known")
    lists = saved(_open(known).join(bitmaps.drop("size"), "node"), "jaccard-lists")
    drop_saved(starred, stars, led, known)
    sets = saved(
        read_sets(narrow, lists.select(F.col("node").alias("id")), rule), "jaccard-sets"
    )

    # Then with the nearest of its lists' delegates, which change from round to round.
    merges = []
    for turn in range(rule.rounds):
        delegates = saved(_delegates(lists, turn), "jaccard-delegates")
        near = (
            lists.join(delegates, "token")
            .where("component != delegate.component")
            .select("node", "component", _entry(bits).alias("x"), F.col("delegate").alias("y"))
            .where(f"{_room(rule)} AND {_near(rule)}")
            .selectExpr(
                "node", "component",
                f"struct({_apart()} AS apart, y.node AS other, y.component AS label) AS near",
            )
            .groupBy("node", "component")
            .agg(F.min("near").alias("best"))
            .selectExpr("node AS a", "best.other AS b", "component AS ca", "best.label AS cb")
        )
        merged = _merged(near, sets, rule)
        merges.append(merged)
        relabelled = saved(_relabelled(lists, merged), "jaccard-known")
        drop_saved(lists, delegates)
        lists = saved(_open(relabelled), "jaccard-lists")
        drop_saved(relabelled)

    # What is left: entries outside the largest component of their list, against those of larger
    # components.  So of two nodes always the same one has entries left out.
    sizes = saved(
        lists.select("node", "component").distinct().groupBy("component").agg(
            F.struct(F.count(F.lit(1)).alias("nodes"), "component").alias("weight")
        ),
        "jaccard-sizes",
    )
    weighed = saved(lists.drop("leading").join(sizes, "component"), "jaccard-lists")
    drop_saved(lists, sizes)
    alike = saved(
        _alike_lists(weighed).join(nodes.select("node", *whole), "node"), "jaccard-alike"
    )
    drop_saved(weighed)
    candidates = (
        alike.where("weight < largest AND kept > 0").alias("x")
        .join(
            alike.alias("y"),
            F.expr(
                f"""x.members = y.members AND x.weight < y.weight
                AND {_room(rule)} AND {_near(rule, BITMAP_WORDS)}"""
            ),
        )
        .selectExpr(
            "least(x.node, y.node) AS a",
            "greatest(x.node, y.node) AS b",
            "IF(x.node < y.node, x.component, y.component) AS ca",
            "IF(x.node < y.node, y.component, x.component) AS cb",
            "least(x.matches, y.matches) - x.skipped AS asked",
            "x.kept AS kept",
        )
        .groupBy("a", "b", "ca", "cb")
        .agg(F.sum("kept").alias("n"), F.first("asked").alias("asked"))
        .where("n >= asked")
        .select("a", "b", "ca", "cb")
    )
    merges.append(_merged(candidates, sets, rule))

    of_node = nodes.select("digest", "node").join(grouped, "node", "left").selectExpr(
        "digest", "coalesce(component, node) AS component"
    )
    for merged in merges:
        of_node = _with_label(of_node, "component", merged)
    of_node = saved(of_node.withColumnRenamed("component", "component_id"), "jaccard-classes")
    drop_saved(nodes, grouped, alike, sets, *merges)
    result = (
        signed.where("size > 0 AND doc_id IS NOT NULL")
        .select("doc_id", "size", "digest")
        .join(of_node, "digest")
        .select("doc_id", "size", "component_id")
        .union(
            signed.where("size = 0 OR doc_id IS NULL").selectExpr(
                "doc_id", "size", "doc_id AS component_id"
            )
        )
    )
    return result.select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def one_of_each_group(
    docs: DataFrame,
    rule: JaccardRule = JaccardRule(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents without the near duplicates, with all their columns.

    Of a group the document with the least id stays; an id comes before none, and of rows with one
    id any one stays.  Every row is judged by its own text, rows without an id and rows that share
    one with other texts included.
    """
    ids = docs.select(column(doc_id).cast("bigint").alias("doc_id"))
    if _has_own_ids(ids):
        found = saved(similar_documents(docs, rule, doc_id, text), "jaccard-documents")
        return _without(docs, found.where(column(doc_id) != F.col("component_id")), doc_id)
    row = fresh(docs.columns, "row")
    rows = _numbered(docs, row)
    narrow = rows.select(column(row).alias("doc_id"), column(text).alias("text"))
    order = rows.select(
        column(row).alias("row"),
        F.struct(column(doc_id).isNull(), column(doc_id).cast("bigint"), column(row)).alias("place"),
    )
    grouped = _linked(narrow, rule).where("n_shingles > 0").select(
        F.col("doc_id").alias("row"), "component_id"
    )
    of_row = saved(grouped.join(order, "row"), "jaccard-documents")
    first = of_row.groupBy("component_id").agg(F.min("place").alias("first"))
    dropped = of_row.join(first, "component_id").where("place != first")
    return _without(rows, dropped.select(F.col("row").alias(row)), row).drop(row)


def _without(docs: DataFrame, found: DataFrame, doc_id: str) -> DataFrame:
    """The documents without those whose ids are found.

    A bitmap of fixed size, broadcast as rows of 32 bits, tells which documents may be among them;
    only these texts are shuffled to be compared by id.
    """
    mask = (1 << FILTER_BITS) - 1
    names = [fresh(docs.columns, name) for name in ("dropped_id", "bitmap_word", "bitmap_bits")]
    dropped_id, word, bits = names
    dropped = saved(
        found.select(column(doc_id).cast("bigint").alias(dropped_id)).distinct(), "jaccard-dropped"
    )
    bitmap_rows = saved(
        dropped.selectExpr(
            f"({dropped_id} & {mask}) DIV 32 AS {word}", f"CAST({dropped_id} & 31 AS INT) AS bit"
        )
        .groupBy(word)
        .agg(F.expr("bit_or(shiftleft(CAST(1 AS BIGINT), bit))").alias(bits)),
        "jaccard-bitmap",
    )
    own = column(doc_id).cast("bigint")
    marked = docs.withColumn(word, F.floor(own.bitwiseAND(mask) / 32)).join(
        F.broadcast(bitmap_rows), word, "left"
    )
    bit = F.expr(f"shiftright({bits}, CAST(CAST(`{doc_id}` AS BIGINT) & 31 AS INT)) & 1")
    hit = F.coalesce(bit == 1, F.lit(False))
    maybe = marked.where(hit).join(dropped, own == F.col(dropped_id), "left_anti")
    return marked.where(~hit).union(maybe).select(*map(column, docs.columns))
