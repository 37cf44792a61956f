"""Fingerprint texts by closed syncmers: anchors that only their own words decide on.

A text is taken as its words, lower-cased; runs of more than 16 characters without white space are
cut into pieces of 16.  Of every five words in a row the four pairs are hashed; the five are an
anchor if the least hash is that of the first or the last pair, the edges.  What stands around them
does not matter, so two texts that share five words agree on whether they are an anchor, wherever
they stand.  Of any four fives in a row at least one is an anchor, as far as hashes differ.

A fingerprint is the sequence of a text's anchors: eight hexadecimal digits of hash and one for the
distance from the anchor before.  So anchors are matched by position, too: two agree if they are the
same words as far behind their forerunner, which holds after a passage has moved as a whole.  A text
with words but without an anchor has one that stands for all its words.

The likeness of two fingerprints is the share of their different anchors that match, 0 to 1; two
empty ones are alike.

To compare every document with its follower, rows are cut into slices by descending id; each
slice also receives the first row of the next one, so one shuffle of the texts is enough.  Ids and
digests are written to the shared folder along with the texts first, which numbers the rows.

Defined cases: a null text is empty; a document without words has an empty fingerprint; a null id
comes after all others; rows with one id are documents each, in order of a hash of their texts;
a lone document follows itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import column, saved
from adloom.operators.slices import slices_of


@dataclass(frozen=True)
class SyncmerRule:
    # Words of an anchor, and of the inner substrings whose least hash must lie at an edge.
    words: int = 5
    inner: int = 2
    # Characters after which a run without white space is cut.
    longest: int = 16
    # Characters of texts in a slice, and the most slices, which are sorted by tasks each.
    slice_chars: int = 2_000_000
    most_slices: int = 20_000


_HASH_DIGITS, _LARGEST_GAP = 8, 15


def with_anchors(
    frame: DataFrame, texts: Sequence[str], names: Sequence[str], rule: SyncmerRule = SyncmerRule()
) -> DataFrame:
    """Add a column of anchors, numbers in order of the text, for each column of texts.

    One step after the other is a column of its own, so that each is worked out once.
    """
    pieces = rf"[^\\x20\\x09-\\x0D]{{{{1,{rule.longest}}}}}"
    k, s = rule.words, rule.inner
    kept = frame.columns

    def added(after: DataFrame, sql: str, step: str) -> DataFrame:
        steps = (f"{sql.format(i=i, text=text)} AS {step}_{i}" for i, text in enumerate(texts))
        return after.selectExpr("*", *steps)

    def row_of(hashes: str, first: int, size: int) -> str:
        return ", ".join(f"{hashes}[j + {place}]" for place in range(first, first + size))

    inner = [f"inner_{{i}}[j + {place}]" for place in range(k - s + 1)]
    within = " AND ".join(f"least({inner[0]}, {inner[-1]}) <= {hash_}" for hash_ in inner[1:-1])
    closed = within or "true"
    gap = f"IF(m = 0, 0, least(j - place_{{i}}[m - 1], {_LARGEST_GAP}))"
    digest = f"(xxhash64({row_of('word_{i}', 0, k)}) & 4294967295)"
    frame = added(
        frame,
        f"transform(regexp_extract_all(lower({{text}}), '{pieces}', 0), w -> xxhash64(w))",
        "word",
    )
    frame = added(
        frame,
        f"IF(size(word_{{i}}) < {k}, array(), transform(sequence(0, size(word_{{i}}) - {s}),"
        f" j -> xxhash64({row_of('word_{i}', 0, s)})))",
        "inner",
    )
    frame = added(
        frame,
        f"IF(size(word_{{i}}) < {k}, array(), filter(sequence(0, size(word_{{i}}) - {k}),"
        f" j -> {closed}))",
        "place",
    )
    frame = added(
        frame,
        f"IF(size(place_{{i}}) = 0, IF(size(word_{{i}}) = 0, array(),"
        f" array((xxhash64(word_{{i}}) & 4294967295) * {_LARGEST_GAP + 1})),"
        f" transform(place_{{i}}, (j, m) -> {digest} * {_LARGEST_GAP + 1} + {gap}))",
        "anchors",
    )
    return frame.selectExpr(
        *(f"`{c}`" for c in kept),
        *(f"CAST(anchors_{i} AS ARRAY<BIGINT>) AS {name}" for i, name in enumerate(names)),
    )


def fingerprint(anchors: str) -> str:
    """The fingerprint of a column of anchors, as SQL."""
    return f"array_join(transform({anchors}, a -> lower(lpad(hex(a), {_HASH_DIGITS + 1}, '0'))), '')"


def likeness(first: str, second: str) -> str:
    """The share of matching anchors of two columns without repeats, as SQL."""
    sizes = f"(size({first}) + size({second}))"
    common = f"size(array_intersect({first}, {second}))"
    return f"IF({sizes} = 0, 1D, 2D * {common} / {sizes})"


def fingerprints(
    docs: DataFrame,
    rule: SyncmerRule = SyncmerRule(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its id and ``fingerprint``."""
    narrow = docs.select(
        column(doc_id).alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text")
    )
    found = with_anchors(narrow, ["text"], ["anchors"], rule)
    return found.selectExpr("doc_id", f"{fingerprint('anchors')} AS fingerprint").withColumnRenamed(
        "doc_id", doc_id
    )


def compared_with_next(
    docs: DataFrame,
    rule: SyncmerRule = SyncmerRule(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: fingerprints of its text and its edited text, and how alike they are.

    The edited text is the text with its last third replaced by the beginning of the next
    document, by descending id; ``near_edited`` and ``near_next`` are the likeness of the text's
    fingerprint to the edited text's and to the next document's.
    """
    rows = saved(
        docs.select(
            column(doc_id).cast("bigint").alias("doc_id"),
            F.coalesce(column(text), F.lit("")).alias("text"),
        ).selectExpr(
            "*",
            "CAST(length(text) AS BIGINT) AS n_chars",
            "doc_id IS NULL AS no_id",
            "coalesce(~doc_id, 0L) AS falling",
            "xxhash64(text) AS tie",
            "monotonically_increasing_id() AS row",
        ),
        "syncmers-rows",
    )
    order = ["no_id", "falling", "tie", "row"]
    chars = rows.agg(F.coalesce(F.sum("n_chars"), F.lit(0))).first()[0]
    wanted = min(rule.most_slices, max(1, -(-chars // rule.slice_chars)))
    slices = slices_of(rows, order, wanted)
    # The first row of a slice also goes to the end of the slice before, that of all to the last.
    own = "struct(slice AS slice, false AS ahead)"
    before = f"struct(pmod(slice - 1, {slices.number}) AS slice, true AS ahead)"
    placed = (
        slices.place(rows, "slice", "begins")
        .selectExpr(
            "doc_id", "text", "n_chars", *order,
            f"inline(IF(begins, array({own}, {before}), array({own})))",
        )
        .repartition("slice")
    )
    window = f"OVER (PARTITION BY slice ORDER BY ahead, {', '.join(order)})"
    cut = "CAST(n_chars DIV 3 AS INT)"
    edited = placed.selectExpr("*", f"lead(text) {window} AS next_text").selectExpr(
        "doc_id", "text", "n_chars", *order, "slice", "ahead",
        f"""IF(ahead, '', concat(left(text, CAST(n_chars AS INT) - {cut}),
            left(next_text, {cut}))) AS edited""",
    )
    found = with_anchors(edited, ["text", "edited"], ["anchors", "edited_anchors"], rule)
    compared = (
        found.selectExpr(
            "doc_id", "n_chars", *order, "slice", "ahead", "edited", "anchors", "edited_anchors",
            "array_distinct(anchors) AS different",
            "array_distinct(edited_anchors) AS edited_different",
        )
        .selectExpr("*", f"lead(different) {window} AS next_different")
        .where("NOT ahead")
    )
    return compared.selectExpr(
        "doc_id",
        "n_chars",
        "lower(sha2(edited, 256)) AS edited_sha256",
        f"{fingerprint('anchors')} AS fingerprint",
        f"{fingerprint('edited_anchors')} AS edited_fingerprint",
        f"{likeness('different', 'edited_different')} AS near_edited",
        f"{likeness('different', 'next_different')} AS near_next",
    ).withColumnRenamed("doc_id", doc_id)
