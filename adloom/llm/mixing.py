"""Mix sources to target weights with hash-random keys and distributed prefix sums.

Every document gets a key from a digest of its id.  Within a source, documents count in the order
of (key, id, size); a source is taken in whole epochs and then up to the budget that is left.  The
keys are cut into equal ranges; sums per range, added up per source in two levels, tell in which
range the budget ends, and only the documents of that range are sorted.  So no task ever sees more
than a range of a source, however large the source is, and the result depends on nothing but the
documents.

Defined cases: a null text has no words; a null source is a source of its own, sorted last; a null
id counts as an empty id text; rows that are equal in id and size share what the cut leaves them,
rounded down; an empty table gives an empty result; a source without words has target 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import SPACES, WORD, column, fresh, saved
from adloom.operators.slices import slices_of

# Keys are the first 15 hex digits of a digest.
KEY_BITS = 60


@dataclass(frozen=True)
class MixRule:
    """Weights repeat over the sources in order; ``share`` and ``most`` are multiples of sizes."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    seed: str = "mix"
    # Documents per key range on average over all sources.
    range_rows: int = 256
    # Sources that one task numbers.
    slice_sources: int = 100_000


def document_size(text: str) -> str:
    """Number of words of a text as a SQL expression."""
    return f"CAST(coalesce(regexp_count({text}, '{_sql(WORD)}'), 0) AS BIGINT)"


def random_key(doc_id: str, seed: str) -> str:
    digest = f"md5(concat('{seed}:', coalesce(CAST({doc_id} AS STRING), '')))"
    return f"CAST(conv(substr({digest}, 1, {KEY_BITS // 4}), 16, 10) AS BIGINT)"


def source_key(source: str) -> str:
    """A text that is never null and tells a null source from an empty one."""
    return f"coalesce(concat('s', {source}), 'n')"


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def measure(docs: DataFrame, rule: MixRule, doc_id: str, text: str, source: str) -> DataFrame:
    """The narrow columns that the mix is decided on."""
    return docs.selectExpr(
        f"{_quoted(doc_id)} AS doc_id",
        f"{source_key(_quoted(source))} AS source",
        f"{random_key(_quoted(doc_id), rule.seed)} AS key",
        f"{document_size(_quoted(text))} AS size",
    )


def _weighed(sizes: DataFrame, rule: MixRule) -> DataFrame:
    """One row per source with its weight: sources are numbered slice by slice in their order."""
    order = ("source = 'n'", "source")
    slices = slices_of(sizes, order, math.ceil(sizes.count() / rule.slice_sources))
    placed = saved(slices.place(sizes), "mix-slices")
    # One row per slice.
    before = (
        placed.groupBy("slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr("slice", "sum(n) OVER (ORDER BY slice) - n AS before")
    )
    weights = "array(" + ", ".join(map(str, rule.weights)) + ")"
    number = f"before + row_number() OVER (PARTITION BY slice ORDER BY {', '.join(order)}) - 1"
    return placed.join(before, "slice").selectExpr(
        "source",
        "source_size",
        f"element_at({weights}, CAST(({number}) % {len(rule.weights)} AS INT) + 1) AS weight",
        f"CAST({rule.most} AS DOUBLE) * source_size AS most",
    )


def targets(sizes: DataFrame, rule: MixRule) -> DataFrame:
    """One row per source with its target: weights filled up like water to the sources' limits.

    ``sizes`` has one row per source.  The level rises from where it would be without limits: each
    pass leaves out the sources that it covers and shares out what is left, until none is added.
    The driver sees sums only.
    """
    weighed = saved(_weighed(sizes, rule), "mix-weights")
    level, covered = 0.0, -1
    while level is not None:
        at_limit = f"most / weight < {level!r}D"
        sums = weighed.agg(
            F.count_if(F.expr(at_limit)).alias("covered"),
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.expr(f"IF({at_limit}, source_size, 0)")), F.lit(0)).alias("full"),
            F.sum(F.expr(f"IF({at_limit}, 0, weight)")).alias("free"),
        ).first()
        if sums.covered == covered:
            break
        covered = sums.covered
        # Sums of whole numbers, so that no order of the rows changes the level.
        left = rule.share * sums.total - rule.most * sums.full
        level = max(level, left / sums.free) if sums.free else None
    target = "most" if level is None else f"least(most, weight * {level!r}D)"
    return (
        weighed.selectExpr("source", "source_size", f"{target} AS target")
        .selectExpr("*", "CAST(floor(target + 0.5D) AS BIGINT) AS budget")
        .selectExpr(
            "*", "IF(source_size = 0, 0, CAST(budget DIV source_size AS BIGINT)) AS epochs"
        )
        .selectExpr("*", "budget - epochs * source_size AS left_over")
    )


def cuts(measured: DataFrame, rule: MixRule) -> DataFrame:
    """One row per source: its target, its whole epochs, and where the last epoch is cut.

    Documents before (cut_key, cut_id, cut_size) are taken once more, rows equal to it give
    ``cut_words`` each.
    """
    rows = measured.count()
    bits = max(0, math.ceil(math.log2(max(1, rows) / rule.range_rows)))
    bits = min(bits + bits % 2, KEY_BITS)
    ranged = measured.withColumn("range", F.shiftright("key", KEY_BITS - bits))
    by_range = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    by_range = by_range.withColumn("group", F.shiftright("range", bits // 2))
    by_group = by_range.groupBy("source", "group").agg(F.sum("range_size").alias("group_size"))
    by_source = by_group.groupBy("source").agg(F.sum("group_size").alias("source_size"))
    goals = targets(saved(by_source, "mix-sources"), rule)

    # The group, then the range, in which a source's left-over budget ends.
    ends = (
        by_group.selectExpr(
            "*", "sum(group_size) OVER (PARTITION BY source ORDER BY group) AS group_end"
        )
        .join(goals, "source")
        .where("group_end > left_over")
        .groupBy("source")
        .agg(
            F.min(F.struct("group", "group_end", "group_size")).alias("at"),
            F.first("left_over").alias("left_over"),
        )
        .selectExpr(
            "source", "at.group", "left_over - (at.group_end - at.group_size) AS left_in_group"
        )
    )
    ends = (
        by_range.join(ends, ["source", "group"])
        .selectExpr(
            "*",
            "sum(range_size) OVER (PARTITION BY source, group ORDER BY range) AS range_end",
        )
        .where("range_end > left_in_group")
        .groupBy("source")
        .agg(
            F.min(F.struct("range", "range_end", "range_size")).alias("at"),
            F.first("left_in_group").alias("left_in_group"),
        )
        .selectExpr(
            "source", "at.range", "left_in_group - (at.range_end - at.range_size) AS left_in_range"
        )
    )
    same = "OVER (PARTITION BY source, range, key, doc_id, size)"
    cut = (
        ranged.join(ends, ["source", "range"])
        .selectExpr(
            "*",
            "sum(size) OVER (PARTITION BY source, range ORDER BY key, doc_id, size) AS end",
            f"count(1) {same} AS copies",
        )
        .where("end > left_in_range")
        .groupBy("source")
        .agg(
            F.min(F.struct("key", "doc_id", "size", "end", "copies")).alias("at"),
            F.first("left_in_range").alias("left_in_range"),
        )
        .selectExpr(
            "source",
            "at.key AS cut_key",
            "at.doc_id AS cut_id",
            "at.size AS cut_size",
            "CAST((left_in_range - (at.end - at.size * at.copies)) DIV at.copies AS BIGINT)"
            " AS cut_words",
        )
    )
    return goals.join(cut, "source", "left")


def last_epoch(key: str, doc_id: str, size: str) -> str:
    """Words of a document that its source's last, partial epoch takes, as a SQL expression.

    Nulls compare as in an ascending sort.  Where a source has no cut, its epochs are whole.
    """
    return f"""CASE WHEN cut_key IS NULL OR {key} > cut_key THEN 0
        WHEN {key} < cut_key THEN {size}
        WHEN {doc_id} <=> cut_id THEN CASE WHEN {size} < cut_size THEN {size}
            WHEN {size} = cut_size THEN cut_words ELSE 0 END
        WHEN {doc_id} IS NULL OR {doc_id} < cut_id THEN {size}
        ELSE 0 END"""


def mix_sources(
    docs: DataFrame,
    rule: MixRule = MixRule(),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """What the mix takes of each document, one row per row of ``docs``.

    Returns the id under its name, ``size``, ``source_size``, ``target`` and ``taken``.
    """
    measured = saved(measure(docs, rule, doc_id, text, source), "mix")
    limits = saved(cuts(measured, rule), "mix-cuts")
    return measured.join(limits, "source").selectExpr(
        f"doc_id AS {_quoted(doc_id)}",
        "size",
        "source_size",
        "target",
        f"epochs * size + ({last_epoch('key', 'doc_id', 'size')}) AS taken",
    )


def mixed_documents(
    docs: DataFrame,
    rule: MixRule = MixRule(),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The documents of the mix with all their columns: one row for each time one is taken.

    The document at which a source's budget ends keeps its first words, up to the budget.  The
    limits come from the narrow columns; texts are not shuffled by key.  Documents without words
    are taken in whole epochs only.
    """
    limits = saved(
        cuts(saved(measure(docs, rule, doc_id, text, source), "mix"), rule), "mix-cuts"
    )
    row = fresh(limits.columns, "whole_row")
    packed = docs.select(F.struct(*[column(name) for name in docs.columns]).alias(row))
    inside = {name: f"{row}.{_quoted(name)}" for name in (doc_id, text, source)}
    taken = (
        packed.selectExpr(
            row,
            f"{source_key(inside[source])} AS source",
            f"{random_key(inside[doc_id], rule.seed)} AS key",
            f"{document_size(inside[text])} AS size",
        )
        .join(limits, "source")
        .selectExpr(
            row, "size", "epochs", f"({last_epoch('key', inside[doc_id], 'size')}) AS rest"
        )
        .selectExpr(
            row,
            "explode(concat(array_repeat(size, CAST(epochs AS INT)),"
            " filter(array(rest), x -> x > 0))) AS words",
            "size",
        )
    )
    start = _sql(f"^(?:{SPACES.replace('+', '*')}{WORD})") + "{"
    cut_text = (
        f"IF(words = size, {inside[text]},"
        f" regexp_extract({inside[text]}, concat('{start}', words, '}}+'), 0))"
    )
    return taken.selectExpr(
        *[
            f"{cut_text} AS {_quoted(name)}" if name == text else f"{row}.{_quoted(name)}"
            for name in docs.columns
        ]
    )
