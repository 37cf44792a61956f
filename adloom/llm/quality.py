"""Quality rules per document and per host, with DataFrame functions only.

Each document is measured in one pass over its whole text.  It fails outright with too few words or
mostly repeated ones.  The other rules are soft: good tables or code break them too, so the host
decides.  A host's failure rate is shrunk towards the rate of all hosts with a beta prior whose
strength is fitted to the hosts' own spread.  On a host whose shrunk rate exceeds the limit, a
document that breaks a soft rule is rejected; on a nearly spotless host it is kept.  A document
that breaks no rule stays, whatever its host.

The host of a document is its source.  Defined cases: a null text has no words and fails; a null
host is a host of its own; an empty table gives an empty result; repeated rows count as rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import SPACES, WORD, column, fresh, saved

# The characters that count as symbols.  Fixed by the contract of the result.
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class QualityRules:
    """Limits; shares are percentages and compared in whole numbers."""

    least_words: int = 50
    most_repeated: int = 50
    # Soft rules, as percentages of words, lines or characters per word.
    most_symbols: int = 10
    most_dup_lines: int = 50
    few_dup_lines: int = 3
    least_word_chars: int = 200
    most_word_chars: int = 1200
    # Where fewer of a host's documents fail than this, a soft failure is taken for an exception.
    host_limit: float = 0.05
    # Bounds of the prior's strength in documents.
    weakest: float = 1.0
    strongest: float = 1e6


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def measured(frame: DataFrame, text: str) -> DataFrame:
    """Add the measures of the column ``text`` to a frame that has none of their names.

    ``n_repeat_words``: three-word windows are hashed and sorted with their places; equal
    neighbours are windows that occur twice or more; the words they cover are counted from the
    gaps between their places.  This second part runs only where a window is repeated at all.
    """
    spaces = F.lit(" \t\n\x0b\f\r")
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), spaces)
    line_hashes = f"""transform(filter(split(coalesce({text}, ''), '\\n'),
        x -> x RLIKE {_sql(WORD)}), x -> xxhash64(x))"""
    levels = [
        {"words_": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
            F.split(trimmed, SPACES))},
        {
            "n_words": F.expr("CAST(size(words_) AS BIGINT)"),
            "word_chars": F.expr("CAST(length(array_join(words_, '')) AS BIGINT)"),
            "n_symbols": F.expr(
                f"CAST(coalesce(regexp_count({text}, {_sql(SYMBOLS)}), 0) AS BIGINT)"),
            "lines_": F.expr(line_hashes),
            "windows_": F.expr("""IF(size(words_) < 3, CAST(array() AS array<bigint>),
                transform(sequence(0, size(words_) - 3),
                    i -> xxhash64(words_[i], words_[i + 1], words_[i + 2])))"""),
        },
        {
            "n_lines": F.expr("CAST(size(lines_) AS BIGINT)"),
            "n_dup_lines": F.expr("CAST(size(lines_) - size(array_distinct(lines_)) AS BIGINT)"),
            "sorted_": F.expr("""IF(size(array_distinct(windows_)) = size(windows_), NULL,
                sort_array(transform(windows_, (x, i) -> struct(x AS x, i AS i))))"""),
        },
        {"equal_next_": F.expr("""zip_with(sorted_, slice(sorted_, 2, size(sorted_)),
            (a, b) -> coalesce(a.x = b.x, false))""")},
        {"places_": F.expr("""sort_array(transform(filter(
            arrays_zip(sorted_, equal_next_,
                concat(array(false), slice(equal_next_, 1, size(sorted_) - 1))),
            x -> x.equal_next_ OR x.`2`), x -> x.sorted_.i))""")},
        {"n_repeat_words": F.expr("""CAST(coalesce(aggregate(
            zip_with(places_, slice(places_, 2, size(places_)),
                (a, b) -> coalesce(least(3, b - a), 3)),
            0, (total, x) -> total + x), 0) AS BIGINT)""")},
    ]
    for level in levels:
        frame = frame.withColumns(level)
    return frame.drop("words_", "lines_", "windows_", "sorted_", "equal_next_", "places_")


def base_failed(rules: QualityRules) -> str:
    return (
        f"(n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.most_repeated} * n_words)"
    )


def soft_failed(rules: QualityRules) -> str:
    return f"""(100 * n_symbols > {rules.most_symbols} * n_words
        OR (100 * n_dup_lines > {rules.most_dup_lines} * n_lines
            AND n_dup_lines > {rules.few_dup_lines})
        OR 100 * word_chars < {rules.least_word_chars} * n_words
        OR 100 * word_chars > {rules.most_word_chars} * n_words)"""


def host_verdicts(flags: DataFrame, rules: QualityRules) -> DataFrame:
    """One row per host with ``bad_host``, from a frame with ``host`` and ``failed``.

    The prior's mean is the failure rate of all documents.  Its strength follows from the variance
    of the hosts' rates, weighted by documents: for a beta distribution, mean * (1 - mean) over
    variance, less one.
    """
    hosts = flags.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("bigint")).alias("f")
    )
    strength = f"""least({rules.strongest}D, greatest({rules.weakest}D,
        IF(variance > 0, mean * (1 - mean) / variance - 1, {rules.strongest}D)))"""
    # Two aggregates of one row each; hosts can be too many for a window over all of them.
    hosts = saved(hosts, "quality-counts")
    mean = hosts.selectExpr("CAST(sum(f) AS DOUBLE) / sum(n) AS mean")
    with_mean = hosts.crossJoin(F.broadcast(mean))
    variance = with_mean.selectExpr("sum(n * (f / n - mean) * (f / n - mean)) / sum(n) AS variance")
    return (
        with_mean.crossJoin(F.broadcast(variance))
        .selectExpr("host", "n", "f", "mean", f"{strength} AS strength")
        .selectExpr(
            "host", f"(f + mean * strength) / (n + strength) > {rules.host_limit}D AS bad_host"
        )
    )


def judged(
    docs: DataFrame,
    rules: QualityRules = QualityRules(),
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """Measures and verdict of every document, one row per row of ``docs``.

    The texts are read once; measures are written as a narrow table, which the hosts' rates and
    the verdicts both read.
    """
    narrow = docs.select(
        column(doc_id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), column(host)), F.lit("n")).alias("host"),
        column(text).alias("text"),
    )
    flags = saved(
        measured(narrow, "text")
        .drop("text")
        .selectExpr("*", f"{base_failed(rules)} AS base_failed", f"{soft_failed(rules)} AS soft")
        .withColumn("failed", F.expr("base_failed OR soft")),
        "quality",
    )
    verdicts = saved(host_verdicts(flags, rules), "quality-hosts")
    return flags.join(verdicts, "host").select(
        F.col("doc_id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.expr("NOT base_failed AND NOT (soft AND bad_host)").alias("kept"),
    )


def good_documents(
    docs: DataFrame,
    rules: QualityRules = QualityRules(),
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """The documents that are kept, with all their columns and no others.

    Texts are measured twice instead of being written once more: first for the hosts' rates, then
    to judge each document next to its text.
    """
    row = fresh(["text", "host"], "whole_row")
    packed = docs.select(
        F.struct(*[column(name) for name in docs.columns]).alias(row),
        column(text).alias("text"),
        F.coalesce(F.concat(F.lit("s"), column(host)), F.lit("n")).alias("host"),
    )
    # The generator keeps filters on the flags from being pushed into the measures' expressions,
    # which they would repeat many times over.
    flagged = measured(packed, "text").selectExpr(
        row,
        "host",
        f"inline(array(struct({base_failed(rules)} AS base_failed, {soft_failed(rules)} AS soft)))",
    )
    verdicts = saved(
        host_verdicts(flagged.selectExpr("host", "base_failed OR soft AS failed"), rules),
        "quality-hosts",
    )
    kept = (
        flagged.where("NOT base_failed")
        .join(verdicts, "host")
        .where("NOT (soft AND bad_host)")
    )
    return kept.select(*[F.col(row).getField(name).alias(name) for name in docs.columns])
