"""Tell the language of web pages by combining text with what page and address say.

Four kinds of evidence are multiplied, as if independent given the language:

* the text of the page, by byte trigrams counted in all labelled documents;
* the language that the markup declares;
* the last part of the host name;
* the languages of the other pages of the host, smoothed towards those of its domain, which are
  smoothed towards those of all pages.

How well markup and suffix go with a language, and what hosts write in, is learned from the pages
themselves: the text gives each page a first share of every language, and grouped sums of the
shares give the tables.  A page's own share is taken out of what it is judged by.

Defined cases: a page without visible text is judged by the rest; a null address has no host; markup
without a declared language says nothing; a document without a label or text is not learned from;
without any labelled document every language is null; any number of labels is handled, a block of
them at a time; an empty table gives an empty result.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import column, drop_saved, saved

# Hashed byte trigrams per language; a fixed size.
BUCKETS = 1 << 16

_DROPPED = re.compile(
    r"<!--.*?-->|<(script|style|nav|footer|aside|head)\b.*?</\1\s*>|<div class=\"ad\">.*?</div>",
    re.DOTALL | re.IGNORECASE,
)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.IGNORECASE)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.IGNORECASE)


@dataclass(frozen=True)
class LanguageRule:
    """``trust`` scales the text's log likelihood, as neighbouring trigrams overlap."""

    trust: float = 0.3
    added: float = 0.5
    # Pages that a smoothing step counts as.
    strength: float = 5.0
    # Languages whose counts the driver and the tasks hold at once, 512 KB for each.
    block: int = 64


def visible_text(page: str) -> str:
    """The text between tags outside navigation, scripts and the like."""
    return markup.unescape(_TAG.sub(" ", _DROPPED.sub(" ", page)))


def trigrams(text: bytes) -> np.ndarray:
    """Hash buckets of all byte trigrams of a lower-cased text, runs of blanks taken as one."""
    raw = np.frombuffer(b" " + b" ".join(text.split()) + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    codes = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return ((codes * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def count_trigrams(docs: DataFrame, rule: LanguageRule, text: str, lang: str) -> DataFrame:
    """How often each language's labelled documents hold each trigram bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def summed() -> Iterator[pa.RecordBatch]:
            for language, counts in total.items():
                seen = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([language] * len(seen), pa.string()),
                        pa.array(seen.astype(np.int32)),
                        pa.array(counts[seen]),
                    ],
                    ["lang", "bucket", "n"],
                )
            total.clear()

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for language, own in zip(batch.column("lang").to_pylist(), texts):
                if language not in total and len(total) == rule.block:
                    yield from summed()
                counts = total.setdefault(language, np.zeros(BUCKETS, np.int64))
                counts += np.bincount(trigrams(own.lower().encode()), minlength=BUCKETS)
        yield from summed()

    labelled = docs.select(column(text).alias("text"), column(lang).alias("lang"))
    return (
        labelled.where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def learn_block(counted: DataFrame, languages: list[str], rule: LanguageRule) -> np.ndarray:
    """The log probability of each trigram bucket in each of a block of languages."""
    found = counted.where(F.col("lang").isin(languages)).toArrow()
    place = {language: k for k, language in enumerate(languages)}
    counts = np.full((len(languages), BUCKETS), rule.added)
    rows = np.fromiter((place[name] for name in found["lang"].to_pylist()), np.int64, len(found))
    np.add.at(counts, (rows, found["bucket"].to_numpy()), found["n"].to_numpy())
    return np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _said_by_page(page: str | None, url: str | None) -> dict[str, str | None]:
    declared, host = _DECLARED.search(page or ""), _HOST.match(url or "")
    name = host[1].lower().rstrip(".") if host else None
    parts = name.split(".") if name else []
    return {
        "declared": declared[1].lower() if declared else None,
        "host": name,
        "domain": ".".join(parts[-2:]) or None,
        "suffix": parts[-1] if parts else None,
    }


def _read_pages(pages: DataFrame) -> DataFrame:
    """What each page says: how often each trigram bucket occurs, its markup, its address."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column("html").to_pylist()
            said = [_said_by_page(*row) for row in zip(html, batch.column("url").to_pylist())]
            found = [
                np.unique(trigrams(visible_text(page or "").lower().encode()), return_counts=True)
                for page in html
            ]
            ends = np.cumsum([0, *(len(buckets) for buckets, _ in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    *(
                        pa.ListArray.from_arrays(
                            pa.array(ends),
                            pa.array(np.concatenate([np.zeros(0), *parts]).astype(np.int32)),
                        )
                        for parts in (list(p) for p in (zip(*found) if found else ((), ())))
                    ),
                    *(
                        pa.array([row[name] for row in said], pa.string())
                        for name in ("declared", "host", "domain", "suffix")
                    ),
                ],
                ["page_id", "buckets", "times", "declared", "host", "domain", "suffix"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(
        read,
        f"page_id {kind}, buckets array<int>, times array<int>, declared string, host string,"
        " domain string, suffix string",
    )


def _with_likelihoods(read: DataFrame, model: np.ndarray, rule: LanguageRule) -> DataFrame:
    """Add the text's log likelihood in a block of languages to ``likely``."""
    shared = read.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            scores = [
                np.concatenate(
                    (
                        known.values.to_numpy(),
                        rule.trust
                        * (times.values.to_numpy().astype(np.float64) @ table[buckets.values]),
                    )
                )
                for known, buckets, times in zip(
                    batch.column("likely"), batch.column("buckets"), batch.column("times")
                )
            ]
            place = batch.schema.get_field_index("likely")
            yield batch.set_column(place, "likely", pa.array(scores, pa.list_(pa.float64())))

    return read.mapInArrow(score, read.schema)


def identify_languages(
    pages: DataFrame,
    docs: DataFrame,
    rule: LanguageRule = LanguageRule(),
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """One row per page: its id, ``lang``, ``probability``, ``text_lang``, ``declared``, ``host``."""
    counted = saved(count_trigrams(docs, rule, text, lang), "language-counts")
    languages = sorted(row.lang for row in counted.select("lang").distinct().collect())
    narrow = pages.select(
        column(page_id).alias("page_id"), column(url).alias("url"), column(html).alias("html")
    )
    if not languages:
        return narrow.selectExpr(
            f"page_id AS `{page_id}`", "CAST(NULL AS STRING) AS lang",
            "CAST(NULL AS DOUBLE) AS probability", "CAST(NULL AS STRING) AS text_lang",
            "CAST(NULL AS STRING) AS declared", "CAST(NULL AS STRING) AS host",
        )
    read = _read_pages(narrow).withColumn("likely", F.expr("CAST(array() AS array<double>)"))
    for first in range(0, len(languages), rule.block):
        model = learn_block(counted, languages[first : first + rule.block], rule)
        # Each block's result is a table, so that tasks hold one block's model.
        scored_pages = saved(_with_likelihoods(read, model, rule), "language-pages")
        if first:
            drop_saved(read)
        read = scored_pages
    read = (
        read.drop("buckets", "times")
        .withColumn("top", F.expr("array_max(likely)"))
        .withColumn("share", F.expr("transform(likely, x -> exp(x - top))"))
        .withColumn("total", F.expr("aggregate(share, 0D, (sum, x) -> sum + x)"))
        .withColumn("share", F.expr("transform(share, x -> x / total)"))
        .drop("top", "total")
    )

    def sums(frame: DataFrame, shares: str, name: str, *keys: str) -> DataFrame:
        """Grouped sums of the shares of the rows that have the keys, as one array each."""
        known = frame.where(" AND ".join(f"{key} IS NOT NULL" for key in keys) or "true")
        added = (
            known.select(*keys, F.posexplode(shares).alias("k", "own"))
            .groupBy(*keys, "k")
            .agg(F.sum("own").alias("own"))
        )
        ordered = F.array_sort(F.collect_list(F.struct("k", "own")))
        return added.groupBy(*keys).agg(F.transform(ordered, lambda x: x["own"]).alias(name))

    # Domains and all pages are summed from the sums of hosts; hosts take their domain's sums
    # along, so that pages join once by host.
    hosts = saved(sums(read, "share", "of_host", "host", "domain"), "language-by-host")
    of_domain = sums(hosts, "of_host", "of_domain", "domain")
    by_host = saved(hosts.join(of_domain, "domain").drop("domain"), "language-hosts")
    by_declared = saved(sums(read, "share", "of_declared", "declared"), "language-declared")
    by_suffix = saved(sums(read, "share", "of_suffix", "suffix"), "language-suffixes")
    kinds = {"declared": by_declared.count(), "suffix": by_suffix.count()}
    # One row: totals of all pages, and the names of the languages.
    whole = saved(
        sums(read, "share", "whole").withColumn("names", F.lit(languages)), "language-totals"
    )
    joined = (
        read.join(by_host, "host", "left")
        .join(by_declared, "declared", "left")
        .join(by_suffix, "suffix", "left")
    )
    a, s = rule.added, rule.strength

    def said(kind: str) -> str:
        return f"""IF({kind} IS NULL, 0D, ln((greatest(0D, of_{kind}[i] - own) + {a})
            / (greatest(0D, whole[i] - own) + {a} * {kinds[kind]})))"""

    size = "aggregate({0}, 0D, (total, x) -> total + x)"
    everywhere = f"""((greatest(0D, whole[i] - own) + {a})
        / ({size.format("whole")} + {a} * {len(languages)}))"""
    in_domain = f"""((greatest(0D, coalesce(of_domain[i] - own, 0D)) + {s} * {everywhere})
        / (coalesce(domain_size, 1D) - 1 + {s}))"""
    in_host = f"""((greatest(0D, coalesce(of_host[i] - own, 0D)) + {s} * {in_domain})
        / (coalesce(host_size, 1D) - 1 + {s}))"""
    scored = (
        joined.crossJoin(F.broadcast(whole))
        .withColumn("domain_size", F.expr(size.format("of_domain")))
        .withColumn("host_size", F.expr(size.format("of_host")))
        .withColumn(
            "score",
            F.expr(
                f"transform(share, (own, i) -> likely[i] + ln({in_host}) + {said('declared')}"
                f" + {said('suffix')})"
            ),
        )
    )
    return scored.selectExpr(
        "*",
        "array_max(score) AS best",
    ).selectExpr(
        f"page_id AS `{page_id}`",
        "names[CAST(array_position(score, best) - 1 AS INT)] AS lang",
        "1 / aggregate(score, 0D, (total, x) -> total + exp(x - best)) AS probability",
        "IF(array_min(share) = array_max(share) AND size(share) > 1, NULL,"
        " names[CAST(array_position(share, array_max(share)) - 1 AS INT)]) AS text_lang",
        "declared",
        "host",
    )
