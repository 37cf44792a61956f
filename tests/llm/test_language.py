"""Language of pages: accuracy on held-out texts, and what the other evidence does."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from adloom.llm import language

DOCS = "doc_id bigint, text string, lang string"
PAGES = "page_id bigint, url string, html string, host string"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def page(text: str, declared: str | None = None) -> str:
    attribute = f' lang="{declared}-XX"' if declared else ""
    return f"<html{attribute}><head><title>t</title></head><script>var the=1</script><p>{text}</p>"


def test_held_out_texts(spark, labelled):
    train = labelled.where("doc_id % 2 = 0")
    rest = labelled.where("doc_id % 2 = 1 AND length(text) > 200").limit(300).collect()
    rows = [(r.doc_id, f"http://h{r.doc_id}.example.org/x", page(r.text[:400]), r.lang) for r in rest]
    found = language.identify_languages(spark.createDataFrame(rows, PAGES), train).collect()
    truth = {r.doc_id: r.lang for r in rest}
    right = sum(r.lang == truth[r.page_id] for r in found)
    assert len(found) == len(rows) and right >= 0.97 * len(rows)


def test_markup_suffix_and_host_decide_without_text(spark, labelled):
    texts = {lang: [r.text[:600] for r in labelled.where(f"lang = '{lang}' AND length(text) > 300")
                    .limit(30).collect()] for lang in ("de", "fr")}
    rows, number = [], 0
    for lang in ("de", "fr"):
        for text in texts[lang]:
            rows.append((number, f"https://www.site-{lang}.{lang}/{number}", page(text, lang), "x"))
            number += 1
    rows += [
        (900, "https://other.net/a", page("", "de"), "x"),
        (901, "https://new.fr/a", page(""), "x"),
        (902, "https://blog.site-de.de/a", page("12345"), None),
        (903, None, None, None),
        (904, "not an address", "", None),
        (905, "https://www.site-fr.fr/a", page(texts["de"][0] * 3, "fr"), "x"),
        (905, "https://www.site-fr.fr/a", page(texts["de"][0] * 3, "fr"), "x"),
    ]
    found = language.identify_languages(spark.createDataFrame(rows, PAGES), labelled).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert [by_id[k].lang for k in (900, 901, 902)] == ["de", "fr", "de"]
    assert by_id[903].lang is not None and by_id[903].host is None
    assert by_id[905].lang == "de" and by_id[905].declared == "fr"
    assert all(0 < r.probability <= 1 for r in found)


def buckets(text: str) -> Counter:
    raw = b" " + b" ".join(text.lower().encode().split()) + b" "
    codes = (int.from_bytes(raw[k : k + 3], "big") for k in range(len(raw) - 2))
    return Counter((code * 2654435761 % 2**32) >> 16 for code in codes)


def by_hand(docs, pages, rule) -> Counter:
    """Languages and probabilities, with the shares of all other pages added up for each page."""
    names = sorted({lang for _, text, lang in docs if lang is not None and text is not None})
    counts = {name: Counter() for name in names}
    for _, text, lang in docs:
        if lang in counts and text is not None:
            counts[lang] += buckets(text)
    size = {n: sum(counts[n].values()) + rule.added * language.BUCKETS for n in names}
    read = []
    for page_id, url, html, _ in pages:
        found = buckets(language.visible_text(html or ""))
        likely = [
            rule.trust * sum(
                times * math.log((counts[n][b] + rule.added) / size[n]) for b, times in found.items()
            )
            for n in names
        ]
        total = sum(math.exp(x - max(likely)) for x in likely)
        declared = re.search(r'lang="([a-z]+)', html or "")
        host = url.split("/")[2] if url and "//" in url else None
        read.append({
            "id": page_id, "likely": likely, "declared": declared and declared[1], "host": host,
            "share": [math.exp(x - max(likely)) / total for x in likely],
            "domain": host and ".".join(host.split(".")[-2:]), "suffix": host and host.split(".")[-1],
        })
    kinds = {key: len({p[key] for p in read if p[key]}) for key in ("declared", "suffix")}
    result = Counter()
    for own in read:
        others = [p for p in read if p is not own]

        def of(key, i):
            alike = others if key is None else [p for p in others if own[key] and p[key] == own[key]]
            return sum(p["share"][i] for p in alike), len(alike)

        scores = []
        for i in range(len(names)):
            everywhere = (of(None, i)[0] + rule.added) / (len(read) + rule.added * len(names))
            near, alike = of("domain", i)
            near = (near + rule.strength * everywhere) / (alike + rule.strength)
            here, alike = of("host", i)
            score = own["likely"][i] + math.log((here + rule.strength * near) / (alike + rule.strength))
            for key in ("declared", "suffix"):
                if own[key]:
                    score += math.log((of(key, i)[0] + rule.added)
                                      / (of(None, i)[0] + rule.added * kinds[key]))
            scores.append(score)
        best = max(scores)
        chance = 1 / sum(math.exp(x - best) for x in scores)
        result[own["id"], names[scores.index(best)], round(chance, 4)] += 1
    return result


def test_scores_equal_those_by_hand(spark, labelled):
    """With blocks of one, of a few and of all languages."""
    chance = random.Random(4)
    known = labelled.where("lang IS NOT NULL AND length(text) > 50").limit(80).collect()
    docs = [(r.doc_id, r.text[:300], r.lang) for r in known]
    docs += [(900 + k, f"{'abc'[k % 3]}x{k} " * 9, f"own-{k}") for k in range(9)]
    docs += [(1, None, "none"), (2, "text", None)]
    pages = []
    for k in range(60):
        words = chance.choice(docs[:-2])[1].split()
        html = page(" ".join(words[: chance.choice([0, 1, 2, 4])]), chance.choice(["de", "en", None]))
        host = chance.choice(["a.one.de", "b.one.de", "a.two.org", "lone.fr", "x.net"])
        pages.append((k, f"http://{host}/{k}" if k % 9 else None, html, "x"))
    pages += [pages[3], (None, None, None, None)]
    frame, given = spark.createDataFrame(pages, PAGES), spark.createDataFrame(docs, DOCS)
    for block in (1, 4, 64):
        rule = language.LanguageRule(block=block)
        found = language.identify_languages(frame, given, rule).collect()
        got = Counter((r.page_id, r.lang, round(r.probability, 4)) for r in found)
        expected = by_hand(docs, pages, rule)
        assert sum(got.values()) == len(pages)
        assert [(a, b) for a, b, _ in sorted(got.elements(), key=str)] == [
            (a, b) for a, b, _ in sorted(expected.elements(), key=str)
        ]
        chances = [sorted(c for *_, c in x.elements()) for x in (got, expected)]
        assert chances[0] == pytest.approx(chances[1], abs=2e-4)


def test_many_labels(spark):
    """More labels than fit a block, and than any that the driver could hold as one table."""
    docs = spark.range(700).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 30) AS text",
                                       "concat('l', id) AS lang")
    rows = [(1, None, page("w321 " * 30), "x"), (2, None, page("w7 " * 30), "x")]
    found = language.identify_languages(spark.createDataFrame(rows, PAGES), docs).collect()
    assert {r.page_id: r.lang for r in found} == {1: "l321", 2: "l7"}


def test_visible_text():
    html = "a<!-- x --><nav>b</nav><STYLE>c</STYLE><p>d &amp; e</p><script>f<g</script>"
    assert language.visible_text(html).split() == ["a", "d", "&", "e"]


def test_empty_tables(spark, labelled):
    none = spark.createDataFrame([], PAGES)
    assert language.identify_languages(none, labelled).collect() == []
    unlabelled = spark.createDataFrame([(1, "text", None), (2, None, "en")], DOCS)
    rows = spark.createDataFrame([(1, "http://a.b/", "<p>x", "h")], PAGES)
    row = language.identify_languages(rows, unlabelled).first()
    assert (row.page_id, row.lang) == (1, None)
