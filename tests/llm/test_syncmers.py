"""Syncmer fingerprints against a plain version that hashes and compares in Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import pairwise

import pytest
import xxhash

from adloom.llm import registered, syncmers

FOLDER = "/root/testdata/sf0.001"


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def hashed(*values) -> int:
    """Spark's xxhash64 of texts and numbers, one after the other."""
    seed = 42
    for value in values:
        raw = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return signed(seed)


def plain_anchors(text: str | None) -> list[int]:
    words = [hashed(w) for w in re.findall(r"[^\x20\x09-\x0D]{1,16}", (text or "").lower())]
    inner = [hashed(*pair) for pair in pairwise(words)]
    places = [
        j for j in range(len(words) - 4)
        if min(inner[j : j + 4]) in (inner[j], inner[j + 3])
    ]
    if not places:
        return [(hashed(*words) & 0xFFFFFFFF) * 16] if words else []
    found = []
    for m, j in enumerate(places):
        gap = min(15, j - places[m - 1]) if m else 0
        found.append((hashed(*words[j : j + 5]) & 0xFFFFFFFF) * 16 + gap)
    return found


def printed(anchors: list[int]) -> str:
    return "".join(f"{a:09x}" for a in anchors)


def alike(a: list[int], b: list[int]) -> float:
    sizes = len(set(a)) + len(set(b))
    return 2 * len(set(a) & set(b)) / sizes if sizes else 1.0


def brute(docs: list[tuple]) -> Counter:
    def order(row):
        doc_id, text = row
        return (doc_id is None, 0 if doc_id is None else -doc_id, hashed(text or ""))

    rows = sorted(docs, key=order)
    found = Counter()
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        own, new, other = map(plain_anchors, (text, edited, following))
        found[
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(own),
            printed(new), round(alike(own, new), 9), round(alike(own, other), 9),
        ] += 1
    return found


def rows_of(frame) -> Counter:
    assert frame.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint",
                             "edited_fingerprint", "near_edited", "near_next"]
    return Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in frame.collect())


def prose(chance: random.Random, n: int) -> str:
    return " ".join(chance.choice("aAbcdefghé") + str(chance.randrange(300)) for _ in range(n))


def odd_documents(seed: int) -> list[tuple]:
    chance = random.Random(seed)
    docs = [(k * 3, prose(chance, chance.choice([0, 1, 4, 5, 6, 7, 30, 200]))) for k in range(150)]
    docs += [(5, None), (-7, ""), (-(2**63), " \n\t"), (2**63 - 1, "日本語" * 50), (8, "x" * 20_000)]
    docs += [(30, docs[3][1]), (30, "unlike all others"), (30, docs[3][1]), (30, docs[3][1])]
    docs += [(None, prose(chance, 9)) for _ in range(20)] + [(None, "same words here")] * 30
    docs += [(11, "a b c d \U0001f600 É é"), (14, "same line\n" * 40)]
    chance.shuffle(docs)
    return docs


@pytest.mark.parametrize("slice_chars", [8_000_000, 4000, 300])
def test_rows_equal_plain_version(spark, slice_chars):
    docs = odd_documents(2)
    frame = spark.createDataFrame(
        [(i, t, 1, "z", 0) for i, t in docs],
        "doc_id bigint, text string, slice int, anchors string, falling int",
    ).repartition(4)
    rule = syncmers.SyncmerRule(slice_chars=slice_chars)
    assert rows_of(syncmers.compared_with_next(frame, rule)) == brute(docs)


@pytest.mark.parametrize("docs", [[], [(1, "a b c d e f g h")], [(None, None)], [(2, "a"), (1, "")]])
def test_few_rows(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    assert rows_of(syncmers.compared_with_next(frame)) == brute(docs)


def test_fingerprints_equal_plain_version(spark):
    docs = odd_documents(3)
    frame = spark.createDataFrame([(t, i) for i, t in docs], "body string, `doc.id` bigint")
    found = syncmers.fingerprints(frame, doc_id="doc.id", text="body").collect()
    assert Counter(map(tuple, found)) == Counter((i, printed(plain_anchors(t))) for i, t in docs)


@pytest.mark.parametrize("words, inner", [(4, 2), (3, 1), (2, 1), (8, 3), (3, 3)])
def test_other_sizes(spark, words, inner):
    chance = random.Random(words)
    text = prose(chance, 60)
    rule = syncmers.SyncmerRule(words=words, inner=inner)
    frame = spark.createDataFrame([(1, text), (2, "in front " + text)], "doc_id int, text string")
    first, second = (r.fingerprint for r in syncmers.fingerprints(frame, rule).orderBy("doc_id").collect())
    assert len(first) >= 9 and len(first) % 9 == 0
    # The anchors are the same words; only those in front, and one distance, differ.
    assert second.endswith(first[18:])


def test_query_equals_plain_version(spark):
    found = registered.queries()["op12_syncmers"](spark, FOLDER)
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert rows_of(found) == brute([(r.doc_id, r.text) for r in given])


def test_texts_are_shuffled_once_and_no_python_runs(spark):
    frame = spark.createDataFrame([(k, f"w{k} " * 9) for k in range(50)], "doc_id int, text string")
    found = syncmers.compared_with_next(frame, syncmers.SyncmerRule(slice_chars=100))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window") == 2
    assert "Python" not in plan and "Arrow" not in plan


def test_edits_keep_two_thirds_and_unlike_texts_nothing(spark):
    chance = random.Random(9)
    docs = [(k, prose(chance, 400)) for k in range(12)]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    for row in syncmers.compared_with_next(frame).collect():
        assert 0.6 < row.near_edited < 0.72 and row.near_next < 0.02
