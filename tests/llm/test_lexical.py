"""Ranked documents against plain scoring of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from adloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top: int = 50) -> list[tuple]:
    counts = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    counts = [(doc_id, own) for doc_id, own in counts if own]
    n_docs, n_terms = len(counts), sum(own.total() for _, own in counts)
    holding = Counter(term for _, own in counts for term in own)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(plain_terms(text))
    rows = []
    for item, query in asked.items():
        scored = []
        for doc_id, own in counts:
            m = 100 - 50 + (50 * own.total() * n_docs) // n_terms
            score = 0
            for term in query & set(own):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                score += w * ((10**9 * own[term]) // (1000 * own[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:top], 1):
            rows.append((item, rank, doc_id, -score))
    return rows


def rows_of(found) -> Counter:
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in found.collect())


def collection(seed: int, n: int) -> tuple[list, list]:
    """Terms of very unequal frequency, ties, repeated rows, odd characters, null ids and texts."""
    chance = random.Random(seed)
    usual = [f"t{k}" for k in range(400)] + ["Straße", "ÄÖ", "É", "naïve", "x y", "日本語", "٣"]
    weights = [1 / (k + 1) for k in range(len(usual))]

    def text(length: int) -> str:
        found = chance.choices(usual, weights, k=length)
        return "".join(w + chance.choice([" ", ", ", "-", "\n", "_", "\x00", "'"]) for w in found)

    docs = [(k, text(chance.choice([1, 3, 20, 60, 200]))) for k in range(n)]
    docs += [(n + k, docs[k % 7][1]) for k in range(120)]
    docs += [(5, "T0 t1"), (5, "T0 t1"), (None, docs[0][1]), (None, docs[0][1]), (None, None)]
    docs += [(-1, ""), (-2, None), (-3, " .,-"), (-4, "t0 " * 5000), (-5, "T399t399")]
    chance.shuffle(docs)
    items = [(k, text(chance.choice([1, 2, 8, 30]))) for k in range(25)]
    items += [(100, ""), (101, None), (102, "unheard of"), (103, "t0"), (103, "t1 t399"),
              (None, "t3 t5"), (None, "ÄÖ"), (104, " ".join(usual)), (105, "t0 t0 T0")]
    return docs, items


@pytest.mark.parametrize(
    "rule",
    [
        lexical.SearchRule(),
        lexical.SearchRule(shard_documents=100, block=8, short=0.1, block_terms=60, parts=3),
        lexical.SearchRule(top=3, shard_documents=40, shard_entries=500, block=16, short=0.0),
        lexical.SearchRule(top=7, shard_documents=250, block=4, short=1.0),
    ],
)
def test_ranks_equal_brute_force(spark, rule):
    docs, items = collection(4, 900)
    frame = spark.createDataFrame(
        [(i, t, 7, "y") for i, t in docs], "doc_id bigint, text string, n int, terms string"
    ).repartition(3)
    asked = spark.createDataFrame(
        [(i, t, 1) for i, t in items], "item_id int, text string, rank int"
    )
    found = rows_of(lexical.best_documents(frame, asked, rule))
    assert found == Counter(brute(docs, items, rule.top))


def test_terms_are_cut_and_lowered_as_stated():
    texts = ["Ab-c_D9 éÉ x\u0085y", None, "", "...", "A" * 70000, "\x7f\x80"]
    bounds, flat = lexical.terms(pa.array([*texts, "skipped"])[:-1])
    found = flat.to_pylist()
    cut = [found[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert cut == [plain_terms(text) for text in texts]


def test_blocks_are_skipped():
    """Most blocks of a long list are never read once good documents are found."""
    rule = lexical.SearchRule(top=5, block=16)
    n = 4000
    rare = np.arange(5) * 3
    ids = np.arange(n)
    terms = np.concatenate([np.array([0, 1]) if k in set(rare) else np.array([0]) for k in ids])
    ends = np.concatenate(([0], np.cumsum([2 if k in set(rare) else 1 for k in ids])))
    shard = lexical.Shard(ids, np.zeros(n, bool), np.full(n, 100), ends, terms.astype(np.int32),
                          np.ones(len(terms), np.int32), np.array([100, 5000]), rule)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            read.append(key)
            return np.asarray(self).__getitem__(key)

    shard.long_given = shard.long_given.view(Watched)
    best = lexical.Best(5)
    shard.search(np.array([0, 1], np.int32), best)
    assert best.ids.tolist() == rare.tolist() and len(read) == 1


def test_long_documents_do_not_overflow():
    n = np.array([0, 10**6])
    assert lexical.norms(n, 10**12, 10**15).tolist() == [50, 50 + 50 * 1000]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.best_documents(docs, items).collect() == []
    full = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    assert lexical.best_documents(full, items.where("false")).collect() == []
    assert len(lexical.best_documents(full, items).collect()) == 1
