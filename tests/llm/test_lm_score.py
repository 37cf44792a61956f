"""Scores against counting by hand and against all segmentations written out."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
import sentencepiece

from adloom.llm import lm_score


@pytest.fixture(scope="module")
def rule():
    return lm_score.LatticeRule.from_file()


def all_ways(model: lm_score.Lattice, text: str) -> float:
    """Probability of a text, summed over every way to cut it."""
    if not text:
        return 1.0
    total = 0.0
    for end in range(1, len(text) + 1):
        if text[:end] in model.pieces:
            total += math.exp(model.pieces[text[:end]]) * all_ways(model, text[end:])
    if text[0] not in model.pieces:
        spelled = sum(model.spelled[b] for b in text[0].encode())
        total += math.exp(spelled) * all_ways(model, text[1:])
    return total


def test_forward_recursion_sums_all_segmentations():
    names = [lm_score.WORD_START, "a", "b", "ab", lm_score.WORD_START + "a", "ba", "bab"]
    pieces = {name: math.log(0.05 * (k + 1)) for k, name in enumerate(names)}
    model = lm_score.Lattice(pieces, [math.log(0.001)] * 256, max(map(len, pieces)))
    for word in ("a", "ab", "abab", "babab", "aéb", "𝒳"):
        expected = all_ways(model, lm_score.WORD_START + word)
        assert model.log_probability(word) == pytest.approx(math.log(expected))
    assert model.log_probability("ab" * 5000) > -math.inf


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def test_scores_of_documents(spark, rule, monkeypatch):
    monkeypatch.setattr(lm_score, "HOT_WORDS", 6)
    texts = {k: f"The cat {k % 7} sat, the DOG{k % 11} ran é{k}" for k in range(60)}
    texts |= {60: None, 61: "", 62: " \n\t ", 63: "x" * 30_000, 64: "the " * 20_000}
    rows = [(k, t, "n") for k, t in texts.items()] + [(None, "the cat", "n"), (3, texts[3], "n")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    found = lm_score.score_documents(frame, rule).collect()
    assert len(found) == len(rows)
    words = [(k, (t or "").encode().lower().split()) for k, t, _ in rows]
    counts = Counter()
    for doc_id, own in words:
        if not held_out(doc_id):
            counts.update([*own, None])
    total, different = sum(counts.values()), len(counts)
    expected = Counter()
    for doc_id, own in words:
        own = [*own, None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (different + 1))) for w in own)
        known = sum(counts[w] > 0 for w in own)
        expected[doc_id, held_out(doc_id), len(own), known, total, round(base, 6)] += 1
    got = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    )
    assert got == expected
    by_id = {r.doc_id: r.score for r in found}
    assert all(score < 0 for score in by_id.values())
    assert by_id[60] == by_id[61] == by_id[62] > by_id[None] > by_id[63]


def test_document_scores_equal_the_model_by_hand(spark, rule, monkeypatch):
    """Pieces counted with the vocabulary's own cut, all segmentations of each word summed."""
    monkeypatch.setattr(lm_score, "HOT_WORDS", 4)
    texts = {k: f"The cat {k % 5} sat, naïve 世界{k % 3} don't" for k in range(25)}
    texts |= {25: None, 26: " ", 27: "tokenization of \U0001d4b3 unseen-words"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    own = sentencepiece.SentencePieceProcessor(model_proto=rule.model)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = {k: (t or "").translate(lower).split() for k, t in texts.items()}
    counts = Counter()
    for doc_id, found in words.items():
        if not held_out(doc_id):
            counts[own.eos_id()] += 1
            counts.update(piece for word in found for piece in own.encode(word))
    total = sum(counts.values()) + 0.5 * own.get_piece_size()
    chance = {own.id_to_piece(p): (counts[p] + 0.5) / total for p in range(own.get_piece_size())}
    usual = {
        name: math.log(chance[name])
        for p, name in ((p, own.id_to_piece(p)) for p in range(own.get_piece_size()))
        if not (own.is_byte(p) or own.is_control(p) or own.is_unknown(p))
    }
    bytes_ = [math.log(chance.get(f"<0x{b:02X}>", 1.0)) for b in range(256)]
    model = lm_score.Lattice(usual, bytes_, 1)
    end = math.log10(chance[own.id_to_piece(own.eos_id())])
    for row in lm_score.score_documents(frame, rule).collect():
        expected = end + sum(
            math.log10(all_ways(model, lm_score.WORD_START + word)) for word in words[row.doc_id]
        )
        assert row.score == pytest.approx(expected, rel=1e-9)


def test_a_text_like_the_training_texts_scores_higher(spark, rule):
    rows = [(k, "the cat sat on the mat") for k in range(40)]
    rows += [(1000, "the cat sat on the mat"), (1001, "zqx vvk jjw pfff xx qqqqq")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    scores = {r.doc_id: r.score for r in lm_score.score_documents(frame, rule).collect()}
    assert scores[1000] > scores[1001] + 10


def test_empty_table_and_no_training_documents(spark, rule):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm_score.score_documents(empty, rule).collect() == []
    lone = next(k for k in range(100) if held_out(k))
    frame = spark.createDataFrame([(lone, "a b")], "doc_id bigint, text string")
    row = lm_score.score_documents(frame, rule).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (3, 0, 0, True)
