"""The pipeline's stages on documents whose fate is known, and the registered queries."""

from __future__ import annotations

import os
import random
from collections import defaultdict

import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from adloom.llm import pii, registered
from compare import connect, duckdb_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = registered.oracle_sql()


@pytest.fixture(scope="module")
def duckdb_tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query_equals_statement(spark, duckdb_tables, name):
    frame = registered.queries()[name](spark, FOLDER)
    names, expected = duckdb_rows(duckdb_tables, STATEMENTS[name])
    assert sorted(frame.columns) == names
    assert spark_rows(frame) == expected


def test_every_operator_is_registered():
    numbers = {name.split("_")[0] for name in entry_points.queries() if name.startswith("op")}
    assert numbers == {f"op{k}" for k in range(1, 14)} and "pipeline" in entry_points.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "pii", "mixing", "packing",
    ]


def prose(seed: int) -> str:
    chance = random.Random(seed)
    return " ".join(f"{chance.choice('abcdefgh')}{chance.randint(0, 9999)}x" for _ in range(80))


def test_each_stage_decides(spark):
    rows = [(k, prose(k), "en", f"s{k % 3}", 0) for k in range(40)]
    rows += [(100, prose(0) + " end", "en", "s0", 0), (101, prose(1), "en", "s1", 0)]
    rows += [(102, "too short", "en", "s1", 0), (103, None, "en", "s1", 0)]
    rows += [(104, prose(104) + " write to ann@mail.example.com", "en", None, 0)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, "")
    kept = {r.doc_id for r in good.collect()}
    assert kept == {r[0] for r in rows} - {102, 103}
    single = stages["near_duplicates"](spark, good, "")
    assert {r.doc_id for r in single.collect()} == kept - {100, 101}
    clean = stages["pii"](spark, single, "")
    texts = {r.doc_id: r for r in clean.collect()}
    assert texts[104].text.endswith("write to [EMAIL]")
    assert all(texts[k].text == prose(k) for k in range(40))
    assert all(r.n_chars == len(r.text) for r in texts.values())
    words = defaultdict(int)
    mix = stages["mixing"](spark, clean, "")
    for row in mix.collect():
        words[row.source] += len(row.text.split())
    total = sum(len(r.text.split()) for r in texts.values())
    assert abs(sum(words.values()) - 1.5 * total) <= 4
    assert all(s.columns == docs.columns for s in (good, single, clean, mix))
    pieces = stages["packing"](spark, mix, "").collect()
    assert len({p.sequence_id for p in pieces}) * 4096 < sum(p.length for p in pieces) + 4096


def test_redaction_learns_from_all_texts(spark, monkeypatch):
    """More texts than a sample of 2,000, each with an address and a number."""
    rows = [(k, f"{prose(k)} user{k}@mail{k % 7}.example.com or +49 30 {1000000 + k}.", 0) for k in range(2600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    seen, trainer = [], pii.GBTClassifier

    class Recorder(trainer):
        def fit(self, dataset):
            weighed = self.isSet(self.weightCol)
            seen.append(dataset.selectExpr(f"sum({self.getWeightCol() if weighed else 1})").first()[0])
            return super().fit(dataset)

    monkeypatch.setattr(pii, "GBTClassifier", Recorder)
    clean = dict(corpus_pipeline.STAGES)["pii"](spark, docs, "").collect()
    examples = pii._examples(pii._known(docs, "text"))
    assert examples.count() == 2600 * (10 + 11)
    assert seen == [examples.where("NOT held_out").count()]
    assert {r.doc_id: r.text for r in clean} == {k: f"{prose(k)} [EMAIL] or [PHONE]." for k, _, _ in rows}


def test_workers_give_freed_memory_back(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "environment", {"MALLOC_ARENA_MAX": "2"})
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    dict(corpus_pipeline.STAGES)["quality"](spark, docs, "")
    names = list(corpus_pipeline.LEAN_WORKERS)

    def told(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.environ.get(n) for n in names])], ["value"])

    found = spark.range(1).mapInArrow(told, "value string").collect()
    expected = corpus_pipeline.LEAN_WORKERS | {"MALLOC_ARENA_MAX": "2"}
    assert [row.value for row in found] == [expected[name] for name in names]


def similarity(a: str, b: str, width: int) -> float:
    x, y = (
        {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
        for words in (a.split(), b.split())
    )
    return len(x & y) / len(x | y)


def test_near_duplicates_equal_all_pairs(spark):
    chance = random.Random(3)
    texts = []
    for group in range(30):
        base = [f"g{group}w{k}" for k in range(chance.choice([60, 100, 140]))]
        for changes in (0, 1, 2, 3, 4):
            copy = base[:]
            for place in chance.sample(range(len(copy)), changes):
                copy[place] = f"c{chance.randrange(10**9)}"
            texts.append(" ".join(copy))
    plain = [f"w{k}" for k in range(100)]
    texts += [" ".join(plain), " ".join(plain[:30] + ["x"] + plain[31:70] + ["y"] + plain[71:])]
    assert similarity(*texts[-2:], 5) == 86 / 106 and similarity(*texts[-2:], 4) == 89 / 105
    chance.shuffle(texts)
    component = list(range(len(texts)))
    between = 0
    for b in range(len(texts)):
        for a in range(b):
            alike = similarity(texts[a], texts[b], 5)
            between += 0.8 <= alike < 0.85
            if alike >= 0.8:
                old, new = sorted((component[a], component[b]), reverse=True)
                component = [new if c == old else c for c in component]
    assert between >= 10
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = corpus_pipeline.without_near_duplicates(spark, frame, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(component))


def test_run_over_the_smallest_tables(spark):
    frame = corpus_pipeline.run(spark, FOLDER)
    assert frame.columns[0] == "doc_id" and frame.count() > 100


def test_empty_documents_pass_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []
