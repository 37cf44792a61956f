"""Quality rules against a plain version, and the hosts' say."""

from __future__ import annotations

import random
import re
from collections import Counter

from adloom.llm import quality


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def texts() -> list[str | None]:
    chance = random.Random(3)
    odd = ["a", "b", "cc", "é𝒳", "#", "|", "\n", "\n", " ", "\t", "\x85", "the", "x y z"]
    made = [" ".join(chance.choices(odd, k=chance.randint(0, 60))) for _ in range(120)]
    return [None, "", " \n", "a b", "a b c", "a b c a b c", "x " * 60_000, "line\n" * 3000, *made]


def test_measures_and_base_rules(spark):
    rows = list(enumerate(texts())) + [(7, texts()[7]), (None, "w " * 60)]
    frame = spark.createDataFrame(
        [(k, t, None if k == 3 else "h") for k, t in rows], "doc_id bigint, text string, source string"
    )
    found = quality.judged(frame).collect()
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    expected = Counter()
    for doc_id, text in rows:
        m = measures(text)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        expected[(doc_id, *m, failed)] += 1
    assert Counter((r.doc_id, *(r[n] for n in names), r.base_failed) for r in found) == expected
    assert not any(r.kept and r.base_failed for r in found)


def prose(k: int) -> str:
    return " ".join(f"word{k}x{j}" for j in range(60))


def test_a_host_decides_on_soft_failures(spark):
    symbols = " | ".join(f"cell{j}" for j in range(60))
    rows = [(k, prose(k), "clean") for k in range(400)] + [(1000, symbols, "clean")]
    rows += [(2000 + k, prose(k), "junk") for k in range(5)]
    rows += [(3000 + k, f"{symbols} {k}", "junk") for k in range(100)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id: r.kept for r in quality.judged(frame).collect()}
    assert kept[1000]
    assert all(kept[2000 + k] for k in range(5)) and all(kept[k] for k in range(400))
    assert not any(kept[3000 + k] for k in range(100))


def test_hosts_are_judged_without_a_window_over_all(spark):
    chance = random.Random(5)
    counts = {f"h{k}": chance.randint(1, 60) for k in range(200)}
    fails = {host: min(n, chance.choice([0, 0, 0, 1, n // 2])) for host, n in counts.items()}
    rows = [(host, k < fails[host]) for host, n in counts.items() for k in range(n)]
    rules = quality.QualityRules()
    found = quality.host_verdicts(spark.createDataFrame(rows, "host string, failed boolean"), rules)
    total = sum(counts.values())
    mean = sum(fails.values()) / total
    variance = sum(n * (fails[h] / n - mean) ** 2 for h, n in counts.items()) / total
    strength = min(rules.strongest, max(rules.weakest, mean * (1 - mean) / variance - 1))
    expected = {
        h: (fails[h] + mean * strength) / (n + strength) > rules.host_limit for h, n in counts.items()
    }
    assert {row.host: row.bad_host for row in found.collect()} == expected
    assert set(expected.values()) == {True, False}
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_good_documents_keep_columns(spark):
    rows = [(k, prose(k), None, "w", k % 2 == 0) for k in range(20)] + [(99, "short", None, "w", True)]
    frame = spark.createDataFrame(
        rows, "host bigint, text string, source string, n_words string, soft boolean"
    )
    out = quality.good_documents(frame)
    assert out.columns == frame.columns
    assert {(r.host, r.n_words, r.soft) for r in out.collect()} == {
        (k, "w", k % 2 == 0) for k in range(20)
    }


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert quality.judged(frame).collect() == []
    assert quality.good_documents(frame).collect() == []
