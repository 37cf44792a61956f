"""Similar documents against all pairs, and the components of their links."""

from __future__ import annotations

import random
from collections import Counter

from adloom.llm import jaccard
from adloom.llm.components import components


def shingles(text: str | None) -> set:
    words = (text or "").encode().lower().split()
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 4]) for k in range(len(words) - 3)}


def least_reachable(nodes, links) -> dict:
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def brute(rows) -> Counter:
    """Every row is a node of its own."""
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    links = []
    for k, (a, x) in enumerate(sets):
        for m, (b, y) in enumerate(sets[:k]):
            if None not in (a, b) and x and y and 100 * len(x & y) >= 85 * len(x | y):
                links.append((k, m))
    node = least_reachable(range(len(sets)), links)
    least: dict = {}
    for k, (d, _) in enumerate(sets):
        if d is not None:
            least[node[k]] = min(d, least.get(node[k], d))
    return Counter((d, len(s), least.get(node[k])) for k, (d, s) in enumerate(sets))


def near_copies(chance: random.Random) -> list[tuple]:
    """Groups with few to many changes, passages that many share, copies, and chains."""
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(chance.choices(vocabulary, k=60))
    texts = []
    for size in (2, 3, 8, 60):
        base = chance.choices(vocabulary, k=120)
        for _ in range(size):
            copy = base[:]
            for _ in range(chance.choice([0, 1, 2, 3, 5, 9])):
                copy[chance.randrange(len(copy))] = chance.choice(vocabulary)
            texts.append(" ".join(copy))
    chain = chance.choices(vocabulary, k=150)
    for k in range(12):
        chain = chain[:]
        chain[10 * k + 5] = "changed"
        texts.append(" ".join(chain))
    for _ in range(40):
        texts.append(" ".join(chance.choices(vocabulary, k=chance.randint(1, 150))) + " " + passage)
    texts += [passage] * 25 + ["A b", "a  B", "a b c", "a b c d", "a b c d e", "", " ", None, None]
    texts += [("The quick " * 3).strip(), ("tHE qUICK " * 3).strip(), "x " * 20_000]
    chance.shuffle(texts)
    return list(enumerate(texts))


def test_links_equal_all_pairs(spark):
    for seed in (1, 2):
        rows = near_copies(random.Random(seed))
        rows += [(3, rows[3][1]), (None, rows[5][1]), (None, None)]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = jaccard.similar_documents(frame).collect()
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in found)
        assert got == brute(rows)


def test_rows_that_share_an_id_are_documents_each(spark):
    """A third of the ids stand on rows with other texts."""
    rows = [(k % 110 if k % 11 else None, text) for k, text in near_copies(random.Random(6))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = jaccard.similar_documents(frame).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def test_removal_judges_rows_by_their_own_texts(spark):
    def prose(seed):
        return " ".join(f"w{random.Random(seed * 1000 + k).randrange(10**6)}" for k in range(40))

    rows = [(1, prose(1)), (1, prose(2)), (1, prose(1) + " end"), (2, prose(2) + " end"),
            (None, prose(3)), (None, prose(3)), (None, prose(3) + " end"), (None, prose(1)),
            (7, prose(4)), (None, prose(4)), (3, ""), (3, ""), (None, None), (None, None), (4, None)]
    rows += [(k, prose(100 + k)) for k in range(20)]
    chance = random.Random(1)
    chance.shuffle(rows)
    frame = spark.createDataFrame([(t, i, 5) for i, t in rows], "text string, `doc.id` int, row int")
    kept = jaccard.one_of_each_group(frame, doc_id="doc.id")
    assert kept.columns == frame.columns
    left = Counter((r["doc.id"], r.text) for r in kept.collect())
    single = Counter(rows)
    del single[(2, prose(2) + " end")], single[(None, prose(1))], single[(None, prose(4))]
    groups = [[(1, prose(1)), (1, prose(1) + " end")], [(None, prose(3)), (None, prose(3) + " end")]]
    for group in groups:
        assert sum(left.pop(row, 0) for row in group) == 1
        for row in group:
            del single[row]
    assert left == single


def test_results_do_not_depend_on_the_costs(spark):
    rows = near_copies(random.Random(4))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for rule in (
        jaccard.JaccardRule(per_match=10**6, extra_matches=0, rounds=0),
        jaccard.JaccardRule(per_match=6, extra_matches=12, compare_cost=5000, rounds=1),
    ):
        found = jaccard.similar_documents(frame, rule).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def test_one_of_each_group_stays_with_its_columns(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text, 1, "a"), (2, text + " end", 2, "b"), (9, "other", 3, "c"), (9, "other", 3, "c"),
            (None, text, 4, "d"), (None, text, 4, "d")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, place int, digest string")
    out = jaccard.one_of_each_group(frame)
    assert out.columns == frame.columns
    assert Counter(tuple(r) for r in out.collect()) == Counter(
        [rows[1], rows[2]]
    )


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard.similar_documents(frame).collect() == []


def test_components_of_chains_stars_and_random_graphs(spark):
    chance = random.Random(9)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(600, 900)]
    links += [(chance.randint(1000, 1200), chance.randint(1000, 1200)) for _ in range(150)]
    links += [(7, 7), (-3, 4), (4, -3)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert {r.node: r.component for r in found} == least_reachable(
        nodes, [link for link in links if link[0] != link[1]]
    )
    assert len(found) == len(nodes)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components(none, "a", "b").collect() == []
