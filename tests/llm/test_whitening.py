"""Whitened embeddings against a dense eigendecomposition."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from adloom.llm import registered, whitening

FOLDER = "/root/testdata/sf0.001"


def dense(vectors: list[list[float]], components: int = 8):
    """Entries, deviations, eigenvalues and whitened vectors from the whole covariance."""
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum((n * int(e) - int(s)) ** 2 for e, s in zip(row, sums)) for row in x]
    apart = (n * x - sums) / n
    values, turn = np.linalg.eigh(apart.T @ apart / n)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    return deviations, values, apart @ turn / np.sqrt(values), np.trace(apart.T @ apart / n)


def table(rows) -> dict:
    found = defaultdict(dict)
    for row in rows:
        found[row.vec_id][row.component] = row
    return found


def compared(found: dict, ids: list[int], vectors: list[list[float]]) -> None:
    deviations, values, expected, trace = dense(vectors)
    assert sorted(found) == sorted(ids)
    signs = {}
    for k, vec_id in enumerate(ids):
        rows = found[vec_id]
        assert sorted(rows) == list(range(1, len(values) + 1))
        for c, row in rows.items():
            assert row.n == len(ids) and row.deviation == deviations[k]
            assert row.explained == pytest.approx(values[c - 1] / trace, rel=1e-10)
            assert 0 <= row.identity_error <= 1e-9
            sign = signs.setdefault(c, np.sign(row.whitened * expected[k, c - 1]))
            assert row.whitened == pytest.approx(sign * expected[k, c - 1], rel=1e-6, abs=1e-7)


def test_query_equals_dense(spark):
    given = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    found = table(registered.queries()["op13_whitening"](spark, FOLDER).collect())
    compared(found, [r.vec_id for r in given], [list(r.embedding) for r in given])


def test_odd_rows_are_left_out(spark):
    chance = np.random.default_rng(5)
    mix = chance.normal(size=(20, 20))
    vectors = (chance.normal(size=(300, 20)) @ mix).tolist()
    rows = [(k, v, "x") for k, v in enumerate(vectors)]
    odd = [None, [], [None] + [0.5] * 19, [float("nan")] * 20, [float("inf")] + [0.0] * 19,
           [1e300] * 20, [2.0**52] * 20]
    rows += [(1000 + k, v, "x") for k, v in enumerate(odd)]
    frame = spark.createDataFrame(
        rows, "vec_id bigint, embedding array<double>, entries string"
    ).repartition(5)
    compared(table(whitening.whitened(frame).collect()), list(range(300)), vectors)


def test_repeated_and_null_ids_are_rows_each(spark):
    chance = np.random.default_rng(6)
    vectors = chance.normal(size=(40, 3)).tolist()
    rows = [(None if k < 5 else k % 7, v) for k, v in enumerate(vectors)] + [(1, vectors[0])] * 2
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = whitening.whitened(frame).collect()
    assert len(found) == 3 * len(rows) and {r.component for r in found} == {1, 2, 3}
    assert sum(r.vec_id is None for r in found) == 15
    assert all(r.n == len(rows) for r in found)


def test_no_variance_no_rows(spark):
    schema = "vec_id bigint, embedding array<double>"
    for rows in ([], [(1, [0.5, 0.25])], [(k, [0.5, 0.25]) for k in range(9)], [(1, None)]):
        found = whitening.whitened(spark.createDataFrame(rows, schema))
        assert found.columns[:3] == ["vec_id", "component", "n"] and found.collect() == []


def test_lengths_are_fits_of_their_own(spark):
    chance = np.random.default_rng(7)
    long, short = chance.normal(size=(30, 12)).tolist(), chance.normal(size=(20, 2)).tolist()
    rows = [(k, v) for k, v in enumerate(long + short)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = table(whitening.whitened(frame).collect())
    compared({k: v for k, v in found.items() if k < 30}, list(range(30)), long)
    compared({k: v for k, v in found.items() if k >= 30}, list(range(30, 50)), short)


def test_deviation_beyond_64_bits_is_null():
    entries = np.array([[2**40, 0], [0, 0], [0, 1]])
    fit = whitening.Whitening(3, np.zeros(2, np.int64), np.ones(2, np.int64),
                              np.zeros((2, 0)), np.zeros(0), 0.0)
    assert fit.deviations(entries) == [None, 2, 5]


@pytest.mark.parametrize("dimension", [1, 3, 8, 13, 60, 200])
@pytest.mark.parametrize("spread", ["even", "falling", "equal", "low rank"])
def test_pairs_of_known_matrices(dimension, spread):
    """Clustered, equal and vanishing eigenvalues, with the number of products bounded."""
    chance = np.random.default_rng(dimension)
    turn = np.linalg.qr(chance.normal(size=(dimension, dimension)))[0]
    k = np.arange(dimension)
    values = {"even": 1.0 + k[::-1] / dimension, "falling": 10.0 ** (-k / 4.0),
              "equal": np.where(k < 3, 2.0, 1.0), "low rank": (k < 4) * (5.0 - k)}[spread]
    matrix = (turn * values) @ turn.T
    products = 0

    def product(block):
        nonlocal products
        products += 1
        return matrix @ block

    rule = whitening.WhiteningRule()
    found, vectors = whitening.leading_pairs(product, dimension, rule)
    wanted = min(dimension, rule.components)
    assert found == pytest.approx(values[:wanted], abs=1e-12 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13
    residuals = np.linalg.norm(matrix @ vectors - vectors * found, axis=0)
    assert residuals.max() <= 1e-13 * np.sqrt(dimension) * values[0]
    assert products < 260


def test_sums_of_many_tasks_are_added_in_groups(spark, monkeypatch):
    chance = np.random.default_rng(8)
    vectors = chance.normal(size=(90, 6)).tolist()
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    rows = whitening.whole_entries(
        frame.selectExpr("vec_id", "embedding AS vector"), whitening.WhiteningRule()
    ).repartition(12)
    one = whitening.column_sums(rows)
    monkeypatch.setattr(whitening, "GROUPS", 5)
    assert whitening.column_sums(rows) == one
    x = np.floor(1024 * np.array(vectors)).astype(np.int64) + 100_000
    assert one == x.sum(axis=0).tolist()
    compared(table(whitening.whitened(frame.repartition(9)).collect()), list(range(90)), vectors)


def test_minres_solves_each_column():
    chance = np.random.default_rng(3)
    one = chance.normal(size=(30, 30))
    matrix = one + one.T
    shifts = np.array([0.1, 2.0, -3.0])
    right = np.column_stack((chance.normal(size=(30, 2)), np.zeros(30)))
    found = whitening.minres(lambda b: matrix @ b - b * shifts, right, 200, 1e-12)
    assert np.abs(matrix @ found - found * shifts - right).max() < 1e-8
