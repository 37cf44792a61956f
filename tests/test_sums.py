"""Exact sums against sums of fractions, rounded once."""

from __future__ import annotations

import math
import random
import struct
from collections import defaultdict
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adloom.operators.sums import exact_sums


def rows_of(frame) -> dict:
    return {row.k: row.x for row in exact_sums(frame, ["k"], ["x"]).collect()}


def bits(value: float | None) -> bytes | None:
    return None if value is None else struct.pack("<d", value)


def checked(spark, groups: list[list[float | None]], partitions: int = 3) -> None:
    rows = [(k, x) for k, group in enumerate(groups) for x in group]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "k int, x double").repartition(partitions)
    found = rows_of(frame)
    for k, group in enumerate(groups):
        known = [x for x in group if x is not None]
        if group:
            expected = float(sum(map(Fraction, known))) if known else None
            assert bits(found[k]) == bits(expected), group


finite = st.floats(min_value=-1e300, max_value=1e300)
cents = st.integers(-10**7, 10**7).map(lambda n: n / 100)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.one_of(st.lists(finite, max_size=8), st.lists(cents, max_size=30)), min_size=40))
def test_sums_are_rounded_once(spark, groups):
    checked(spark, groups)


def test_hard_sums(spark):
    chance = random.Random(7)
    tiny, least = 2.0**-1074, 2.0**-1022
    groups = [
        [0.1] * 10, [19.99, -0.01, 0.1, 0.2, -0.3], [1e16, 0.1, -1e16], [1e300, 1.0, -1e300, tiny],
        [2.0**53, 1.0], [2.0**53, 1.0, tiny], [2.0**53, 3.0], [2.0**53, 1.0, -tiny],
        [-(2.0**53), -1.0], [-(2.0**53), -1.0, -(2.0**-60)], [tiny] * 3, [least, -tiny], [0.0, -0.0],
        [None], [None, 1.5], [1.0, -1.0], [2.0**42, 2.0**42 - 2.0**-10, 2.0**-21, -(2.0**-21) * 0.99],
        [1.7e308, 1.7e308, -1.7e308], [x * 0.1 for x in range(-500, 1000)],
        [2.0**e for e in range(-1074, 1000, 7)], [(-1) ** e * 2.0**e for e in range(-1074, 1000)],
        [-(2.0**e) for e in range(-60, 60)], [2.0 - 2.0**-52] * 4097, [1.0 + 2.0**-52, 2.0**-53],
        [1.0, 2.0**-53], [1.0 + 2.0**-52, 2.0**-53, -(2.0**-120)], [(2.0**21 - 0.5) * 2.0**20] * 3,
    ]
    for _ in range(200):
        size = chance.choice([2, 5, 40])
        groups.append([
            chance.choice([1, -1]) * math.ldexp(chance.random(), chance.randint(-90, 90))
            for _ in range(size)
        ])
    checked(spark, groups)


def test_sums_overflow_only_at_the_end(spark):
    frame = spark.createDataFrame([(1, 1.7e308), (1, 1.7e308)], "k int, x double")
    assert rows_of(frame) == {1: math.inf}


@pytest.mark.parametrize(
    "values, expected",
    [([1.0, math.inf], math.inf), ([-math.inf, 2.0], -math.inf), ([math.nan, 1.0], math.nan),
     ([math.inf, -math.inf], math.nan), ([math.inf, math.nan, None], math.nan)],
)
def test_odd_numbers(spark, values, expected):
    frame = spark.createDataFrame([(1, v) for v in values], "k int, x double")
    [found] = rows_of(frame).values()
    assert found == expected or math.isnan(found) and math.isnan(expected)


def test_order_and_partitions_do_not_matter(spark):
    """Plain sums of these rows differ from order to order; exact ones don't."""
    chance = random.Random(3)
    rows = [(k % 5, chance.choice([0.1, 19.99, -7.35, 1e9 + 0.01, -1e9])) for k in range(20_000)]
    plain, exact = defaultdict(set), defaultdict(set)
    for partitions in (1, 2, 7):
        chance.shuffle(rows)
        frame = spark.createDataFrame(rows, "k int, x double").repartition(partitions)
        for row in frame.groupBy("k").sum("x").collect():
            plain[row.k].add(bits(row["sum(x)"]))
        for k, x in rows_of(frame).items():
            exact[k].add(bits(x))
    assert all(len(found) == 1 for found in exact.values())
    assert any(len(found) > 1 for found in plain.values())


def test_other_metrics_and_null_keys(spark):
    rows = [("a", 1, 0.5, 1e15), ("a", 2, 0.25, None), (None, 5, None, 2.0**-40), (None, None, 0.1, 0.1)]
    frame = spark.createDataFrame(rows, "k string, n bigint, x double, y double")
    found = {r.k: (r.n, r.x, r.y) for r in exact_sums(frame, ["k"], ["n", "x", "y"]).collect()}
    assert found == {"a": (3, 0.75, 1e15), None: (5, 0.1, math.fsum([2.0**-40, 0.1]))}
    whole = exact_sums(frame, ["k"], ["n"]).collect()
    assert {r.k: r.n for r in whole} == {"a": 3, None: 5}


def test_rows_are_combined_before_each_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id * 0.1D AS x")
    plan = exact_sums(frame, ["k"], ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("partial_sum") >= 6
