from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from adloom.operators import checks
from adloom.operators.checks import Check
from adloom.plans.build import run_checks
from adloom.sources.sinks import Target


@pytest.fixture(scope="module")
def model(spark):
    rows = [(1, "ios", 5000.0), (1, "web", 5000.5), (2, None, None), (None, "web", 9e9)]
    rows += [(None, "mac", -1.0)]
    return spark.createDataFrame(rows, "id int, platform string, costs double")


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


def test_unique_reports_repeated_values_but_not_nulls(model):
    frame = checks.unique(model, "id")
    assert frame.columns == ["unique_field", "n_records"]
    assert rows_of(frame) == Counter([(1, 2)])


def test_not_null_reports_whole_rows(model):
    frame = checks.not_null(model, "id")
    assert frame.columns == model.columns
    assert rows_of(frame) == Counter([(None, "web", 9e9), (None, "mac", -1.0)])


def test_accepted_values_lets_null_through(model):
    frame = checks.accepted_values(model, "platform", ["ios", "android"])
    assert frame.columns == ["value_field", "n_records"]
    assert rows_of(frame) == Counter([("web", 2), ("mac", 1)])


def test_cost_limit_is_strict_and_lets_null_through(model):
    frame = checks.exceed_costs_limit(model, "costs")
    assert frame.columns == ["limit_field"]
    assert rows_of(frame) == Counter([(5000.5,), (9e9,)])
    assert checks.exceed_costs_limit(model, "costs", limit=6000).count() == 1


def test_nan_is_above_no_limit(spark):
    rows = [("nan",), ("inf",), ("-inf",), ("7000",), (None,)]
    frame = spark.createDataFrame(rows, "x string").selectExpr("CAST(x AS DOUBLE) AS costs")
    assert rows_of(checks.exceed_costs_limit(frame, "costs")) == Counter([(7000.0,), (math.inf,)])
    limit = Check("exceed_costs_limit", "m", "costs")
    [row] = checks.check_results({"m": frame}, [limit]).collect()
    assert row.n_failures == 2
    whole = frame.selectExpr("CAST(costs AS INT) AS costs").where("false")
    assert checks.exceed_costs_limit(whole, "costs").collect() == []


ATTACHED = (
    Check("unique", "m", "id"),
    Check("not_null", "m", "id"),
    Check("accepted_values", "m", "platform", values=("ios", "android", "web")),
    Check("exceed_costs_limit", "m", "costs"),
    Check("exceed_costs_limit", "m", "costs_copy", limit=1e12),
    Check("not_null", "rows_only", "platform"),
    Check("unique", "empty", "id"),
    Check("not_null", "empty", "id"),
)


def test_results_count_what_each_check_reports(spark, model):
    model = model.selectExpr("*", "costs AS costs_copy")
    models = {"m": model, "rows_only": model, "empty": model.where("id > 99")}
    results = checks.check_results(models, ATTACHED)
    assert [(f.name, f.dataType) for f in results.schema] == [
        (f.name, f.dataType) for f in checks.RESULTS_SCHEMA
    ]
    expected = Counter()
    for check in ATTACHED:
        n = checks.failing_rows(check, models[check.model]).count()
        status = "fail" if n else "pass"
        expected[(check.name, check.model, check.column, n, status)] += 1
    assert rows_of(results) == expected
    assert Counter(row.n_failures for row in results.collect()) == Counter([1, 2, 1, 2, 0, 1, 0, 0])


def test_unknown_check_is_refused(model):
    with pytest.raises(ValueError, match="unknown check"):
        checks.failing_rows(Check("odd", "m", "id"), model)


def test_both_engines_refuse_what_cannot_run(model):
    for wrong in (
        [Check("nonull", "m", "id")],
        [Check("accepted_values", "m", "platform")],
        [Check("unique", "m", "id"), Check("unique", "M", "ID")],
    ):
        with pytest.raises(ValueError):
            checks.check_results({"m": model}, wrong)
        with pytest.raises(ValueError):
            run_checks({"m": model}, Target("prod", "production", "/nowhere"), wrong)


def test_names_tell_parameters_apart():
    odd = ("a__b", "c d", "e" * 99, "\u00e9")
    names = {Check("accepted_values", "m", "c", values=(value,)).name for value in odd}
    assert len(names) == 4 and all(re.fullmatch("[a-z0-9_]+", name) for name in names)
    assert Check("exceed_costs_limit", "m", "c").name == "exceed_costs_limit_m_c"
    assert Check("exceed_costs_limit", "m", "c", limit=0.5).name != "exceed_costs_limit_m_c"
    near = {Check("exceed_costs_limit", "m", "c", limit=n).name for n in (1234567.0, 1234568.0)}
    assert near == {"exceed_costs_limit_m_c__1234567", "exceed_costs_limit_m_c__1234568"}


def test_unique_counts_digests_and_fetches_repeated_values_only(spark):
    frame = spark.createDataFrame(
        [(v,) for v in ["a", "b", "b", "", "", None, None, "c", "B"]], "s string"
    )
    found = checks.unique(frame, "s")
    assert rows_of(found) == Counter([("b", 2), ("", 2)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    counted = [part for part in plan.split("\n") if "keys=[digest" in part and "partial" in part]
    assert counted and not any("unique_field" in part for part in counted)
    sound = frame.where("s IN ('a', 'c')")
    assert checks.unique(sound, "s").collect() == []


def test_a_model_is_read_once(spark, model):
    declared = [
        Check("unique", "m", "id"),
        Check("accepted_values", "m", "platform", values=("ios",)),
        Check("not_null", "m", "id"),
    ]
    result = checks.check_results({"m": model}, declared)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Relation [") == 1
