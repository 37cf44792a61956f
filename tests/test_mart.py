from __future__ import annotations

from collections import Counter
from datetime import date

import pytest

from adloom.operators.cabinets import CABINETS, stage_cabinet, unsummed
from adloom.operators.installs import stage_installs
from adloom.plans.examples import example_first, example_second
from adloom.plans.mart import KEYS, MART_SCHEMA, performance_mart, user_acquisition
from adloom.sources.derived import RawTables

FOLDER = "/root/testdata/sf0.001"
DAY = date(2022, 5, 1)


@pytest.fixture(scope="module")
def raw(spark):
    return RawTables(spark, FOLDER)


@pytest.fixture(scope="module")
def staged(raw):
    return {c.model: stage_cabinet(raw[c.table.lower()], c) for c in CABINETS}


@pytest.fixture(scope="module")
def installs(raw):
    return stage_installs(raw["af_installs"])


@pytest.fixture(scope="module")
def mart(staged, installs):
    return performance_mart(staged, installs, summed=True)


def exact_rows(frame):
    """Rows to the last bit, NaN like NaN."""
    return Counter(map(repr, frame.collect()))


def test_schema_and_unique_keys(mart):
    assert [(f.name, f.dataType) for f in mart.schema] == [
        (f.name, f.dataType) for f in MART_SCHEMA
    ]
    rows = mart.toPandas()
    assert len(rows) > 0
    assert not rows.duplicated(KEYS).any()
    assert "other" not in set(rows["source"])


def test_unsummed_rows_give_the_same_mart(mart, raw, staged, installs):
    expected = exact_rows(mart)
    rows = {c.model: unsummed(raw[c.table.lower()], c) for c in CABINETS}
    for cabinets in (rows, staged):
        direct = performance_mart(cabinets, installs)
        assert exact_rows(direct) == expected


def test_totals_equal_those_of_the_kept_staged_rows(mart, staged, installs):
    by_source = mart.toPandas().groupby("source")
    counted = user_acquisition(installs).toPandas().groupby("source").size()
    for cabinet in CABINETS:
        kept = user_acquisition(staged[cabinet.model]).toPandas()
        rows = by_source.get_group(cabinet.source)
        for metric in ("clicks", "impressions"):
            assert rows[metric].sum() == kept[metric].sum()
        costs, kept_costs = (sorted(frame["costs"].dropna()) for frame in (rows, kept))
        assert costs == kept_costs
        expected = kept["installs"].sum() if cabinet.installs else counted.get(cabinet.source, 0)
        assert rows["installs"].sum() == expected


def test_cost_and_install_rows_meet_on_null_ad_sets(spark):
    vk = next(c for c in CABINETS if c.source == "vkontakte")
    name = "realweb_vk_ios_"
    cabinet = spark.createDataFrame(
        [(DAY, name, None, "ios", False, True, 5, 1.5, 7)], vk.schema
    )
    install = (DAY, None, name, None, "net", "ios", "a", False, True, "vkontakte")
    lost = [
        (DAY, None, name, None, "net", "ios", "b", None, None, "vkontakte"),
        (DAY, None, name, None, "net", "ios", "c", True, True, "vkontakte"),
        (DAY, None, name, None, "net", "ios", "d", False, False, "vkontakte"),
        (DAY, None, name, None, "net", "ios", "e", False, True, "other"),
        (DAY, None, name, None, "net", "ios", "f", False, True, "facebook"),
    ]
    web = (DAY, None, name, None, "net", "web", "g", False, True, "vkontakte")
    installs = spark.createDataFrame(
        [install, install, *lost, web],
        "date date, event_time timestamp_ntz, campaign_name string, adset_name string, "
        "media_source string, platform string, appsflyer_id string, is_ret_campaign boolean, "
        "is_realweb boolean, source string",
    )
    rows = performance_mart({vk.model: cabinet}, installs).collect()
    assert Counter(map(tuple, rows)) == Counter(
        [
            (DAY, name, None, "ios", "vkontakte", 5, 7, 2, 1.5),
            (DAY, name, None, "web", "vkontakte", None, None, 1, None),
        ]
    )


def test_same_result_twice(mart):
    assert exact_rows(mart) == exact_rows(mart)


def test_examples(spark):
    first = example_first(spark)
    assert first.schema.simpleString() == "struct<id:int>"
    assert sorted(first.collect(), key=str) == [(1,), (None,)]
    assert example_second(first).collect() == [(1,)]
