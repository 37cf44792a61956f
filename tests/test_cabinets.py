from __future__ import annotations

import math
from datetime import date, datetime
from fractions import Fraction

import pytest

from adloom.operators.cabinets import (
    CABINET_BY_MODEL,
    CABINETS,
    distinct_raw,
    stage_cabinet,
    unsummed,
)
from adloom.sources.derived import RawTables

FACEBOOK = CABINET_BY_MODEL["stg_facebook"]
YANDEX = CABINET_BY_MODEL["stg_yandex"]
HUAWEI = CABINET_BY_MODEL["stg_huawei_ads"]
SMALL = "/root/testdata/sf0.001"

FACEBOOK_RAW = (
    "date date, Campaign string, adset string, clicks string, spend string, "
    "installs string, show string, ad string"
)
DAY = date(2022, 5, 1)


def facebook(spark, *rows):
    return spark.createDataFrame(list(rows), FACEBOOK_RAW)


def test_repeats_under_another_ad_count_once_but_other_spellings_count_twice(spark):
    raw = facebook(
        spark,
        (DAY, "Realweb_fb_iOS_", "A", "1", "2.5", "1", "10", "ad"),
        (DAY, "Realweb_fb_iOS_", "A", "1", "2.5", "1", "10", "ad2"),
        (DAY, " realweb_fb_ios_ ", "a", "1", "2.5", "1", "10", "ad"),
        (DAY, "Realweb_fb_iOS_", "A", "01", "2.5", "1", "10", "ad"),
    )
    assert distinct_raw(raw, FACEBOOK).count() == 3
    [row] = stage_cabinet(raw, FACEBOOK).collect()
    assert row.asDict() == {
        "date": DAY,
        "campaign_name": "realweb_fb_ios_",
        "adset_name": "a",
        "platform": "ios",
        "is_ret_campaign": False,
        "is_realweb": True,
        "clicks": 3,
        "costs": 7.5,
        "installs": 3,
        "impressions": 30,
    }


def test_unreadable_metrics_count_as_unknown(spark):
    raw = facebook(
        spark,
        (DAY, "a", None, "n/a", "--", None, "", "ad"),
        (DAY, "b", None, "n/a", "1.5", "2", "3", "ad"),
        (DAY, "b", None, "4", "1.5", "2", "3", "ad"),
    )
    rows = {row.campaign_name: row for row in stage_cabinet(raw, FACEBOOK).collect()}
    assert rows["a"][6:] == (None, None, None, None)
    assert rows["b"][6:] == (4, 3.0, 4, 6)


def test_null_names_form_a_group_with_unknown_flags(spark):
    raw = facebook(
        spark,
        (DAY, None, None, "1", "1", "1", "1", "ad"),
        (DAY, None, None, "2", "1", "1", "1", "ad"),
    )
    [row] = stage_cabinet(raw, FACEBOOK).collect()
    assert row[1:6] == (None, None, "no_platform", None, None)
    assert row.clicks == 3


def test_timestamps_become_utc_days(spark):
    schema = (
        "date timestamp, campaign_name string, adset_name string, clicks string, "
        "spend string, impressions string"
    )
    rows = [
        (datetime(2022, 5, 1, 23, 59), "x", "y", "1", "1", "1"),
        (datetime(2022, 5, 2, 0, 0), "x", "y", "1", "1", "1"),
    ]
    raw = spark.createDataFrame(rows, schema.replace("timestamp", "timestamp_ntz"))
    raw = raw.selectExpr("CAST(date AS TIMESTAMP) AS date", "* EXCEPT (date)")
    staged = stage_cabinet(raw, YANDEX)
    assert sorted(row.date for row in staged.collect()) == [DAY, date(2022, 5, 2)]


def test_numeric_metrics_and_other_column_case(spark):
    schema = "DATE date, Campaign_Name string, CLICKS int, spend decimal(9,2), impressions double"
    raw = spark.createDataFrame([(DAY, "x", 1, None, 2.5), (DAY, "x", 2, None, 0.4)], schema)
    [row] = stage_cabinet(raw, HUAWEI).collect()
    assert (row.clicks, row.costs, row.impressions) == (3, None, 3)


def test_integer_overflow_raises(spark):
    big = str(2**63 - 1)
    raw = facebook(
        spark,
        (DAY, "x", "y", big, "1", "1", "1", "ad"),
        (DAY, "x", "y", "1", "1", "1", "1", "ad"),
    )
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW|overflow"):
        stage_cabinet(raw, FACEBOOK).collect()


@pytest.mark.parametrize("cabinet", CABINETS, ids=lambda c: c.model)
def test_staged_schema_keys_and_totals(spark, cabinet):
    raw = RawTables(spark, SMALL)[cabinet.table.lower()]
    staged = stage_cabinet(raw, cabinet)
    expected = [(field.name, field.dataType) for field in cabinet.schema]
    assert [(field.name, field.dataType) for field in staged.schema] == expected

    staged_rows = staged.toPandas()
    assert len(staged_rows) > 0
    assert not staged_rows.duplicated([*cabinet.keys, "platform"]).any()
    rows = unsummed(raw, cabinet).toPandas()
    for metric in cabinet.metrics:
        if metric != "costs":
            assert staged_rows[metric].sum() == rows[metric].sum()
    groups: dict = {}
    for row in unsummed(raw, cabinet).collect():
        costs = groups.setdefault(tuple(row[key] for key in cabinet.keys), [])
        if row.costs is not None:
            costs.append(row.costs)
    for row in staged.collect():
        costs = groups.pop(tuple(row[key] for key in cabinet.keys))
        odd = any(map(math.isnan, costs))
        expected = math.nan if odd else float(sum(map(Fraction, costs))) if costs else None
        assert repr(row.costs) == repr(expected)
    assert not groups
