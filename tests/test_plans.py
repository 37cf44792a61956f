"""Physical plans over Parquet: shuffles, pruning and pushdown stay as designed."""

from __future__ import annotations

import re

import pytest

from adloom.operators.cabinets import CABINET_BY_MODEL, CABINETS, stage_cabinet, unsummed
from adloom.operators.checks import DECLARED_CHECKS, check_results
from adloom.operators.installs import first_install, number_installs, stage_installs
from adloom.plans.examples import example_first, example_second
from adloom.plans.mart import performance_mart
from adloom.sources.derived import RawTables
from adloom.sources.sinks import CABINET_LAYOUT, Target, write_table

SMALL = "/root/testdata/sf0.001"
YANDEX = CABINET_BY_MODEL["stg_yandex"]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, frame in RawTables(spark, SMALL).items():
        frame.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in RawTables(spark, SMALL)}


def plan(frame, capsys):
    frame.explain("formatted")
    return capsys.readouterr().out


def nodes(text, name):
    return len(re.findall(rf"^\(\d+\) {name}\b", text, re.MULTILINE))


def test_cabinet_shuffles_rows_sums_and_windows_with_map_side_combine(raw, capsys):
    text = plan(stage_cabinet(raw["yandex"], YANDEX), capsys)
    assert nodes(text, "Exchange") == 3
    assert nodes(text, "HashAggregate") == 4 and nodes(text, "ObjectHashAggregate") == 2
    assert nodes(text, "Sort") == 0
    assert "Python" not in text


def test_cabinet_scan_reads_only_staged_columns(raw, capsys):
    text = plan(stage_cabinet(raw["yandex"], YANDEX), capsys)
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {part.split(":")[0] for part in read.split(",")} == set(YANDEX.raw_columns)


def test_day_filter_reaches_the_raw_scan_through_both_aggregates(raw, capsys):
    text = plan(stage_cabinet(raw["yandex"], YANDEX).where("date = DATE'2022-05-03'"), capsys)
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "GreaterThanOrEqual(date,2022-05-03 00:00:00" in pushed
    assert "LessThan(date,2022-05-04 00:00:00" in pushed


def test_flag_filter_runs_before_the_first_shuffle(raw, capsys):
    rows = unsummed(raw["yandex"], YANDEX).where("is_realweb AND NOT is_ret_campaign")
    text = plan(rows, capsys)
    tree = text[: text.index("(1) Scan")]
    assert tree.index("Filter") > tree.index("Exchange")


def test_first_install_shuffles_once_after_partial_aggregation(raw, capsys):
    text = plan(first_install(raw["af_installs"]), capsys)
    assert nodes(text, "Exchange") == 1
    assert "partial_min(struct" in text
    assert nodes(text, "Window") == 0


def test_mart_from_raw_has_one_shuffle_per_source_and_two_for_the_sums(raw, capsys):
    rows = {c.model: unsummed(raw[c.table.lower()], c) for c in CABINETS}
    text = plan(performance_mart(rows, stage_installs(raw["af_installs"])), capsys)
    assert nodes(text, "Exchange") == len(CABINETS) + 3
    assert "Join" not in text and "Cartesian" not in text and "Python" not in text


def test_mart_from_staged_tables_shuffles_sums_and_skips_row_groups(spark, raw, capsys, tmp_path):
    target = Target("prod", "production", str(tmp_path))
    staged = {}
    for cabinet in CABINETS:
        frame = stage_cabinet(raw[cabinet.table.lower()], cabinet)
        staged[cabinet.model] = write_table(frame, cabinet.model, target, CABINET_LAYOUT)
    installs = write_table(stage_installs(raw["af_installs"]), "installs", target)
    mart = performance_mart(staged, installs, summed=True).where("date = DATE'2022-05-03'")
    text = plan(mart, capsys)
    assert nodes(text, "Exchange") == 2
    assert text.count("EqualTo(is_realweb,true)") == len(CABINETS) + 1
    day_filters = re.findall(r"PartitionFilters: \[(.*)\]", text)
    assert len(day_filters) == len(CABINETS)
    assert all("= 2022-05-03" in filters for filters in day_filters)


def test_numbering_joins_one_way_whatever_its_size(raw, tmp_path, conf, capsys):
    texts = []
    for partitions in ("4", "300000"):
        frame = number_installs(raw["af_installs"], str(tmp_path / partitions))
        conf("spark.sql.shuffle.partitions", partitions)
        texts.append(plan(frame, capsys))
    for text in texts:
        assert "NestedLoop" not in text
    kinds = ("SortMergeJoin", "BroadcastHashJoin", "Window", "Exchange")
    assert len({tuple(nodes(text, kind) for kind in kinds) for text in texts}) == 1


def test_checks_read_the_mart_once(spark, raw, capsys):
    rows = {c.model: unsummed(raw[c.table.lower()], c) for c in CABINETS}
    installs = stage_installs(raw["af_installs"])
    first = example_first(spark)
    models = {
        "example_first": first,
        "example_second": example_second(first),
        "stg_af_installs": installs,
        "mart": performance_mart(rows, installs),
    }
    text = plan(check_results(models, DECLARED_CHECKS), capsys)
    assert text.count("/yandex]") == 1
    assert text.count("/af_installs]") <= 3
