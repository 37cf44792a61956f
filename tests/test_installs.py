from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest

from adloom.operators.installs import (
    INSTALLS_SCHEMA,
    first_install,
    number_installs,
    slice_borders,
    stage_installs,
)
from adloom.operators.slices import slices_of

RAW = (
    "event_time string, Campaign string, af_c_id string, af_adset string, "
    "Media_Source string, platform string, appsflyer_id string"
)


def raw_rows(spark, rows, slices=4):
    return spark.createDataFrame(rows, RAW).repartition(slices)


def install(time, install_id, campaign="realweb_vk_", adset="A", c_id="1", platform=" iOS"):
    return (time, campaign, c_id, adset, "Net", platform, install_id)


def test_earliest_row_by_raw_text_and_null_time_first(spark):
    rows = [
        install("2022-05-02 00:00:00.000", "a", adset="late"),
        install("2022-05-01 00:00:00.000", "a", adset="early"),
        install("2022-05-01 00:00:00.000", "b"),
        install(None, "b", adset="unknown"),
        # As text, 9 comes after 10.
        install("2022-05-01 9:00:00.000", "c", adset="nine"),
        install("2022-05-01 10:00:00.000", "c", adset="ten"),
    ]
    first = first_install(raw_rows(spark, rows)).collect()
    found = {row.appsflyer_id: row.af_adset for row in first}
    assert found == {"a": "early", "b": "unknown", "c": "ten"}


def test_ties_go_to_the_smallest_of_the_other_columns(spark):
    time = "2022-05-01 00:00:00.000"
    rows = [install(time, "a", adset=name) for name in ("z", "m", "b", "x")]
    rows += [install(time, "b", c_id=None, adset="z"), install(time, "b", c_id="0", adset="a")]
    for slices in (1, 3, 6):
        found = first_install(raw_rows(spark, rows, slices)).collect()
        assert {row.appsflyer_id: row.af_adset for row in found} == {"a": "b", "b": "z"}


def test_rows_without_id_leave_one_row(spark):
    rows = [install(f"2022-05-01 00:00:0{i}.000", None, adset=str(i)) for i in range(9)]
    [row] = stage_installs(raw_rows(spark, rows)).collect()
    assert row.appsflyer_id is None
    assert row.adset_name == "0"


def test_repeated_rows_do_not_matter(spark):
    rows = [install("2022-05-01 00:00:00.000", "a")] * 5
    assert first_install(raw_rows(spark, rows)).count() == 1


def test_staged_columns(spark):
    row = ("2022-05-03 10:11:12.123", " Realweb_UAC_[ret]", "1", " AdSet\t", "Net ", " Web", "Id ")
    frame = stage_installs(raw_rows(spark, [row], 1))
    assert [(f.name, f.dataType) for f in frame.schema] == [
        (f.name, f.dataType) for f in INSTALLS_SCHEMA
    ]
    [staged] = frame.collect()
    assert staged == (
        date(2022, 5, 3),
        datetime(2022, 5, 3, 10, 11, 12),
        "realweb_uac_[ret]",
        "adset",
        "net",
        "web",
        "Id ",
        True,
        True,
        "google_ads",
    )


def _numbered_by_hand(rows):
    groups = defaultdict(set)
    for row in rows:
        groups[row[6]].add(row)
    for group in groups.values():
        ordered = sorted(group, key=lambda r: [(v is not None, v or "") for v in r[:6]])
        yield from ((*row, place) for place, row in enumerate(ordered, start=1))


def _many_installs(seed):
    chance = random.Random(seed)
    ids = [None] * 4 + ["hot"] * 4 + [f"id{i}" for i in range(8)]
    times = [None, *(f"2022-05-01 00:00:{i:02d}.000" for i in range(60))]
    rows = [
        install(chance.choice(times), chance.choice(ids), adset=str(chance.randrange(9)))
        for _ in range(1500)
    ]
    return rows + rows[:700]


@pytest.mark.parametrize("slices", [1, 5, 32])
def test_numbers_equal_a_plain_count_with_a_hot_id(spark, conf, tmp_path, slices):
    conf("spark.sql.shuffle.partitions", str(slices))
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = _many_installs(slices)
    folder = str(tmp_path / "slices")
    found = Counter(tuple(row) for row in number_installs(raw_rows(spark, rows), folder).collect())
    assert found == Counter(_numbered_by_hand(rows))


def test_numbers_hold_when_adaptive_execution_merges_slices(spark, conf, tmp_path):
    conf("spark.sql.shuffle.partitions", "64")
    conf("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    rows = _many_installs(0)
    folder = str(tmp_path / "slices")
    found = Counter(tuple(row) for row in number_installs(raw_rows(spark, rows), folder).collect())
    assert found == Counter(_numbered_by_hand(rows))


def test_hot_id_is_numbered_by_several_tasks(spark, conf, tmp_path):
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot = spark.range(8000).selectExpr(
        "concat('2022-05-01 ', id) AS event_time",
        "'c' AS Campaign",
        "'1' AS af_c_id",
        "'a' AS af_adset",
        "'m' AS Media_Source",
        "'ios' AS platform",
        "'hot' AS appsflyer_id",
    )
    numbered = number_installs(hot, str(tmp_path / "slices"))
    sizes = numbered.selectExpr("spark_partition_id() AS p").groupBy("p").count().toPandas()
    assert sizes["count"].max() < 8000 / 3
    assert sorted(row.id_counter for row in numbered.collect()) == list(range(1, 8001))


def test_only_border_ids_are_carried(spark):
    rows = [(s, i) for s, ids in enumerate(["aab", "bbb", "bcdde", "e"]) for i in ids]
    rows += [(4, None), (4, None), (4, "z")]
    sliced = spark.createDataFrame(rows, "slice int, appsflyer_id string").selectExpr(
        "*", "CAST(row_number() OVER (PARTITION BY slice, appsflyer_id ORDER BY 1) AS BIGINT) AS in_slice"
    )
    borders = slice_borders(sliced)
    found = {(r.slice, r.id.id, r.n, r.first) for r in borders.collect()}
    assert found == {
        (0, "a", 2, True), (0, "b", 1, False), (1, "b", 3, True), (2, "b", 1, True),
        (2, "e", 1, False), (3, "e", 1, True), (4, None, 2, True), (4, "z", 1, False),
    }


def test_written_slices_are_not_shuffled(spark, conf, tmp_path):
    """Rows move twice, for distinct rows and into slices; their numbers need no more."""
    numbered = number_installs(raw_rows(spark, _many_installs(1)), str(tmp_path / "slices"))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "BroadcastHashJoin" in line)
    assert "LeftOuter" in join and "SortMergeJoin" not in plan
    # What is shuffled is the borders: two aggregates a slice, and their prefix sums.
    shuffled = [line for line in plan.splitlines() if " Exchange " in line]
    assert len(shuffled) == 2
    assert not any("event_time" in line for line in shuffled)
    probe = plan.splitlines()[plan.splitlines().index(join) + 1 :]
    rows = next(k for k, line in enumerate(probe) if "Scan" in line)
    assert not any("Exchange" in line for line in probe[:rows])


def test_slices_follow_one_another(spark):
    rows = [(k % 7 if k % 3 else None, k) for k in range(500)]
    frame = spark.createDataFrame(rows, "a int, b int").repartition(3)
    slices = slices_of(frame, ["a", "-b"], 20)
    assert 10 <= slices.number <= 20
    placed = slices.place(frame, "part", "begins").collect()
    order = sorted(placed, key=lambda r: (r.a is not None, r.a or 0, -r.b))
    parts = [r.part for r in order]
    assert parts == sorted(parts) and set(parts) == set(range(slices.number))
    assert [k for k, r in enumerate(order) if r.begins] == [parts.index(p) for p in sorted(set(parts))]


def test_slices_of_nothing_and_of_equal_keys(spark):
    empty = spark.createDataFrame([], "a int")
    assert slices_of(empty, ["a"], 5).place(empty).collect() == []
    equal = spark.createDataFrame([(1,)] * 9, "a int")
    slices = slices_of(equal, ["a"], 5)
    assert slices.number == 1 and {r.slice for r in slices.place(equal).collect()} == {0}
