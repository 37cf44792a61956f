from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest

from adloom.operators.cabinets import CABINETS
from adloom.operators.reports import source_results
from adloom.session import cluster_settings, input_bytes, new_folder, prepare
from adloom.session import settings_for, working_folder
from adloom.sources.derived import RawTables, given
from adloom.sources.registry import SOURCES, read_source, registry_frame, source_table

SMALL = "/root/testdata/sf0.001"


def test_registry_lists_all_tables_once(spark):
    rows = registry_frame(spark).collect()
    assert len(rows) == len(SOURCES) == 11
    assert Counter_of(rows) == {"application": 2, "advertising": 9}
    unread = {row.table_name for row in rows if not row.columns_read}
    assert unread == {"app_installs", "crm_data", "apple_search_ads"}


def Counter_of(rows):
    counts: dict[str, int] = {}
    for row in rows:
        counts[row.source_group] = counts.get(row.source_group, 0) + 1
    return counts


def test_registry_and_cabinets_agree_on_columns():
    for cabinet in CABINETS:
        assert set(source_table(cabinet.table).columns) == set(cabinet.raw_columns)


def test_lookup_ignores_case_and_names_the_unknown():
    assert source_table("tiktok").name == "TIKTOK"
    with pytest.raises(KeyError, match="no declared raw table"):
        source_table("nothing")


def test_scan_from_folder_and_catalog(spark, tmp_path):
    raw = RawTables(spark, SMALL)["tiktok"]
    raw.write.parquet(str(tmp_path / "TIKTOK"))
    assert read_source(spark, "tiktok", folder=str(tmp_path)).count() == raw.count()
    spark.sql("CREATE SCHEMA IF NOT EXISTS exports")
    raw.write.mode("overwrite").saveAsTable("exports.TIKTOK")
    found = read_source(spark, "TikTok", schemas={"advertising": "exports"})
    assert found.count() == raw.count()


def test_missing_columns_are_named(spark, tmp_path):
    RawTables(spark, SMALL)["yandex"].drop("spend", "clicks").write.parquet(
        str(tmp_path / "yandex")
    )
    with pytest.raises(ValueError, match="yandex lacks clicks, spend"):
        read_source(spark, "yandex", folder=str(tmp_path))


def test_declared_only_tables_scan_whole(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "crm_data"))
    assert read_source(spark, "crm_data", folder=str(tmp_path)).count() == 3


def test_derived_tables_cover_every_line(spark):
    raw = RawTables(spark, SMALL)
    lines = given(spark, SMALL, "lineitem")
    twice = lines.where("l_linenumber = 1").count()
    derived = sum(raw[cabinet.table.lower()].count() for cabinet in CABINETS)
    assert derived == lines.count() + twice
    assert raw["af_installs"].count() == given(spark, SMALL, "events").count()
    assert len(raw) == len(list(raw)) == 8


def test_prepare_sets_what_results_depend_on(spark, conf):
    conf("spark.sql.session.timeZone", "Asia/Tokyo")
    conf("spark.sql.ansi.enabled", "false")
    prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_working_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert working_folder(spark) == named
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(named)


def test_partitions_follow_the_data_up_to_a_bound():
    shuffle, split = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    assert cluster_settings(0)[shuffle] == "200"
    assert cluster_settings(2**40)[shuffle] == "4096"
    assert cluster_settings(2**40)[split] == str(256 * 2**20)
    large = cluster_settings(100 * 10**12, shuffle_bytes=2**43)
    assert int(large[shuffle]) == 32768
    assert 100 * 10**12 / int(large[split]) <= 50_000
    assert cluster_settings(10**15)[shuffle] == "50000"


def test_most_tasks_is_an_argument():
    settings = cluster_settings(10**15, fewest_tasks=8, most_tasks=100_000)
    assert settings["spark.sql.shuffle.partitions"] == "100000"
    assert cluster_settings(1, fewest_tasks=8)["spark.sql.shuffle.partitions"] == "8"


def test_settings_hold_within_the_block_only(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with settings_for(spark, {name: "77"}):
        assert spark.conf.get(name) == "77"
    assert spark.conf.get(name) == before


def test_input_bytes_are_those_of_the_files(spark):
    path = "/root/testdata/sf0.001/lineitem.parquet"
    size = Path(path).stat().st_size
    frame = spark.read.parquet(path)
    assert input_bytes([frame, frame]) == 2 * size


def test_wrong_types_are_named(spark, tmp_path):
    day = "CAST('2022-05-01 10:00:00' AS TIMESTAMP) AS date"
    texts = "'c' AS Campaign, 'a' AS adset, '1' AS clicks, '1' AS spend, 1 AS installs, '1' AS show"
    spark.sql(f"SELECT {day}, {texts}").write.parquet(str(tmp_path / "facebook"))
    with pytest.raises(ValueError, match="facebook has unreadable columns: date timestamp"):
        read_source(spark, "facebook", folder=str(tmp_path))


def test_declared_schemas_are_accepted():
    for source in SOURCES.values():
        assert all(source.accepts(field) for field in source.schema)
        assert [field.name for field in source.schema] == list(source.columns)


def yandex_files(spark, folder, *changes):
    """One file per change, each a whole day of rows."""
    raw = RawTables(spark, SMALL)["yandex"]
    for change in changes:
        change(raw).coalesce(1).write.mode("append").parquet(f"{folder}/yandex")


def test_one_deviating_file_is_refused_by_name(spark, tmp_path):
    changes = {
        "lacks spend": lambda f: f.drop("spend"),
        "has other types: clicks bigint": lambda f: f.selectExpr(
            "* EXCEPT (clicks)", "CAST(try_cast(clicks AS INT) AS BIGINT) AS clicks"
        ),
        "lacks date, adset_name": lambda f: f.drop("date", "adset_name"),
    }
    for k, (problem, change) in enumerate(changes.items()):
        for order, first in enumerate((True, False)):
            folder = tmp_path / f"{k}-{order}"
            whole = [lambda f: f] * 3
            yandex_files(spark, folder, *([change, *whole] if first else [*whole, change]))
            with pytest.raises(ValueError) as refused:
                read_source(spark, "yandex", folder=str(folder))
            message = str(refused.value)
            if "deviating files" in message and "bigint" not in problem:
                assert message.count("part-") == 1 and problem in message
            else:
                # Spark itself picked the deviating file for its schema.
                assert "yandex lacks" in message or "types" in message


def test_files_that_agree_are_read(spark, tmp_path):
    extra = lambda f: f.withColumn("more", f["clicks"])
    reordered = lambda f: f.select(*reversed(f.columns))
    yandex_files(spark, tmp_path, lambda f: f, extra, reordered)
    raw = RawTables(spark, SMALL)["yandex"]
    assert read_source(spark, "yandex", folder=str(tmp_path)).count() == 3 * raw.count()
    raw.withColumn("day", raw["date"].cast("date")).write.partitionBy("day").parquet(
        f"{tmp_path}/x/yandex"
    )
    assert read_source(spark, "yandex", folder=f"{tmp_path}/x").count() == raw.count()


def test_a_damaged_file_is_refused_by_name(spark, tmp_path):
    yandex_files(spark, tmp_path, lambda f: f, lambda f: f)
    (tmp_path / "yandex" / "part-99999.parquet").write_bytes(b"PAR1 no footer")
    with pytest.raises(Exception, match="part-99999"):
        read_source(spark, "yandex", folder=str(tmp_path))


def test_old_and_empty_sources_are_stale(spark):
    sources = [source_table(name) for name in ("yandex", "facebook", "vkontakte", "af_installs")]
    raw = {
        "yandex": spark.sql("SELECT TIMESTAMP'2022-05-02 00:00:00' AS date"),
        "facebook": spark.sql("SELECT DATE'2022-05-01' AS date"),
        "vkontakte": spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS date"),
    }
    rows = source_results(raw, sources, datetime(2022, 5, 2)).collect()
    assert [(r.table_name, r.status) for r in rows] == [
        ("yandex", "pass"), ("facebook", "error"), ("vkontakte", "error"),
    ]
