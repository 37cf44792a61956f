from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import pytest

from adloom.operators.cabinets import CABINET_BY_MODEL, stage_cabinet
from adloom.operators.installs import INSTALLS_SCHEMA, stage_installs
from adloom.plans.build import MODEL_SCHEMAS
from adloom.sources.derived import RawTables
from adloom.sources.sinks import (
    CABINET_LAYOUT,
    INSTALLS_LAYOUT,
    Layout,
    Target,
    identifier_parts,
    materialize,
    read_model,
    write_table,
)

from adloom.sources.versions import (
    COMPLETE,
    current_folder,
    folder_versions,
    new_folder_version,
    table_versions,
)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cabinet(spark):
    spec = CABINET_BY_MODEL["stg_facebook"]
    return stage_cabinet(RawTables(spark, SMALL)["facebook"], spec)


@pytest.fixture(scope="module")
def installs(spark):
    return stage_installs(RawTables(spark, SMALL)["af_installs"])


def rows_of(frame):
    return Counter(map(repr, frame.collect()))


def same(written, frame):
    assert written.columns == frame.columns
    assert [f.dataType for f in written.schema] == [f.dataType for f in frame.schema]
    assert rows_of(written) == rows_of(frame)


def test_production_writes_day_partitions_with_unknown_days(installs, tmp_path):
    target = Target("prod", "production", str(tmp_path))
    written = materialize(installs, "stg_af_installs", target, INSTALLS_LAYOUT)
    same(written, installs)
    folder = current_folder(installs.sparkSession, target.path("stg_af_installs"))
    folders = {p.name for p in Path(folder).iterdir() if p.is_dir()}
    assert "date=__HIVE_DEFAULT_PARTITION__" in folders
    assert "date=2022-05-01" in folders
    same(read_model(installs.sparkSession, "stg_af_installs", target, INSTALLS_SCHEMA), installs)


def test_rebuild_removes_days_that_are_gone(installs, conf, tmp_path):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    target = Target("prod", "production", str(tmp_path))
    materialize(installs, "stg_af_installs", target, INSTALLS_LAYOUT)
    one_day = installs.where("date = DATE'2022-05-02'")
    same(materialize(one_day, "stg_af_installs", target, INSTALLS_LAYOUT), one_day)


def test_catalog_table_is_replaced(spark, cabinet):
    target = Target("prod", "sink_test")
    for _ in range(2):
        same(write_table(cabinet, "stg_facebook", target, CABINET_LAYOUT), cabinet)
    same(read_model(spark, "stg_facebook", target, MODEL_SCHEMAS["stg_facebook"]), cabinet)
    stored = table_versions(spark, "sink_test", "stg_facebook")
    assert len(stored) == 2
    layout = spark.sql(f"DESCRIBE TABLE EXTENDED sink_test.{stored[-1]}").collect()
    assert "# Partition Information" in [row.col_name for row in layout]
    same(write_table(cabinet, "plain", target), cabinet)


def test_development_makes_views_and_tables_only_on_demand(spark, cabinet, tmp_path):
    target = Target("dev", "personal", str(tmp_path))
    same(materialize(cabinet, "view_model", target, CABINET_LAYOUT), cabinet)
    assert spark.catalog.listTables(pattern="view_model")[0].isTemporary
    assert not Path(target.path("view_model")).exists()
    same(materialize(cabinet, "table_model", target, always_table=True), cabinet)
    assert Path(target.path("table_model")).exists()


def test_hot_day_is_written_by_several_tasks(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    frame = spark.range(0, 300_000, numPartitions=8).selectExpr(
        "IF(id % 3 != 0, DATE'2022-05-01', DATE'2022-05-02' + CAST(id % 7 AS INT)) AS date",
        "id % 2 = 0 AS is_realweb",
        "id",
    )
    target = Target("prod", "production", str(tmp_path))
    layout = Layout(cluster=("is_realweb",))
    written = write_table(frame, "hot", target, layout)
    assert written.selectExpr("count(*)", "sum(id)").first() == (300_000, 299_999 * 150_000)
    files = Counter(p.parent.name for p in Path(target.path("hot")).rglob("*.parquet"))
    assert files["date=2022-05-01"] > 2
    assert max(n for day, n in files.items() if day != "date=2022-05-01") <= 2


def test_rows_are_sorted_within_files(cabinet, tmp_path):
    import pyarrow.parquet as pq

    target = Target("prod", "production", str(tmp_path))
    materialize(cabinet, "sorted", target, CABINET_LAYOUT)
    for path in Path(target.path("sorted")).rglob("*.parquet"):
        table = pq.ParquetFile(path).read(["is_realweb", "is_ret_campaign"]).to_pylist()
        flags = [
            tuple((v is not None, bool(v)) for v in (r["is_realweb"], r["is_ret_campaign"]))
            for r in table
        ]
        assert flags == sorted(flags)


def dying(spark, n):
    """Rows that make a task fail after others have written theirs."""
    return spark.range(0, n, numPartitions=4).selectExpr(
        f"IF(id = {n - 1}, raise_error('lost'), id) AS id"
    )


def test_a_job_that_dies_leaves_the_old_table(spark, tmp_path):
    folder = Target("prod", "production", str(tmp_path))
    catalog = Target("prod", "version_test")
    for target in (folder, catalog):
        old = write_table(spark.range(5), "m", target)
        with pytest.raises(Exception, match="lost"):
            write_table(dying(spark, 4000).selectExpr("CAST(id AS BIGINT) AS id"), "m", target)
        for frame in (old, read_model(spark, "m", target, old.schema)):
            assert sorted(r.id for r in frame.collect()) == list(range(5))
    assert [v.complete for v in folder_versions(spark, folder.path("m"))] == [True]
    assert len(table_versions(spark, "version_test", "m")) == 1


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    for target in (Target("prod", "production", str(tmp_path)), Target("prod", "version_test")):
        schema = spark.range(1).schema
        write_table(spark.range(3), "kept", target)
        before = read_model(spark, "kept", target, schema)
        write_table(spark.range(7), "kept", target)
        assert before.count() == 3
        assert read_model(spark, "kept", target, schema).count() == 7
        # A model may be rebuilt from its own rows.
        own = read_model(spark, "kept", target, schema)
        assert write_table(own.where("id > 1"), "kept", target).count() == 5
    versions = folder_versions(spark, f"{tmp_path}/production/kept")
    assert [v.number for v in versions] == [2, 3] and all(v.complete for v in versions)
    assert len(table_versions(spark, "version_test", "kept")) == 2
    assert spark.table("version_test.kept").count() == 5


def test_a_version_being_written_is_not_seen(spark, tmp_path):
    target = Target("prod", "production", str(tmp_path))
    path, schema = target.path("m"), spark.range(1).schema
    with new_folder_version(spark, path) as folder:
        spark.range(9).write.parquet(folder)
        with pytest.raises(FileNotFoundError, match="no complete version"):
            read_model(spark, "m", target, schema)
    write_table(spark.range(2), "m", target)
    # The driver was killed: the version stays incomplete, and goes when it is old.
    lost = Path(path, "version-000000009-00000000")
    spark.range(50).write.parquet(str(lost))
    assert read_model(spark, "m", target, schema).count() == 2
    write_table(spark.range(4), "m", target)
    assert lost.exists() and read_model(spark, "m", target, schema).count() == 4
    os.utime(lost, (0, 0))
    write_table(spark.range(6), "m", target)
    assert not lost.exists() and read_model(spark, "m", target, schema).count() == 6


def test_tables_without_versions_are_read_and_replaced(spark, tmp_path):
    target = Target("prod", "production", str(tmp_path))
    spark.range(8).write.parquet(target.path("plain"))
    assert read_model(spark, "plain", target, spark.range(1).schema).count() == 8
    assert write_table(spark.range(3), "plain", target).count() == 3
    assert read_model(spark, "plain", target, spark.range(1).schema).count() == 3
    spark.sql("CREATE SCHEMA IF NOT EXISTS version_test")
    spark.range(8).write.saveAsTable("version_test.older")
    write_table(spark.range(3), "older", Target("prod", "version_test"))
    assert spark.table("version_test.older").count() == 3
    assert Path(current_folder(spark, target.path("plain")), COMPLETE).exists()


@pytest.mark.parametrize(
    "schema, folder",
    [
        ("production", None), ("PRODUCTION_audit", None), (" `production` ", None),
        ("spark_catalog.production", None), ("`spark_catalog` . `Production_Audit`", None),
        ("production", "/data"), ("dev", "/data/production"), ("dev", "/data/production/"),
        ("dev", "/data/x/../production"), ("dev", "hdfs://c/data/Production_audit/."),
        ("dev", "/data/%70roduction"), ("dev/../production", "/data"), ("../production", "/d/x"),
        (".", "/data/production"), ("", "/data"), ("a.production", "/data"), ("`a", None),
    ],
)
def test_only_production_writes_to_production(schema, folder):
    with pytest.raises(ValueError):
        Target("dev", schema, folder)


def test_other_names_are_accepted():
    assert Target("dev", "production_copy").schema == "production_copy"
    assert Target("dev", "main.`my-schema`").schema == "main.`my-schema`"
    assert Target("dev", "dev_ann", "/data/production_like").path("m").endswith("dev_ann/m")
    assert Target("prod", "spark_catalog.production").writes_tables
    assert identifier_parts("a.`b.c`. d") == ["a", "b.c", "d"]
