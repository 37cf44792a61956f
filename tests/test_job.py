from __future__ import annotations

import json
from pathlib import Path

import pytest

from adloom import job
from adloom.job import main, read_sources
from adloom.sources.derived import RawTables
from adloom.sources.registry import source_table
from adloom.sources.sinks import Target

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def exports(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    for name, frame in RawTables(spark, SMALL).items():
        frame.write.parquet(str(folder / source_table(name).name))
    return str(folder)


def test_a_default_run_leaves_production_alone(spark, exports, tmp_path, capsys):
    places = ["--raw-folder", exports, "--folder", str(tmp_path / "t"), "--document",
              str(tmp_path / "d")]
    main([*places, "--select", "example_first", "stg_yandex"])
    [schema, audit] = sorted(p.name for p in Path(tmp_path, "t").iterdir())
    assert schema.startswith("dev_") and audit == f"{schema}_audit"
    assert capsys.readouterr().out == "Failure in test not_null_example_first_id\n"
    for name in ("production", "Production_audit"):
        with pytest.raises(ValueError, match="must not write"):
            main([*places, "--schema", name])


def test_partitions_follow_the_sources(spark, exports, tmp_path, monkeypatch):
    seen = []

    def build(session, *_):
        seen.append(session.conf.get("spark.sql.shuffle.partitions"))
        return {"example_first": session.range(1).selectExpr("CAST(id AS INT) AS id")}

    monkeypatch.setattr(job, "build_models", build)
    target = Target("prod", "production", str(tmp_path))
    raw = read_sources(spark, exports)
    for scan_bytes in (None, 10**13):
        job.run(spark, raw, target, str(tmp_path / "d"), checks=(), scan_bytes=scan_bytes)
    assert seen == [str(spark.sparkContext.defaultParallelism), "50000"]


def test_user_checks_and_errors(spark, exports, tmp_path, capsys):
    checks = [
        {"kind": "exceed_costs_limit", "model": "stg_yandex", "column": "costs", "limit": 100},
        {"kind": "accepted_values", "model": "stg_yandex", "column": "platform", "values": ["x"]},
        {"kind": "not_null", "model": "stg_yandex", "column": "no_such"},
    ]
    (tmp_path / "checks.json").write_text(json.dumps(checks))
    stale = {"results": [{"status": "error", "unique_id": "source.adloom.advertising.yandex"}]}
    (tmp_path / "sources.json").write_text(json.dumps(stale))
    code = main(
        ["--target", "prod", "--raw-folder", exports, "--folder", str(tmp_path / "t"),
         "--document", str(tmp_path / "d"), "--select", "stg_yandex",
         "--checks", str(tmp_path / "checks.json"),
         "--sources-document", str(tmp_path / "sources.json")]
    )
    assert code == 1
    assert sorted(capsys.readouterr().out.split("\n")[:-1]) == [
        "Error in test not_null_stg_yandex_no_such",
        "Failure in test accepted_values_stg_yandex_platform__x",
        "Failure in test exceed_costs_limit_stg_yandex_costs__100",
        "Failure in test freshness of source yandex",
    ]
    assert [p.name for p in Path(tmp_path, "t", "production").iterdir()] == ["stg_yandex"]


def test_job_builds_checks_and_reports(spark, tmp_path, capsys):
    for name, frame in RawTables(spark, SMALL).items():
        frame.write.parquet(str(tmp_path / "raw" / source_table(name).name))
    places = ["--raw-folder", "raw", "--folder", "tables", "--document", "results"]
    absolute = [p if p.startswith("--") else str(tmp_path / p) for p in places]
    main(["--target", "prod", *absolute])
    assert sorted(capsys.readouterr().out.split("\n")[:-1]) == [
        "Failure in test accepted_values_mart_platform__ios__android",
        "Failure in test accepted_values_stg_af_installs_platform__ios__android",
        "Failure in test not_null_example_first_id",
        "Failure in test not_null_stg_af_installs_appsflyer_id",
    ]
    assert Path(tmp_path, "tables", "production", "mart").is_dir()
    assert Path(tmp_path, "tables", "production_audit").is_dir()
