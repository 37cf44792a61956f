from __future__ import annotations

import json

import pytest

from adloom.operators import reports
from adloom.operators.checks import RESULTS_SCHEMA


def test_failed_checks_are_reported_and_errors_are_not(spark, tmp_path):
    document = {
        "metadata": {"any": 1},
        "results": [
            {"status": "fail", "unique_id": "test.p.unique_model_id.16e066", "failures": 3},
            {"status": "pass", "unique_id": "test.p.other.1"},
            {"status": "error", "unique_id": "test.p.broken.2"},
        ],
    }
    path = tmp_path / "run_results.json"
    path.write_text(json.dumps(document, indent=2))
    rows = reports.failed_checks(reports.read_document(spark, str(path))).collect()
    assert rows == [("unique_model_id", "Failure in test unique_model_id")]


def test_stale_sources_are_reported_by_table(spark, tmp_path):
    document = {
        "results": [
            {"status": "error", "unique_id": "source.p.group.yandex"},
            {"status": "pass", "unique_id": "source.p.group.facebook"},
        ]
    }
    path = tmp_path / "sources.json"
    path.write_text(json.dumps(document))
    rows = reports.stale_sources(reports.read_document(spark, str(path))).collect()
    assert rows == [("yandex", "Failure in test freshness of source yandex")]


def test_missing_document_has_no_results(spark, tmp_path):
    document = reports.read_document(spark, str(tmp_path / "none.json"))
    assert reports.failed_checks(document).collect() == []
    assert reports.stale_sources(document).collect() == []


def test_written_results_read_back(spark, tmp_path):
    rows = [("a_m_x", "m", "x", 2, "fail"), ("b_m_x", "m", "x", None, "error")]
    results = spark.createDataFrame(rows, RESULTS_SCHEMA)
    path = str(tmp_path / "document")
    reports.write_document(results, path)
    document = reports.read_document(spark, path)
    assert document.count() == 1
    assert reports.failed_checks(document).collect() == [("a_m_x", "Failure in test a_m_x")]


def test_a_damaged_document_raises(spark, tmp_path):
    for k, text in enumerate(
        ('{"results": [{"status": "fail", "unique_id": "test.p.x"}', "{}", "no json")
    ):
        (tmp_path / f"{k}.json").write_text(text)
        with pytest.raises(Exception):
            reports.failed_checks(reports.read_document(spark, str(tmp_path / f"{k}.json"))).collect()


def test_errors_have_their_own_messages(spark):
    rows = [("error", "test.p.broken"), ("fail", "test.p.bad"), ("error", "source.p.a.late")]
    document = spark.createDataFrame([(rows,)], reports.DOCUMENT_SCHEMA)
    assert [r.message for r in reports.errored_checks(document).collect()] == ["Error in test broken"]
