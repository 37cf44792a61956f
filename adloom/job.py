"""The scheduled job: build models, check them, report what failed.

    python -m adloom.job --target prod --raw-folder <exports> --folder <tables> --document <path>

Ends with 1 if a check could not run.  ``--select`` builds and checks some models only; what they
read must be there from an earlier run.  ``--checks`` names a JSON file with a list of checks, each
with ``kind``, ``model``, ``column`` and, by kind, ``values`` or ``limit``.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from adloom.operators.cabinets import CABINETS
from adloom.operators.checks import DECLARED_CHECKS, Check, validated
from adloom.operators.reports import errored_checks, failed_checks, read_document
from adloom.operators.reports import stale_sources, write_document
from adloom.plans.build import MODELS, build_models, run_checks
from adloom.session import SHUFFLE_GROWTH, cluster_settings, input_bytes, prepare, settings_for
from adloom.sources.registry import read_source
from adloom.sources.sinks import Target


def read_sources(
    spark: SparkSession, folder: str | None, schemas: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """All raw tables that models read, by lower-case name."""
    names = [cabinet.table for cabinet in CABINETS] + ["AF_installs"]
    return {
        name.lower(): read_source(spark, name, folder=folder, schemas=schemas) for name in names
    }


def declared_checks(text: str) -> list[Check]:
    """Checks from a JSON list."""
    return validated(
        Check(**{k: tuple(v) if k == "values" else v for k, v in entry.items()})
        for entry in json.loads(text)
    )


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    target: Target,
    document: str,
    *,
    checks: Iterable[Check] = DECLARED_CHECKS,
    select: Iterable[str] | None = None,
    scan_bytes: int | None = None,
) -> DataFrame:
    """Build, check, write the result document to its path, and return it as it reads.

    Shuffles start with as many partitions as the raw tables' size asks for, by Spark's own figures
    unless ``scan_bytes`` is given.  With ``select``, checks of other models are left out.
    """
    chosen = set(MODELS if select is None else select)
    wanted = [check for check in validated(checks) if select is None or check.model in chosen]
    if scan_bytes is None:
        scan_bytes = input_bytes(raw.values())
    fewest = spark.sparkContext.defaultParallelism
    settings = cluster_settings(scan_bytes, SHUFFLE_GROWTH * scan_bytes, fewest_tasks=fewest)
    with settings_for(prepare(spark), settings):
        models = build_models(spark, raw, target, select)
        write_document(run_checks(models, target, wanted), document)
    return read_document(spark, document)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(
        description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("--target", default="dev", help="prod writes all models as tables")
    parser.add_argument("--schema", help="schema the tables go to; follows from the target")
    parser.add_argument("--raw-folder", help="Parquet raw tables; the catalog without it")
    parser.add_argument("--raw-schema", help="catalog schema of the advertising exports")
    parser.add_argument("--folder", help="where tables go; the catalog without it")
    parser.add_argument("--document", required=True, help="path for the check results")
    parser.add_argument("--sources-document", help="path of source freshness results to report")
    parser.add_argument("--select", nargs="+", help="models to build and check")
    parser.add_argument("--checks", help="JSON file with the checks to run")
    parser.add_argument("--input-gb", type=int, help="size splits and shuffles for this much")
    options = parser.parse_args(arguments)
    target = Target.of(options.target, options.schema, options.folder)
    checks: Iterable[Check] = DECLARED_CHECKS
    if options.checks:
        with open(options.checks, encoding="utf-8") as file:
            checks = declared_checks(file.read())
    spark = SparkSession.builder.appName("adloom").getOrCreate()
    schemas = {"advertising": options.raw_schema} if options.raw_schema else None
    raw = read_sources(spark, options.raw_folder, schemas)
    results = run(
        spark,
        raw,
        target,
        options.document,
        checks=checks,
        select=options.select,
        scan_bytes=options.input_gb and options.input_gb * 10**9,
    )
    # One line per check or source: bounded by their numbers.
    errors = errored_checks(results).collect()
    messages = failed_checks(results).collect() + errors
    if options.sources_document:
        messages += stale_sources(read_document(spark, options.sources_document)).collect()
    for row in messages:
        print(row.message)
    return 1 if errors else 0


if __name__ == "__main__":
    sys.exit(main())
