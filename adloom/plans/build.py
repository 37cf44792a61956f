"""Build all models, run all checks, keep what failed: the scheduled job."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from adloom.operators.cabinets import CABINETS, CABINET_BY_MODEL, stage_cabinet
from adloom.operators.checks import DECLARED_CHECKS, ERROR, FAIL, PASS, RESULTS_SCHEMA
from adloom.operators.checks import BY_VALUE, Check, can_run, read_failures, tagged_failures
from adloom.operators.checks import validated
from adloom.operators.installs import INSTALLS_SCHEMA, stage_installs
from adloom.plans.examples import EXAMPLE_SCHEMA, example_first, example_second
from adloom.plans.mart import MART_SCHEMA, performance_mart
from adloom.sources.sinks import CABINET_LAYOUT, INSTALLS_LAYOUT, Layout, Target
from adloom.sources.sinks import AUDIT, materialize, read_model, write_table

logger = logging.getLogger(__name__)

MODEL_SCHEMAS = {cabinet.model: cabinet.schema for cabinet in CABINETS} | {
    "stg_af_installs": INSTALLS_SCHEMA,
    "mart": MART_SCHEMA,
    "example_first": EXAMPLE_SCHEMA,
    "example_second": EXAMPLE_SCHEMA,
}

INSTALLS = "stg_af_installs"
STAGING = (*(cabinet.model for cabinet in CABINETS), INSTALLS)
MODELS = (*STAGING, "mart", "example_first", "example_second")

# The audit table, one for all checks.
FAILURES = "failures"
FAILURES_SCHEMA = StructType(
    [
        StructField("check", StringType()),
        StructField("failure", StringType()),
        StructField("n_records", LongType()),
    ]
)

# Models written, or checks tried, at the same time; none of them depends on another.
WRITERS = 8


def require_schema(frame: DataFrame, model: str) -> DataFrame:
    """The frame itself if its columns are those declared for the model; else raises."""
    expected = [(field.name, field.dataType) for field in MODEL_SCHEMAS[model]]
    found = [(field.name, field.dataType) for field in frame.schema]
    if found != expected:
        wrong = [f"{n} {t.simpleString()}" for n, t in found if (n, t) not in expected]
        raise ValueError(f"model {model} has unexpected columns: {', '.join(wrong) or 'order'}")
    return frame


def build_staging(
    raw: Mapping[str, DataFrame], target: Target, models: Iterable[str] = STAGING
) -> dict[str, DataFrame]:
    """Write staging models, all or some; readers get the written form.

    ``raw`` maps raw table names, in lower case, to their frames.  Several models are written at
    once, so that the last tasks of one do not leave the executors idle.
    """

    def write(model: str) -> DataFrame:
        if model == INSTALLS:
            staged, layout = stage_installs(raw["af_installs"]), INSTALLS_LAYOUT
        else:
            cabinet = CABINET_BY_MODEL[model]
            staged, layout = stage_cabinet(raw[cabinet.table.lower()], cabinet), CABINET_LAYOUT
        return materialize(require_schema(staged, model), model, target, layout)

    with ThreadPoolExecutor(WRITERS) as writers:
        written = {model: writers.submit(write, model) for model in models}
        return {model: frame.result() for model, frame in written.items()}


def build_mart(staging: Mapping[str, DataFrame], target: Target) -> DataFrame:
    """Write the mart from the written staging models."""
    cabinets = {cabinet.model: staging[cabinet.model] for cabinet in CABINETS}
    mart = performance_mart(cabinets, staging[INSTALLS], summed=True)
    return materialize(require_schema(mart, "mart"), "mart", target, Layout(), always_table=True)


def build_models(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    target: Target,
    select: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """Write every model in order of dependence, or the selected ones.

    What a selected model reads and is not selected itself must be there from an earlier run.
    """
    chosen = set(MODELS if select is None else select)
    if unknown := sorted(chosen - set(MODELS)):
        raise ValueError(f"unknown models: {', '.join(unknown)}")
    models = build_staging(raw, target, [model for model in STAGING if model in chosen])

    def given(model: str) -> DataFrame:
        if model in models:
            return models[model]
        return read_model(spark, model, target, MODEL_SCHEMAS[model])

    if "mart" in chosen:
        models["mart"] = build_mart({model: given(model) for model in STAGING}, target)
    if "example_first" in chosen:
        first = example_first(spark)
        models["example_first"] = materialize(first, "example_first", target, always_table=True)
    if "example_second" in chosen:
        second = example_second(given("example_first"))
        models["example_second"] = materialize(second, "example_second", target)
    return models


def _tagged(models: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """The failures of all checks, with one pass over each model."""
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        by_model.setdefault(check.model, []).append(check)
    parts = [tagged_failures(models[model], own) for model, own in by_model.items()]
    return reduce(DataFrame.unionByName, parts)


def run_checks(
    models: Mapping[str, DataFrame],
    target: Target,
    checks: Iterable[Check] = DECLARED_CHECKS,
) -> DataFrame:
    """Write the failures of all checks to one audit table; return one row per check.

    Checks of unknown kind or with equal names are refused before any runs.  One job reads every
    model once, whatever checks it has, and writes the audit table, which is partitioned by check;
    failures are counted there.  A check that cannot run gets the status error, and the others go
    on: if the job fails, every check is tried alone, and the sound ones are written together.
    """
    declared = validated(checks)
    sound = [check for check in declared if can_run(check, models)]
    audit = audit_target(target)
    counts: dict[str, tuple[int, int]] = {}
    if sound:
        try:
            stored = _store(models, sound, audit)
        except (PySparkException, Py4JJavaError):
            logger.warning("checks could not run together", exc_info=True)
            sound = _sound(models, sound)
            stored = _store(models, sound, audit) if sound else None
        if stored is not None:
            counted = stored.groupBy("check").agg(F.count(F.lit(1)), F.sum("n_records"))
            counts = {name: (values, rows) for name, values, rows in counted.collect()}

    def result(check: Check) -> tuple:
        if check not in sound:
            return check.name, check.model, check.column, None, ERROR
        n_failures = counts.get(check.name, (0, 0))[check.kind not in BY_VALUE]
        status = FAIL if n_failures else PASS
        return check.name, check.model, check.column, n_failures, status

    spark = next(iter(models.values())).sparkSession
    return spark.createDataFrame([result(check) for check in declared], RESULTS_SCHEMA)


def audit_target(target: Target) -> Target:
    return Target(target.name, f"{target.schema}{AUDIT}", target.folder)


def _store(models: Mapping[str, DataFrame], checks: list[Check], audit: Target) -> DataFrame:
    return write_table(_tagged(models, checks), FAILURES, audit, Layout("check"))


def _sound(models: Mapping[str, DataFrame], checks: list[Check]) -> list[Check]:
    """The checks that run alone."""

    def runs(check: Check) -> bool:
        try:
            _tagged(models, [check]).write.format("noop").mode("overwrite").save()
        except (PySparkException, Py4JJavaError):
            logger.warning("check %s could not run", check.name, exc_info=True)
            return False
        return True

    with ThreadPoolExecutor(WRITERS) as runners:
        return [check for check, fine in zip(checks, runners.map(runs, checks)) if fine]


def stored_failures(
    spark: SparkSession, target: Target, check: Check, schema: StructType
) -> DataFrame:
    """What a check reported when the checks last ran, with types; ``schema`` is the model's."""
    tagged = read_model(spark, FAILURES, audit_target(target), FAILURES_SCHEMA)
    return read_failures(tagged, check, schema)
