"""Data checks: each returns the failing rows, none means the check passed."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.fixed_values import COST_LIMIT
from adloom.functions.text import identifier, literal

PASS, FAIL, ERROR = "pass", "fail", "error"

RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("n_failures", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)


def unique(frame: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared.

    Eight-byte digests are counted first.  Whole values are looked at only where a digest occurs
    twice, which in a sound table is nowhere; there they are counted exactly.
    """
    values = frame.where(F.col(identifier(column)).isNotNull()).select(
        F.col(identifier(column)).alias("unique_field"),
        F.xxhash64(identifier(column)).alias("digest"),
    )
    twice = values.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        values.join(twice, "digest", "left_semi")
        .groupBy("unique_field")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null(frame: DataFrame, column: str) -> DataFrame:
    """Whole rows without a value."""
    return frame.where(F.col(identifier(column)).isNull())


def accepted_values(frame: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list with their row counts; NULL is let through."""
    return (
        frame.where(~F.col(identifier(column)).isin(*values))
        .groupBy(F.col(identifier(column)).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _above(column: str, limit: float) -> str:
    return f"({column} > {limit!r}D AND NOT isnan({column}))"


def exceed_costs_limit(frame: DataFrame, column: str, limit: float = COST_LIMIT) -> DataFrame:
    """Values above the limit; NULL is let through, and so is NaN, which is above nothing.

    Spark itself sorts NaN above all numbers.
    """
    own = F.col(identifier(column)).alias("limit_field")
    return frame.select(own).where(_above("limit_field", limit))


@dataclass(frozen=True)
class Check:
    """A check attached to a column of a model.

    The name tells checks of one kind on one column apart by their values or limit; those that
    would not do in a table name are replaced by a digest.
    """

    kind: str
    model: str
    column: str
    values: tuple[str, ...] = ()
    limit: float = COST_LIMIT

    @property
    def name(self) -> str:
        parameters: list[str] = []
        if self.kind == "accepted_values":
            parameters = [str(value) for value in self.values]
        elif self.kind == "exceed_costs_limit" and self.limit != COST_LIMIT:
            # Every digit counts: limits that are nearly equal are different checks.
            parameters = [repr(self.limit).removesuffix(".0")]
        plain = all(re.fullmatch("[a-z0-9]+(_[a-z0-9]+)*", part) for part in parameters)
        if not plain or sum(map(len, parameters)) > 60:
            parameters = [hashlib.md5(repr(parameters).encode()).hexdigest()[:12]]
        return "__".join([f"{self.kind}_{self.model}_{self.column}", *parameters])


KINDS = ("unique", "not_null", "accepted_values", "exceed_costs_limit")

# Kinds that judge values, whose rows are counted first; the others judge rows.
BY_VALUE = ("unique", "accepted_values")

# How rows are kept as JSON, so that no digit of a time is lost.
ROW_OPTIONS = """map('timestampFormat', "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    'timestampNTZFormat', "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")"""


def validated(checks: Iterable[Check]) -> list[Check]:
    """The checks as a list; raises for what no engine could run or tell apart."""
    found = list(checks)
    for check in found:
        if check.kind not in KINDS:
            raise ValueError(f"unknown check {check.kind}")
        if check.kind == "accepted_values" and not check.values:
            raise ValueError(f"check {check.name} has no accepted values")
    names = Counter(check.name.lower() for check in found)
    if twice := sorted(name for name, n in names.items() if n > 1):
        raise ValueError(f"checks declared twice: {', '.join(twice)}")
    return found


def failing_rows(check: Check, frame: DataFrame) -> DataFrame:
    """The rows that one check reports."""
    [check] = validated([check])
    if check.kind == "unique":
        return unique(frame, check.column)
    if check.kind == "not_null":
        return not_null(frame, check.column)
    if check.kind == "accepted_values":
        return accepted_values(frame, check.column, check.values)
    return exceed_costs_limit(frame, check.column, check.limit)


def _value_failures(check: Check, place: int) -> str:
    """Failing values of a check, counted on one row per column and value."""
    if check.kind == "unique":
        return f"count_if(place = {place} AND value IS NOT NULL AND n_rows > 1)"
    accepted = ", ".join(map(literal, check.values))
    return f"count_if(place = {place} AND value NOT IN ({accepted}))"


def _row_condition(check: Check) -> str:
    column = identifier(check.column)
    return f"{column} IS NULL" if check.kind == "not_null" else _above(column, check.limit)


def _one_pass(frame: DataFrame, by_value: list[Check], by_row: list[Check]) -> DataFrame:
    """One row per check of a model, from one pass over its rows.

    Columns with checks by value become pairs of the column's place and the value as text, which
    one aggregate counts; it combines on the map side, so a frequent value makes no large task.
    Checks by row are counted along with the first column's pairs.
    """
    columns = list(dict.fromkeys(check.column for check in by_value))
    if columns:
        pairs = ", ".join(
            f"struct({place} AS place, CAST({identifier(column)} AS STRING) AS value)"
            for place, column in enumerate(columns)
        )
        conditions = [f"{_row_condition(check)} AS c{i}" for i, check in enumerate(by_row)]
        counted = (
            frame.selectExpr(*conditions, f"inline(array({pairs}))")
            .groupBy("place", "value")
            .agg(
                F.expr("count(1) AS n_rows"),
                *[F.expr(f"count_if(place = 0 AND c{i}) AS r{i}") for i in range(len(by_row))],
            )
            .agg(
                *[
                    F.expr(f"{_value_failures(check, columns.index(check.column))} AS v{i}")
                    for i, check in enumerate(by_value)
                ],
                *[F.expr(f"coalesce(sum(r{i}), 0L) AS r{i}") for i in range(len(by_row))],
            )
        )
    else:
        counted = frame.agg(
            *[F.expr(f"count_if({_row_condition(c)}) AS r{i}") for i, c in enumerate(by_row)]
        )
    counts = {f"v{i}": check for i, check in enumerate(by_value)}
    counts |= {f"r{i}": check for i, check in enumerate(by_row)}
    rows = ", ".join(
        f"struct({literal(check.name)} AS check, {literal(check.model)} AS model,"
        f" {literal(check.column)} AS column, {count} AS n_failures,"
        f" if({count} > 0, {literal(FAIL)}, {literal(PASS)}) AS status)"
        for count, check in counts.items()
    )
    return counted.selectExpr(f"inline(array({rows}))")


def can_run(check: Check, models: Mapping[str, DataFrame]) -> bool:
    """Whether the check's model is there and its condition fits the model's columns."""
    if check.model not in models:
        return False
    try:
        return bool(failing_rows(check, models[check.model]).columns)
    except AnalysisException:
        return False


def check_results(models: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: how many rows it reports, and whether it passes.

    Every model is read once, whatever checks it has.  A check whose model or column is not there
    is an error.
    """
    by_row: dict[str, list[Check]] = {}
    by_value: dict[str, list[Check]] = {}
    errors = []
    for check in validated(checks):
        if not can_run(check, models):
            errors.append((check.name, check.model, check.column, None, ERROR))
            continue
        kinds = by_value if check.kind in BY_VALUE else by_row
        kinds.setdefault(check.model, []).append(check)
    parts = [
        _one_pass(models[model], by_value.get(model, []), by_row.get(model, []))
        for model in by_row | by_value
    ]
    if errors or not parts:
        spark = next(iter(models.values())).sparkSession
        parts.append(spark.createDataFrame(errors, RESULTS_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def tagged_failures(frame: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """What each check of one model reports, from one pass over the model's rows.

    Columns: ``check``, ``failure`` (the value as text, or for ``not_null`` the row as JSON) and
    ``n_records``, the rows that hold it.  Every row leaves its values under checks by value, and
    itself under the checks by row that it fails; one aggregate, which combines in each task first,
    counts them all, and tells which values occur too often or are not accepted.
    """
    by_row = [check for check in checks if check.kind not in BY_VALUE]
    columns = list(dict.fromkeys(check.column for check in checks if check.kind in BY_VALUE))
    whole = f"to_json(struct(*), {ROW_OPTIONS})"
    left, reported = [], []
    for place, check in enumerate(by_row):
        text = f"CAST({identifier(check.column)} AS STRING)"
        value = whole if check.kind == "not_null" else text
        fails = f"coalesce({_row_condition(check)}, false)"
        left.append(f"struct({place} AS place, IF({fails}, {value}, NULL) AS failure)")
        reported.append(f"IF(place = {place}, {literal(check.name)}, NULL)")
    for place, column in enumerate(columns, len(by_row)):
        text = f"CAST({identifier(column)} AS STRING)"
        left.append(f"struct({place} AS place, {text} AS failure)")
        for check in checks:
            if check.kind in BY_VALUE and check.column == column:
                accepted = ", ".join(map(literal, check.values))
                wrong = "n_records > 1" if check.kind == "unique" else f"failure NOT IN ({accepted})"
                reported.append(f"IF(place = {place} AND {wrong}, {literal(check.name)}, NULL)")
    return (
        frame.selectExpr(f"inline(array({', '.join(left)}))")
        .where("failure IS NOT NULL")
        .groupBy("place", "failure")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .selectExpr(f"explode(array({', '.join(reported)})) AS check", "failure", "n_records")
        .where("check IS NOT NULL")
    )


def read_failures(tagged: DataFrame, check: Check, schema: T.StructType) -> DataFrame:
    """The failures of one check with their types, from rows as ``tagged_failures`` gives them.

    ``schema`` is the model's.  Equal rows come once, with their number in ``n_records``.
    """
    own = tagged.where(F.col("check") == check.name)
    if check.kind == "not_null":
        row = f"from_json(failure, {literal(schema.toDDL())}, {ROW_OPTIONS})"
        return own.selectExpr(f"{row} AS row", "n_records").selectExpr("row.*", "n_records")
    names = {"unique": "unique_field", "accepted_values": "value_field"}
    dtype = next(f.dataType for f in schema if f.name.lower() == check.column.lower())
    name = names.get(check.kind, "limit_field")
    return own.selectExpr(f"CAST(failure AS {dtype.simpleString()}) AS {name}", "n_records")


# The checks declared for the models.
DECLARED_CHECKS: tuple[Check, ...] = (
    Check("unique", "example_first", "id"),
    Check("not_null", "example_first", "id"),
    Check("unique", "example_second", "id"),
    Check("not_null", "example_second", "id"),
    Check("accepted_values", "stg_af_installs", "platform", values=("ios", "android")),
    Check("unique", "stg_af_installs", "appsflyer_id"),
    Check("not_null", "stg_af_installs", "appsflyer_id"),
    Check("not_null", "mart", "campaign_name"),
    Check("accepted_values", "mart", "platform", values=("ios", "android")),
)
