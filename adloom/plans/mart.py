"""Cross-cabinet performance mart."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adloom.functions.fixed_values import UNKNOWN_SOURCE
from adloom.functions.text import literal
from adloom.operators.cabinets import CABINET_BY_MODEL, CABINETS, Cabinet
from adloom.operators.sums import exact_sums

KEYS = ["date", "campaign_name", "adset_name", "platform", "source"]
METRICS = ["clicks", "impressions", "installs", "costs"]

MART_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("campaign_name", T.StringType()),
        T.StructField("adset_name", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("installs", T.LongType()),
        T.StructField("costs", T.DoubleType()),
    ]
)


def user_acquisition(frame: DataFrame) -> DataFrame:
    """Rows of the agency's campaigns that are not retargeting; unknown flags drop out."""
    return frame.where("is_realweb AND NOT is_ret_campaign")


def _mart_columns(frame: DataFrame, **computed: str) -> DataFrame:
    """Mart columns in order; what a source does not have is a typed NULL."""
    columns = []
    for field in MART_SCHEMA:
        value = computed.get(field.name, field.name if field.name in frame.columns else "NULL")
        columns.append(f"CAST({value} AS {field.dataType.simpleString()}) AS {field.name}")
    return frame.selectExpr(*columns)


def _cabinet_part(frame: DataFrame, cabinet: Cabinet) -> DataFrame:
    return _mart_columns(user_acquisition(frame), source=literal(cabinet.source))


def _install_part(installs: DataFrame) -> DataFrame:
    """One row per install, for known sources whose cabinet does not report installs."""
    left_out = [UNKNOWN_SOURCE] + [cabinet.source for cabinet in CABINETS if cabinet.installs]
    kept = user_acquisition(installs).where(
        f"source NOT IN ({', '.join(map(literal, left_out))})"
    )
    return _mart_columns(kept, installs="1")


def performance_mart(
    cabinets: Mapping[str, DataFrame], installs: DataFrame, summed: bool = False
) -> DataFrame:
    """Clicks, impressions, installs and costs per day, campaign, ad set, platform, source.

    ``cabinets`` maps model names to frames with the staged columns.  Installs come from the
    cabinet where it reports them and from ``installs`` otherwise.  Stacking all parts and
    summing needs no join, keeps NULL ad sets together, and leaves a metric NULL where no part
    has it.  ``summed=True`` says that the cabinets are staged, not ``unsummed``: those that report
    installs then have nothing to be added and skip the shuffle.

    Huawei reports no ad sets: its cost rows have a NULL ad set, its installs keep theirs.
    """
    finished, parts = [], [_install_part(installs)]
    for model, frame in cabinets.items():
        cabinet = CABINET_BY_MODEL[model]
        complete = summed and cabinet.installs is not None
        (finished if complete else parts).append(_cabinet_part(frame, cabinet))
    stacked = reduce(DataFrame.unionByName, parts)
    return reduce(DataFrame.unionByName, finished, exact_sums(stacked, KEYS, METRICS))
