"""Staging of application installs: first row per install id, classified."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import event_date, event_datetime, install_source
from adloom.functions import is_realweb, is_ret_campaign, process_strings
from adloom.operators.slices import SLICES_PER_PARTITION, slices_of
from adloom.sources.registry import source_table

INSTALL_ID = "appsflyer_id"

INSTALLS_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("campaign_name", T.StringType()),
        T.StructField("adset_name", T.StringType()),
        T.StructField("media_source", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("appsflyer_id", T.StringType()),
        T.StructField("is_ret_campaign", T.BooleanType()),
        T.StructField("is_realweb", T.BooleanType()),
        T.StructField("source", T.StringType()),
    ]
)


_RAW_COLUMNS = list(source_table("AF_installs").columns)

# Raw time text first, then every other column, so that ties have one answer.
_ORDER_COLUMNS = [name for name in _RAW_COLUMNS if name != INSTALL_ID]
_TIME_ORDER = ", ".join(f"{name} ASC NULLS FIRST" for name in _ORDER_COLUMNS)


def first_install(raw: DataFrame) -> DataFrame:
    """The earliest raw row of each install id; rows without id count as one id.

    This is row number 1 of ``number_installs``, taken as the smallest row per id: structs
    compare field by field, NULL first.  Repeated rows cannot change the smallest, so no
    distinct is needed before, and one shuffle is enough.  Each task sends on one row per id,
    which settles an id that holds a large share of the rows.
    """
    smallest = F.expr(f"min(struct({', '.join(_ORDER_COLUMNS)})) AS earliest")
    columns = [n if n == INSTALL_ID else f"earliest.{n} AS {n}" for n in _RAW_COLUMNS]
    return raw.groupBy(INSTALL_ID).agg(smallest).selectExpr(*columns)


def slice_borders(sliced: DataFrame) -> DataFrame:
    """The first and the last install id of every slice with their rows: two rows per slice at most.

    Slices are in order of the id, so only these can go on across a border.  A row's number within
    slice and id counts the rows before it, so the largest one counts them all; structs compare with
    NULL first, as the slices do.  One pass over two narrow columns, combined in each task.
    """
    ends = sliced.groupBy("slice").agg(
        F.expr(f"min(struct({INSTALL_ID} AS id, -in_slice AS n)) AS lowest"),
        F.expr(f"max(struct({INSTALL_ID} AS id, in_slice AS n)) AS highest"),
    )
    first = "struct(struct(lowest.id) AS id, -lowest.n AS n, true AS first)"
    last = "struct(struct(highest.id) AS id, highest.n AS n, false AS first)"
    return ends.selectExpr(
        "slice", f"inline(IF(lowest.id <=> highest.id, array({first}), array({first}, {last})))"
    )


def number_installs(raw: DataFrame, folder: str) -> DataFrame:
    """All distinct raw rows with their position within the install id.

    A plain window would sort all rows of an id in one task.  Here rows are cut into slices by id
    and time, so that a hot id spreads over several, and are numbered within the slice while they
    are written.  An id that goes on in a slice starts there after the rows of the earlier slices:
    a prefix sum over two rows per slice, which is joined to the written rows without moving them.

    The slices are written to ``folder``, which the result reads, so the folder is the caller's to
    delete when the result is used up.
    """
    spark = raw.sparkSession
    rows = raw.select(*_RAW_COLUMNS)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = slices_of(rows, [INSTALL_ID, *_ORDER_COLUMNS], SLICES_PER_PARTITION * partitions)
    in_slice = f"row_number() OVER (PARTITION BY slice, {INSTALL_ID} ORDER BY {_TIME_ORDER})"
    (
        slices.place(rows.distinct())
        .repartition("slice")
        .selectExpr("*", f"CAST({in_slice} AS BIGINT) AS in_slice")
        .write.parquet(folder)
    )
    sliced = spark.read.parquet(folder)
    earlier_slices = (
        "OVER (PARTITION BY id ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    carried = (
        slice_borders(sliced)
        .selectExpr("slice", "id", "first", f"sum(n) {earlier_slices} AS earlier")
        .where("first AND earlier IS NOT NULL")
        .selectExpr("slice", "id.id AS carried_id", "earlier")
    )
    # One row per slice at most, and their number is bounded by the number of partitions.
    return sliced.join(F.broadcast(carried), "slice", "left").selectExpr(
        *_RAW_COLUMNS,
        f"in_slice + if({INSTALL_ID} <=> carried_id, coalesce(earlier, 0L), 0L) AS id_counter",
    )


def stage_installs(raw: DataFrame) -> DataFrame:
    """First installs with parsed time, cleaned names and the campaign's classification."""
    return first_install(raw).selectExpr(
        f"{event_date('event_time')} AS date",
        f"{event_datetime('event_time')} AS event_time",
        f"{process_strings('Campaign')} AS campaign_name",
        f"{process_strings('af_adset')} AS adset_name",
        f"{process_strings('Media_Source')} AS media_source",
        f"{process_strings('platform')} AS platform",
        INSTALL_ID,
        f"{is_ret_campaign('Campaign')} AS is_ret_campaign",
        f"{is_realweb('Campaign')} AS is_realweb",
        f"{install_source('Campaign')} AS source",
    )
