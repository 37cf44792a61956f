"""Raw advertising tables derived from the given ``lineitem`` and ``events`` tables.

Real exports are not at hand, so each raw table is a plain projection of given rows.  It grows
with them and holds the dirt that staging must handle: NULL and padded names, mixed case,
unreadable metrics, rows delivered again under another ad, repeated and missing install ids.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from adloom.functions.text import literal
from adloom.operators.cabinets import CABINETS, Cabinet


NO_BREAK, EM = "\u00a0", "\u2003"


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _pick(number: str, modulus: int, *options: str) -> str:
    """The option at the remainder of the number; the last one for all remainders beyond."""
    index = f"CAST(least({number} % {modulus} + 1, {len(options)}) AS INT)"
    return f"elt({index}, {', '.join(map(literal, options))})"


def _campaign(first: str, second: str) -> str:
    prefix = _pick(first, 5, " Realweb", "realweb", "\tREALWEB", "other", "x_realweb")
    code = _pick(second, 9, "FB", "hw", "mt", "TikTok", "uac", "vk", "ya", "asa", "ya2")
    platforms = ("_iOS_", "_[p:ios]", "_and_", "_[P:AND]", "_p01", "_p02", "_android", "_web")
    marker = _pick(first, 8, *platforms)
    purpose = _pick(first, 11, "[ret]", "_old_", "_retarget", "_ua")
    return f"if({first} % 23 != 0, concat({prefix}, '_', {code}, {marker}, {purpose}, ' '), NULL)"


def _day(number: str) -> str:
    return f"concat('2022-05-0', {number} % 7 + 1)"


def _ad_set(gap: str, number: str) -> str:
    """Some names are Cyrillic between a no-break space and an em space."""
    return f"""CASE WHEN {gap} % 19 = 0 THEN NULL
        WHEN {gap} % 19 = 1 THEN concat({literal(NO_BREAK + "Набор")}, {number} % 4, {literal(EM)})
        ELSE concat(' AdSet ', {number} % 4) END"""


def cabinet_export(lineitem: DataFrame, cabinet: Cabinet) -> DataFrame:
    """One cabinet's raw export: every seventh supplier's lines.

    Each first line of an order is delivered a second time under another ad.
    """
    day = _day("l_linenumber")
    if cabinet.day_delivered:
        date = f"CAST({day} AS DATE)"
    else:
        hour = _pick("l_partkey", 3, " 10:00:00", " 00:00:00", " 23:59:59.999")
        date = f"CAST(concat({day}, {hour}) AS TIMESTAMP)"
    quantity = "CAST(l_quantity AS BIGINT)"
    unread = "WHEN l_partkey % 13 = 0 THEN"
    clicks = (
        f"CASE {unread} 'n/a' WHEN l_partkey % 17 = 0 THEN '' WHEN l_partkey % 29 = 0 THEN '12.5'"
        f" ELSE CAST({quantity} AS STRING) END"
    )
    # Cents have no exact double; refunds and amounts of unlike sizes make sums depend on order.
    costs = f"""CASE {unread} '--' WHEN l_orderkey % 211 = 0 THEN 'NaN'
        WHEN l_partkey % 37 = 0 THEN '-0.1' WHEN l_orderkey % 41 = 0 THEN '1e15'
        WHEN l_orderkey % 43 = 0 THEN '-1e15' WHEN l_partkey % 47 = 0 THEN '9.313225746154785e-10'
        ELSE CAST(CAST({quantity} AS DECIMAL(12, 0)) * 19.99BD AS STRING) END"""
    columns = {
        cabinet.date: date,
        cabinet.campaign: _campaign("l_partkey", "l_suppkey"),
        cabinet.clicks: clicks,
        cabinet.costs: costs,
        cabinet.impressions: f"CAST({quantity} * 100 AS STRING)",
    }
    if cabinet.adset:
        columns[cabinet.adset] = _ad_set("l_orderkey", "l_partkey")
    if cabinet.installs:
        columns[cabinet.installs] = f"if(l_partkey % 31 != 0, CAST({quantity} % 5 AS STRING), NULL)"
    columns["ads"] = "if(l_linenumber = 1, array('ad', 'ad2'), array('ad'))"
    own = lineitem.where(f"l_suppkey % 7 = {CABINETS.index(cabinet)}")
    return _as_table(own, columns).selectExpr("* EXCEPT (ads)", "explode(ads) AS ad")


def _as_table(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Compute columns once per row, as if they were scanned.

    Filters above a plain projection move below it and repeat its expressions; they do not
    move below a generator.
    """
    row = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return frame.selectExpr(f"inline(array(struct({row})))")


def installs_export(events: DataFrame) -> DataFrame:
    """Raw installs: up to three rows per install id, some without id, time or platform."""
    time = f"concat({_day('event_id')}, ' 1', event_id % 10, ':0', event_id % 6, ':00.123')"
    platform = (
        "CASE event_id % 9 WHEN 0 THEN ' iOS' WHEN 1 THEN 'Android ' WHEN 2 THEN NULL"
        " WHEN 3 THEN 'web' ELSE 'ios' END"
    )
    columns = {
        "event_time": f"""CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN event_id % 103 = 0 THEN substr({time}, 1, 19)
            WHEN event_id % 107 = 0 THEN concat({time}, '\\n')
            WHEN event_id % 109 = 0
            THEN concat('2022-5-', event_id % 7 + 1, ' 9:', event_id % 6, ':0.123')
            ELSE {time} END""",
        "Campaign": _campaign("user_id", "event_id"),
        "af_c_id": "CAST(event_id % 3 AS STRING)",
        "af_adset": _ad_set("event_id", "user_id"),
        "Media_Source": "event_type",
        "platform": platform,
        "appsflyer_id": "if(event_id % 97 != 0, concat('af-', event_id div 3), NULL)",
    }
    return _as_table(events, columns)


def dirty_metrics(lineitem: DataFrame) -> DataFrame:
    """Every line's quantity spelled in one of the ways exports spell numbers."""
    digits = "CAST(CAST(l_quantity AS BIGINT) AS STRING)"
    spellings = (
        r"concat(' ', {d}, '\t')",
        "concat('+', {d})",
        "concat('-', {d}, '.5')",
        "concat({d}, 'e3')",
        "concat('0x', {d})",
        "concat('-0X', {d}, 'aF')",
        "concat('92233720368547758', {d})",
        "concat({d}, '.0d')",
        "concat('.', {d})",
        "concat({d}, ',5')",
        "concat({d}, '_000')",
        "concat({d}, ' 0')",
        "''",
        "NULL",
        "concat('0x1p', {d})",
        "{d}",
        "'-Infinity'",
        "' inf'",
        "elt(1 + {d} % 4, 'NaN', '+nan', '-NAN', 'nan1')",
    )
    cases = " ".join(f"WHEN {i} THEN {s.format(d=digits)}" for i, s in enumerate(spellings))
    raw = f"CASE l_orderkey % {len(spellings)} {cases} END"
    return lineitem.selectExpr("l_orderkey", "l_linenumber", f"{raw} AS raw")


class RawTables(Mapping[str, DataFrame]):
    """Raw tables by lower-case name, each derived when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._given = cache(lambda name: given(spark, folder, name))
        self._cabinets = {cabinet.table.lower(): cabinet for cabinet in CABINETS}

    def __getitem__(self, name: str) -> DataFrame:
        if name == "af_installs":
            return installs_export(self._given("events"))
        return cabinet_export(self._given("lineitem"), self._cabinets[name])

    def __iter__(self) -> Iterator[str]:
        yield from [*self._cabinets, "af_installs"]

    def __len__(self) -> int:
        return len(self._cabinets) + 1
