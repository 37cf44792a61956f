"""Staging of advertising-cabinet exports: one description per cabinet, one operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adloom.functions import is_realweb, is_ret_campaign, platform, process_strings
from adloom.functions import safe_float, safe_int
from adloom.operators.sums import exact_sums


@dataclass(frozen=True)
class Cabinet:
    """Where a cabinet's export keeps the common columns.

    ``source`` is the network label that install classification gives the same network.
    A cabinet may lack ad sets or installs.  ``day_delivered`` marks an export whose date
    column already holds days; the others hold timestamps.
    """

    source: str
    table: str
    date: str
    campaign: str
    clicks: str
    costs: str
    impressions: str
    adset: str | None = None
    installs: str | None = None
    day_delivered: bool = False

    @property
    def model(self) -> str:
        return f"stg_{self.table.lower()}"

    @property
    def raw_columns(self) -> list[str]:
        names = [
            self.date,
            self.campaign,
            self.adset,
            self.clicks,
            self.costs,
            self.installs,
            self.impressions,
        ]
        return [name for name in names if name is not None]

    @property
    def keys(self) -> list[str]:
        return ["date", "campaign_name"] + (["adset_name"] if self.adset else [])

    @property
    def metrics(self) -> list[str]:
        return ["clicks", "costs"] + (["installs"] if self.installs else []) + ["impressions"]

    @property
    def schema(self) -> T.StructType:
        """Schema of the staged table."""
        text, flag = T.StringType(), T.BooleanType()
        fields = [("date", T.DateType())] + [(key, text) for key in self.keys[1:]]
        fields += [("platform", text), ("is_ret_campaign", flag), ("is_realweb", flag)]
        for metric in self.metrics:
            fields.append((metric, T.DoubleType() if metric == "costs" else T.LongType()))
        return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# Column names of the exports.
CABINETS: tuple[Cabinet, ...] = (
    Cabinet(
        source="facebook",
        table="facebook",
        date="date",
        campaign="Campaign",
        adset="adset",
        clicks="clicks",
        costs="spend",
        installs="installs",
        impressions="show",
        day_delivered=True,
    ),
    Cabinet(
        source="google_ads",
        table="google_ads",
        date="ad_date",
        campaign="campaign_name",
        adset="adset_name",
        clicks="clicks",
        costs="spend",
        installs="installs",
        impressions="impressions",
    ),
    Cabinet(
        source="huawei",
        table="huawei_ads",
        date="date",
        campaign="campaign_name",
        clicks="clicks",
        costs="spend",
        impressions="impressions",
    ),
    Cabinet(
        source="mytarget",
        table="mytarget",
        date="date",
        campaign="cmp_name",
        adset="adset",
        clicks="clicks",
        costs="costs",
        impressions="impressions",
    ),
    Cabinet(
        source="tiktok",
        table="TIKTOK",
        date="date",
        campaign="name",
        adset="adset",
        clicks="clicks",
        costs="costs",
        impressions="impressions",
    ),
    Cabinet(
        source="vkontakte",
        table="vkontakte",
        date="date",
        campaign="campaign_name",
        adset="adset_name",
        clicks="clicks",
        costs="spend",
        impressions="impressions",
    ),
    Cabinet(
        source="yandex",
        table="yandex",
        date="date",
        campaign="campaign_name",
        adset="adset_name",
        clicks="clicks",
        costs="spend",
        impressions="impressions",
    ),
)

CABINET_BY_MODEL: dict[str, Cabinet] = {cabinet.model: cabinet for cabinet in CABINETS}


def distinct_raw(raw: DataFrame, cabinet: Cabinet) -> DataFrame:
    """The cabinet's rows without repeats, compared on the raw columns staging reads.

    Two ads of one ad set with the same numbers count once.  Comparing cleaned values instead
    would merge more rows and change the sums.
    """
    return raw.select(*cabinet.raw_columns).distinct()


def _measures(raw: DataFrame, cabinet: Cabinet) -> list[str]:
    raw_name = {
        "clicks": cabinet.clicks,
        "costs": cabinet.costs,
        "installs": cabinet.installs,
        "impressions": cabinet.impressions,
    }
    types = {field.name.lower(): field.dataType for field in raw.schema}
    measures = []
    for metric in cabinet.metrics:
        cast = safe_float if metric == "costs" else safe_int
        name = raw_name[metric]
        measures.append(f"{cast(name, types[name.lower()])} AS {metric}")
    return measures


def _named(cabinet: Cabinet) -> list[str]:
    day = cabinet.date if cabinet.day_delivered else f"CAST({cabinet.date} AS DATE)"
    columns = [f"{day} AS date", f"{process_strings(cabinet.campaign)} AS campaign_name"]
    if cabinet.adset:
        columns.append(f"{process_strings(cabinet.adset)} AS adset_name")
    return columns


def _classified(campaign: str, cleaned: bool) -> list[str]:
    return [
        f"{platform(campaign, cleaned)} AS platform",
        f"{is_ret_campaign(campaign, cleaned)} AS is_ret_campaign",
        f"{is_realweb(campaign, cleaned)} AS is_realweb",
    ]


def unsummed(raw: DataFrame, cabinet: Cabinet) -> DataFrame:
    """Distinct rows with the staged columns, before the sums.

    A mart built straight from raw tables stacks these and saves each cabinet's own
    aggregation shuffle.  Flags read the raw name, so a filter on them reaches the scan as
    tests of the raw column.
    """
    rows = distinct_raw(raw, cabinet)
    return rows.selectExpr(
        *_named(cabinet), *_classified(cabinet.campaign, False), *_measures(rows, cabinet)
    )


def stage_cabinet(raw: DataFrame, cabinet: Cabinet) -> DataFrame:
    """Sums per day, campaign, ad set and platform, with the campaign flags.

    Platform and flags follow from the campaign name, so they are left out of the grouping and
    worked out on the groups.  All aggregates combine on the map side before they shuffle: a
    campaign that holds a large share of the rows reaches the second shuffle as a row or two per
    task.  Costs are summed exactly, so they do not depend on the order of the rows.
    """
    rows = distinct_raw(raw, cabinet)
    named = rows.selectExpr(*_named(cabinet), *_measures(rows, cabinet))
    return exact_sums(named, cabinet.keys, cabinet.metrics).selectExpr(
        *cabinet.keys, *_classified("campaign_name", True), *cabinet.metrics
    )
