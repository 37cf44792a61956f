"""Registry of raw tables and scans by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from adloom.sources.footers import require_files


@dataclass(frozen=True)
class SourceTable:
    """A raw table: which group it is delivered in, its name and what it holds.

    ``columns`` are the ones staging reads; tables nothing reads declare none.  The one named
    ``time`` holds days or timestamps; with ``days_only`` it must hold days.  Metrics may come as
    text or as numbers, all other columns are text.
    """

    group: str
    name: str
    description: str
    columns: tuple[str, ...] = ()
    time: str | None = None
    days_only: bool = False

    @property
    def schema(self) -> T.StructType:
        """The columns as an export delivers them: with text for every metric."""
        day = T.DateType() if self.days_only else T.TimestampType()
        return T.StructType(
            [T.StructField(c, day if c == self.time else T.StringType()) for c in self.columns]
        )

    def accepts(self, field: T.StructField) -> bool:
        """Whether staging can read a column of this type."""
        name, dtype = field.name.lower(), field.dataType
        if self.time is not None and name == self.time.lower():
            days = (T.DateType,)
            return isinstance(
                dtype, days if self.days_only else (*days, T.TimestampType, T.TimestampNTZType)
            )
        if name in _METRICS:
            return isinstance(dtype, (T.StringType, T.NumericType, T.BooleanType))
        return isinstance(dtype, T.StringType)


# The columns of the exports that hold metrics.
_METRICS = ("clicks", "spend", "costs", "installs", "impressions", "show")


# Raw table and column names as the exports deliver them.
_DECLARED = (
    SourceTable("application", "app_installs", "application installs"),
    SourceTable("application", "crm_data", "customer records"),
    SourceTable(
        "advertising",
        "AF_installs",
        "application installs from the attribution service",
        (
            "event_time",
            "Campaign",
            "af_c_id",
            "af_adset",
            "Media_Source",
            "platform",
            "appsflyer_id",
        ),
    ),
    SourceTable("advertising", "apple_search_ads", "Apple Search Ads cabinet"),
    SourceTable(
        "advertising",
        "facebook",
        "Facebook cabinet",
        ("date", "Campaign", "adset", "clicks", "spend", "installs", "show"),
        time="date",
        days_only=True,
    ),
    SourceTable(
        "advertising",
        "google_ads",
        "Google Ads cabinet",
        (
            "ad_date",
            "campaign_name",
            "adset_name",
            "clicks",
            "spend",
            "installs",
            "impressions",
        ),
        time="ad_date",
    ),
    SourceTable(
        "advertising",
        "huawei_ads",
        "Huawei Ads cabinet",
        ("date", "campaign_name", "clicks", "spend", "impressions"),
        time="date",
    ),
    SourceTable(
        "advertising",
        "mytarget",
        "MyTarget cabinet",
        ("date", "cmp_name", "adset", "clicks", "costs", "impressions"),
        time="date",
    ),
    SourceTable(
        "advertising",
        "TIKTOK",
        "TikTok cabinet",
        ("date", "name", "adset", "clicks", "costs", "impressions"),
        time="date",
    ),
    SourceTable(
        "advertising",
        "vkontakte",
        "VK cabinet",
        ("date", "campaign_name", "adset_name", "clicks", "spend", "impressions"),
        time="date",
    ),
    SourceTable(
        "advertising",
        "yandex",
        "Yandex cabinet",
        ("date", "campaign_name", "adset_name", "clicks", "spend", "impressions"),
        time="date",
    ),
)

SOURCES: dict[str, SourceTable] = {source.name.lower(): source for source in _DECLARED}


def source_table(name: str) -> SourceTable:
    """Look a raw table up by name, ignoring case."""
    try:
        return SOURCES[name.lower()]
    except KeyError:
        raise KeyError(f"{name} is no declared raw table") from None


def read_source(
    spark: SparkSession,
    name: str,
    *,
    folder: str | None = None,
    schemas: dict[str, str] | None = None,
    every_file: bool = True,
) -> DataFrame:
    """Scan a raw table from Parquet under ``folder``, or else from the catalog.

    ``schemas`` maps a source group to the catalog schema that holds it; by default the
    schema is named like the group.  ``every_file`` looks at the footers of all files in the folder,
    as one that lacks a column would read as NULL; without it, at the one Spark picks.
    """
    source = source_table(name)
    if folder is not None:
        path = f"{folder.rstrip('/')}/{source.name}"
        frame = spark.read.parquet(path)
        require_columns(frame, source)
        if every_file and source.columns:
            # Folders of partitions hold columns too; files need not repeat them.
            given = {field.name.lower(): field for field in frame.schema}
            in_files = {f.lower() for f in given} - set(partition_columns(frame))
            require_files(spark, path, lambda s: file_problem(s, source, given, in_files), name)
        return frame
    schema = (schemas or {}).get(source.group, source.group)
    frame = spark.table(f"{schema}.{source.name}")
    require_columns(frame, source)
    return frame


def partition_columns(frame: DataFrame) -> list[str]:
    """Lower-case names of columns that a scan takes from folder names."""
    files = frame.inputFiles()[:1]
    parts = files[0].split("/")[:-1] if files else []
    return [part.partition("=")[0].lower() for part in parts if "=" in part]


def file_problem(
    found: T.StructType,
    source: SourceTable,
    given: dict[str, T.StructField],
    in_files: set[str],
) -> str | None:
    """What keeps one file from being read like the others, if anything does."""
    present = {field.name.lower(): field for field in found}
    names = [column for column in source.columns if column.lower() in in_files]
    missing = [column for column in names if column.lower() not in present]
    if missing:
        return f"lacks {', '.join(missing)}"
    unlike = [
        f"{c} {present[c.lower()].dataType.simpleString()}"
        for c in names
        if not _read_alike(present[c.lower()].dataType, given[c.lower()].dataType)
    ]
    return f"has other types: {', '.join(unlike)}" if unlike else None


def _read_alike(own: T.DataType, others: T.DataType) -> bool:
    """Whether a file's type is read as the table's.

    A footer alone does not always tell a timestamp with a time zone from one without.
    """
    times = (T.TimestampType, T.TimestampNTZType)
    return own == others or isinstance(own, times) and isinstance(others, times)


def require_columns(frame: DataFrame, source: SourceTable) -> None:
    """Name missing columns and wrong types at once instead of failing deep inside a plan."""
    present = {field.name.lower(): field for field in frame.schema}
    missing = [column for column in source.columns if column.lower() not in present]
    if missing:
        raise ValueError(f"raw table {source.name} lacks {', '.join(missing)}")
    read = [present[column.lower()] for column in source.columns]
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in read if not source.accepts(f)]
    if wrong:
        raise ValueError(f"raw table {source.name} has unreadable columns: {', '.join(wrong)}")


def registry_frame(spark: SparkSession) -> DataFrame:
    """The registry itself as rows."""
    schema = T.StructType(
        [
            T.StructField("source_group", T.StringType(), False),
            T.StructField("table_name", T.StringType(), False),
            T.StructField("description", T.StringType(), False),
            T.StructField("columns_read", T.ArrayType(T.StringType(), False), False),
        ]
    )
    rows = [(s.group, s.name, s.description, list(s.columns)) for s in _DECLARED]
    return spark.createDataFrame(rows, schema)
