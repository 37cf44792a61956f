"""DuckDB statements that compute the registered queries' results independently.

Every statement reads the given tables as a whole.  Raw tables are spelled out as projections of
``lineitem`` and ``events``; staging, mart and checks build on them as common table expressions.
"""

from __future__ import annotations

from typing import NamedTuple

_SPACE = (
    r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}"
    r"\x{3000}]"
)


class Cabinet(NamedTuple):
    """Where an export keeps what; written out here, apart from the library's own table."""

    source: str
    table: str
    date: str
    campaign: str
    adset: str | None
    clicks: str
    costs: str
    installs: str | None
    impressions: str
    day_delivered: bool = False

    @property
    def model(self) -> str:
        return f"stg_{self.table.lower()}"

    @property
    def raw_columns(self) -> list[str]:
        return [name for name in self[2:9] if name]


CABINETS = (
    Cabinet("facebook", "facebook", "date", "Campaign", "adset", "clicks", "spend", "installs",
            "show", True),
    Cabinet("google_ads", "google_ads", "ad_date", "campaign_name", "adset_name", "clicks", "spend",
            "installs", "impressions"),
    Cabinet("huawei", "huawei_ads", "date", "campaign_name", None, "clicks", "spend", None,
            "impressions"),
    Cabinet("mytarget", "mytarget", "date", "cmp_name", "adset", "clicks", "costs", None,
            "impressions"),
    Cabinet("tiktok", "TIKTOK", "date", "name", "adset", "clicks", "costs", None, "impressions"),
    Cabinet("vkontakte", "vkontakte", "date", "campaign_name", "adset_name", "clicks", "spend",
            None, "impressions"),
    Cabinet("yandex", "yandex", "date", "campaign_name", "adset_name", "clicks", "spend", None,
            "impressions"),
)


def _name(column: str) -> str:
    """Column names may be reserved words."""
    return f'"{column}"'


def _raw(cabinet: Cabinet) -> str:
    return f"raw_{cabinet.table.lower()}"


def _texts(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _campaign(first: str, second: str) -> str:
    return f"""CASE WHEN {first} % 23 = 0 THEN NULL ELSE
 (CASE {first} % 5 WHEN 0 THEN ' Realweb' WHEN 1 THEN 'realweb' WHEN 2 THEN chr(9) || 'REALWEB'
  WHEN 3 THEN 'other' ELSE 'x_realweb' END) || '_' ||
 (CASE {second} % 9 WHEN 0 THEN 'FB' WHEN 1 THEN 'hw' WHEN 2 THEN 'mt' WHEN 3 THEN 'TikTok'
  WHEN 4 THEN 'uac' WHEN 5 THEN 'vk' WHEN 6 THEN 'ya' WHEN 7 THEN 'asa' ELSE 'ya2' END) ||
 (CASE {first} % 8 WHEN 0 THEN '_iOS_' WHEN 1 THEN '_[p:ios]' WHEN 2 THEN '_and_'
  WHEN 3 THEN '_[P:AND]' WHEN 4 THEN '_p01' WHEN 5 THEN '_p02' WHEN 6 THEN '_android'
  ELSE '_web' END) ||
 (CASE {first} % 11 WHEN 0 THEN '[ret]' WHEN 1 THEN '_old_' WHEN 2 THEN '_retarget'
  ELSE '_ua' END) || ' ' END"""


def _raw_cabinet(cabinet: Cabinet) -> str:
    day = "'2022-05-0' || CAST(1 + l_linenumber % 7 AS VARCHAR)"
    if cabinet.day_delivered:
        date = f"CAST({day} AS DATE)"
    else:
        hour = "[' 10:00:00', ' 00:00:00', ' 23:59:59.999'][1 + l_partkey % 3]"
        date = f"CAST({day} || {hour} AS TIMESTAMP)"
    quantity = "CAST(l_quantity AS BIGINT)"
    columns = {
        cabinet.date: date,
        cabinet.campaign: _campaign("l_partkey", "l_suppkey"),
        cabinet.adset: "CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 19 = 1"
        " THEN chr(160) || 'Набор' || CAST(l_partkey % 4 AS VARCHAR) || chr(8195)"
        " ELSE ' AdSet ' || CAST(l_partkey % 4 AS VARCHAR) END",
        cabinet.clicks: "CASE WHEN l_partkey % 13 = 0 THEN 'n/a' WHEN l_partkey % 17 = 0 THEN ''"
        f" WHEN l_partkey % 29 = 0 THEN '12.5' ELSE CAST({quantity} AS VARCHAR) END",
        cabinet.costs: "CASE WHEN l_partkey % 13 = 0 THEN '--' WHEN l_orderkey % 211 = 0 THEN 'NaN'"
        " WHEN l_partkey % 37 = 0 THEN '-0.1' WHEN l_orderkey % 41 = 0 THEN '1e15'"
        " WHEN l_orderkey % 43 = 0 THEN '-1e15'"
        " WHEN l_partkey % 47 = 0 THEN '9.313225746154785e-10'"
        f" ELSE CAST(CAST({quantity} AS DECIMAL(12, 0)) * 19.99 AS VARCHAR) END",
        cabinet.installs: "CASE WHEN l_partkey % 31 = 0 THEN NULL"
        f" ELSE CAST({quantity} % 5 AS VARCHAR) END",
        cabinet.impressions: f"CAST({quantity} * 100 AS VARCHAR)",
    }
    select = "SELECT " + ", ".join(f"{v} AS {_name(k)}" for k, v in columns.items() if k)
    own = f"FROM lineitem WHERE l_suppkey % 7 = {CABINETS.index(cabinet)}"
    return f"{select}, 'ad' AS ad {own} UNION ALL {select}, 'ad2' AS ad {own} AND l_linenumber = 1"


_RAW_INSTALLS = f"""SELECT
 CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN left(usual, 19)
  WHEN event_id % 107 = 0 THEN usual || chr(10)
  WHEN event_id % 109 = 0 THEN '2022-5-' || CAST(1 + event_id % 7 AS VARCHAR) || ' 9:'
   || CAST(event_id % 6 AS VARCHAR) || ':0.123'
  ELSE usual END AS event_time,
 {_campaign('user_id', 'event_id')} AS Campaign,
 CAST(event_id % 3 AS VARCHAR) AS af_c_id,
 CASE WHEN event_id % 19 = 0 THEN NULL
  WHEN event_id % 19 = 1 THEN chr(160) || 'Набор' || CAST(user_id % 4 AS VARCHAR) || chr(8195)
  ELSE ' AdSet ' || CAST(user_id % 4 AS VARCHAR) END AS af_adset,
 event_type AS Media_Source,
 CASE event_id % 9 WHEN 0 THEN ' iOS' WHEN 1 THEN 'Android ' WHEN 2 THEN NULL WHEN 3 THEN 'web'
  ELSE 'ios' END AS platform,
 CASE WHEN event_id % 97 = 0 THEN NULL
  ELSE 'af-' || CAST(event_id // 3 AS VARCHAR) END AS appsflyer_id
FROM (SELECT *, '2022-05-0' || CAST(1 + event_id % 7 AS VARCHAR) || ' 1'
  || CAST(event_id % 10 AS VARCHAR) || ':0' || CAST(event_id % 6 AS VARCHAR) || ':00.123' AS usual
 FROM events)"""


def _clean(text: str) -> str:
    return f"regexp_replace(lower({text}), '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _is_realweb(name: str) -> str:
    return f"starts_with({_clean(name)}, 'realweb')"


def _is_ret(name: str) -> str:
    return f"regexp_matches(lower({name}), '([\\[_]old[\\]_])|([\\[_]ret[\\]_])')"


def _has_marker(name: str, markers: tuple[str, ...]) -> str:
    return f"coalesce(list_bool_or([contains(lower({name}), m) FOR m IN {_texts(markers)}]), false)"


def _platform(name: str) -> str:
    ios = f"if({_has_marker(name, ('[p:ios]', '_ios_', 'p02'))}, 'ios', NULL)"
    android = _has_marker(name, ("[p:and]", "_and_", "android", "p01"))
    return f"coalesce({ios}, if({android}, 'android', NULL), 'no_platform')"


def _source(name: str) -> str:
    codes = _texts(("fb", "hw", "mt", "tiktok", "uac", "vk", "ya"))
    sources = _texts(
        ("facebook", "huawei", "mytarget", "tiktok", "google_ads", "vkontakte", "yandex")
    )
    code = f"regexp_extract({_clean(name)}, 'realweb_([a-z]+)_', 1)"
    return f"coalesce({sources}[list_position({codes}, {code})], 'other')"


def _int(text: str) -> str:
    """DuckDB rounds fractions, takes exponents and underscores: admit plain digits or hex."""
    trimmed = f"trim({text}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')"
    digits = f"regexp_replace(lower({trimmed}), '^[+-]?0x', '')"
    sign = f"CASE WHEN {trimmed} LIKE '-%' THEN -1 ELSE 1 END"
    return rf"""CASE WHEN regexp_full_match({trimmed}, '[+-]?\d+')
 THEN TRY_CAST({trimmed} AS BIGINT)
 WHEN regexp_full_match({trimmed}, '[+-]?0[xX][0-9a-fA-F]+')
 THEN {sign} * TRY_CAST('0x' || {digits} AS BIGINT) END"""


def _float(text: str) -> str:
    return rf"""CASE WHEN regexp_full_match({text}, '(?i)\s*[+-]?nan\s*')
 THEN CAST('nan' AS DOUBLE) WHEN regexp_full_match({text},
 '(?i)\s*[+-]?(inf(inity)?|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)\s*')
 THEN TRY_CAST(trim({text}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')
 AS DOUBLE) END"""


def _exact_parts(value: str) -> list[str]:
    """The sum in units of 2 ** -60, of which all values are multiples, as a 128-bit integer."""
    units = f"CAST({value} * {2.0**60!r} AS HUGEINT)"
    return [
        f"SUM(CASE WHEN NOT isnan({value}) THEN {units} END) AS units",
        f"bool_or(isnan({value})) AS odd",
    ]


def _rounded(table: str) -> str:
    """All other columns, and ``costs`` rounded once.

    The first bits become a 64-bit integer whose last bit tells whether anything follows, so that
    its conversion rounds as the whole would be.
    """
    size = "CAST(abs(units) AS DOUBLE)"
    cut = f"CASE WHEN units = 0 THEN 0 ELSE greatest(0, CAST(ceil(log2({size})) AS INT) - 60) END"
    step = "CAST(pow(2, cut) AS HUGEINT)"
    first = f"CAST(abs(units) // {step} * 2 + CAST(abs(units) % {step} <> 0 AS INT) AS BIGINT)"
    value = f"sign(units) * CAST({first} AS DOUBLE) * pow(2, cut - 61)"
    return f"""SELECT * EXCLUDE (units, odd, cut),
 CASE WHEN odd THEN CAST('nan' AS DOUBLE) ELSE {value} END AS costs
FROM (SELECT *, {cut} AS cut FROM {table})"""


def _event_day(text: str) -> str:
    return rf"""CASE WHEN regexp_matches({text}, '([\d-]*)\s')
 THEN CAST(regexp_extract({text}, '([\d-]*)\s', 1) AS DATE) END"""


def _event_second(text: str) -> str:
    return rf"""CASE WHEN regexp_matches({text}, '(.*)\.\d{{3}}$')
 THEN CAST(regexp_extract({text}, '(.*)\.\d{{3}}$', 1) AS TIMESTAMP) END"""


def _staged_cabinet(cabinet: Cabinet) -> str:
    raw_columns = ", ".join(map(_name, cabinet.raw_columns))
    keys = [f"CAST({_name(cabinet.date)} AS DATE) AS date"]
    keys.append(f"{_clean(cabinet.campaign)} AS campaign_name")
    if cabinet.adset:
        keys.append(f"{_clean(cabinet.adset)} AS adset_name")
    keys.append(f"{_platform(cabinet.campaign)} AS platform")
    keys.append(f"{_is_ret(_clean(cabinet.campaign))} AS is_ret_campaign")
    keys.append(f"{_is_realweb(_clean(cabinet.campaign))} AS is_realweb")
    counts = {
        "clicks": cabinet.clicks,
        "installs": cabinet.installs,
        "impressions": cabinet.impressions,
    }
    sums = _exact_parts(_float(_name(cabinet.costs)))
    for metric, column in counts.items():
        if column:
            sums.append(f"CAST(SUM({_int(_name(column))}) AS BIGINT) AS {metric}")
    return f"""WITH d AS (SELECT DISTINCT {raw_columns} FROM {_raw(cabinet)}),
 sums AS (SELECT {', '.join(keys + sums)} FROM d GROUP BY ALL)
{_rounded('sums')}"""


_TIES = ", ".join(
    f"{column} ASC NULLS FIRST"
    for column in ("event_time", "Campaign", "af_c_id", "af_adset", "Media_Source", "platform")
)
_NUMBERED = f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY appsflyer_id ORDER BY {_TIES})
 AS id_counter FROM (SELECT DISTINCT * FROM raw_af_installs)"""

_STAGED_INSTALLS = f"""SELECT {_event_day('event_time')} AS date,
 {_event_second('event_time')} AS event_time, {_clean('Campaign')} AS campaign_name,
 {_clean('af_adset')} AS adset_name, {_clean('Media_Source')} AS media_source,
 {_clean('platform')} AS platform, appsflyer_id, {_is_ret('Campaign')} AS is_ret_campaign,
 {_is_realweb('Campaign')} AS is_realweb, {_source('Campaign')} AS source
FROM numbered WHERE id_counter = 1"""


def _mart() -> str:
    kept = "WHERE is_realweb AND NOT is_ret_campaign"
    reported = [cabinet.source for cabinet in CABINETS if cabinet.installs]
    left_out = ", ".join(f"'{source}'" for source in ["other", *reported])
    parts = [f"SELECT *, '{c.source}' AS source FROM {c.model} {kept}" for c in CABINETS]
    parts.append(
        f"""SELECT date, campaign_name, adset_name, platform, source, 1 AS installs
 FROM stg_af_installs {kept} AND source NOT IN ({left_out})"""
    )
    return f"""SELECT date, campaign_name, adset_name, platform, source,
 CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(impressions) AS BIGINT) AS impressions,
 CAST(SUM(installs) AS BIGINT) AS installs, SUM(costs) AS costs
FROM ({' UNION ALL BY NAME '.join(parts)}) GROUP BY ALL"""


def _expressions() -> dict[str, str]:
    parts = {_raw(cabinet): _raw_cabinet(cabinet) for cabinet in CABINETS}
    parts["raw_af_installs"] = _RAW_INSTALLS
    parts |= {cabinet.model: _staged_cabinet(cabinet) for cabinet in CABINETS}
    parts["numbered"] = _NUMBERED
    parts["stg_af_installs"] = _STAGED_INSTALLS
    parts["all_cabinets"] = " UNION ALL BY NAME ".join(
        f"SELECT *, '{c.table.lower()}' AS cabinet FROM {c.model}" for c in CABINETS
    )
    parts["mart"] = _mart()
    parts["example_first"] = "SELECT 1 AS id UNION ALL SELECT NULL"
    parts["example_second"] = "SELECT * FROM example_first WHERE id = 1"
    parts["all_cabinet_campaigns"] = " UNION ALL ".join(
        f"SELECT '{c.table.lower()}' AS cabinet, {c.campaign} AS campaign FROM {_raw(c)}"
        for c in CABINETS
    )
    return parts


_PARTS = _expressions()


def _with(select: str) -> str:
    """Put the expressions before the statement; DuckDB skips those it does not use."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in _PARTS.items()) + "\n" + select


def _unique(model: str, column: str) -> str:
    return f"""SELECT {column} AS unique_field, COUNT(*) AS n_records FROM {model}
 WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1"""


def _accepted(model: str) -> str:
    return f"""SELECT platform AS value_field, COUNT(*) AS n_records FROM {model}
 WHERE platform NOT IN ('ios', 'android') GROUP BY platform"""


# What the usual parameters of a kind of check add to its name.
_SUFFIXES = {"accepted_values": "__ios__android"}


def _distinct(cabinet: Cabinet) -> str:
    common = {
        "campaign": cabinet.campaign,
        "adset": cabinet.adset,
        "clicks": cabinet.clicks,
        "costs": cabinet.costs,
        "installs": cabinet.installs,
        "impressions": cabinet.impressions,
    }
    named = ", ".join(f"{_name(column)} AS {name}" for name, column in common.items() if column)
    raw_columns = ", ".join(map(_name, cabinet.raw_columns))
    return f"""SELECT '{cabinet.table.lower()}' AS cabinet,
 CAST({_name(cabinet.date)} AS DATE) AS date, {named}
FROM (SELECT DISTINCT {raw_columns} FROM {_raw(cabinet)})"""


def _check_results() -> str:
    checks = [
        ("unique", "example_first", "id", _unique("example_first", "id")),
        ("not_null", "example_first", "id", "SELECT * FROM example_first WHERE id IS NULL"),
        ("unique", "example_second", "id", _unique("example_second", "id")),
        ("not_null", "example_second", "id", "SELECT * FROM example_second WHERE id IS NULL"),
        ("accepted_values", "stg_af_installs", "platform", _accepted("stg_af_installs")),
        (
            "unique",
            "stg_af_installs",
            "appsflyer_id",
            _unique("stg_af_installs", "appsflyer_id"),
        ),
        (
            "not_null",
            "stg_af_installs",
            "appsflyer_id",
            "SELECT * FROM stg_af_installs WHERE appsflyer_id IS NULL",
        ),
        (
            "not_null",
            "mart",
            "campaign_name",
            "SELECT * FROM mart WHERE campaign_name IS NULL",
        ),
        ("accepted_values", "mart", "platform", _accepted("mart")),
    ]
    return _counted(checks)


def _parameter_checks() -> str:
    def accepted(*values: str) -> str:
        listed = ", ".join(f"'{value}'" for value in values)
        return f"""SELECT platform FROM all_cabinets WHERE platform NOT IN ({listed})
 GROUP BY platform"""

    limited = "SELECT costs FROM all_cabinets WHERE NOT isnan(costs) AND costs > "
    return _counted(
        [
            ("accepted_values", "all_cabinets", "platform", accepted("ios", "android")),
            ("accepted_values", "all_cabinets", "platform", accepted("ios"), "__ios"),
            ("exceed_costs_limit", "all_cabinets", "costs", limited + "5000"),
            ("exceed_costs_limit", "all_cabinets", "costs", limited + "100", "__100"),
            (
                "not_null",
                "all_cabinets",
                "campaign_name",
                "SELECT 1 FROM all_cabinets WHERE campaign_name IS NULL",
            ),
            ("unique", "all_cabinets", "campaign_name", _unique("all_cabinets", "campaign_name")),
        ]
    )


def _counted(checks: list[tuple[str, ...]]) -> str:
    named = [
        (*check[:4], check[4] if len(check) > 4 else _SUFFIXES.get(check[0], ""))
        for check in checks
    ]
    return " UNION ALL ".join(
        f"""SELECT '{kind}_{model}_{column}{suffix}' AS "check", '{model}' AS model,
 '{column}' AS "column", COUNT(*) AS n_failures,
 CASE WHEN COUNT(*) > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({failing})"""
        for kind, model, column, failing, suffix in named
    )


_DIRTY = """SELECT l_orderkey, l_linenumber, CASE l_orderkey % 19
 WHEN 0 THEN ' ' || q || chr(9) WHEN 1 THEN '+' || q WHEN 2 THEN '-' || q || '.5'
 WHEN 3 THEN q || 'e3' WHEN 4 THEN '0x' || q WHEN 5 THEN '-0X' || q || 'aF'
 WHEN 6 THEN '92233720368547758' || q WHEN 7 THEN q || '.0d' WHEN 8 THEN '.' || q
 WHEN 9 THEN q || ',5' WHEN 10 THEN q || '_000' WHEN 11 THEN q || ' 0' WHEN 12 THEN ''
 WHEN 13 THEN NULL WHEN 14 THEN '0x1p' || q WHEN 15 THEN q WHEN 16 THEN '-Infinity'
 WHEN 17 THEN ' inf' ELSE ['NaN', '+nan', '-NAN', 'nan1'][1 + CAST(q AS BIGINT) % 4] END AS raw
FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q
 FROM lineitem)"""


def statements() -> dict[str, str]:
    """One DuckDB statement per registered query that SQL can express."""
    selects = {cabinet.model: f"SELECT * FROM {cabinet.model}" for cabinet in CABINETS}
    selects["stg_af_installs"] = "SELECT * FROM stg_af_installs"
    for key in ("mart", "mart_from_tables"):
        selects[key] = "SELECT * FROM mart"
    selects["ua_rows"] = "SELECT * FROM all_cabinets WHERE is_realweb AND NOT is_ret_campaign"
    selects["distinct_raw"] = " UNION ALL BY NAME ".join(map(_distinct, CABINETS))
    selects["read_sources"] = "SELECT * FROM all_cabinet_campaigns"
    selects["install_row_number"] = "SELECT * FROM numbered"
    selects["first_install"] = "SELECT * EXCLUDE (id_counter) FROM numbered WHERE id_counter = 1"
    selects["normalise_strings"] = f"""SELECT cabinet, campaign, {_clean('campaign')}
 AS campaign_name FROM all_cabinet_campaigns"""
    selects["campaign_flags"] = f"""SELECT cabinet, campaign, {_is_realweb('campaign')}
 AS is_realweb, {_is_ret('campaign')} AS is_ret_campaign FROM all_cabinet_campaigns"""
    selects["campaign_platform"] = f"""SELECT cabinet, campaign, {_platform('campaign')}
 AS platform FROM all_cabinet_campaigns"""
    selects["install_source"] = f"""SELECT Campaign AS campaign, {_source('Campaign')} AS source
 FROM raw_af_installs"""
    selects["parse_event_time"] = f"""SELECT event_time AS raw, {_event_day('event_time')} AS date,
 {_event_second('event_time')} AS event_time FROM raw_af_installs"""
    selects["check_unique"] = _unique("raw_af_installs", "appsflyer_id")
    selects["check_not_null"] = "SELECT * FROM stg_af_installs WHERE appsflyer_id IS NULL"
    selects["check_accepted_values"] = _accepted("stg_af_installs")
    selects["check_exceed_costs"] = """SELECT costs AS limit_field FROM all_cabinets
 WHERE NOT isnan(costs) AND costs > 5000"""
    selects["check_campaign_not_null"] = "SELECT * FROM all_cabinets WHERE campaign_name IS NULL"
    selects["check_parameters"] = _parameter_checks()
    selects["stored_limit_failures"] = """SELECT costs AS limit_field, COUNT(*) AS n_records
 FROM all_cabinets WHERE NOT isnan(costs) AND costs > 5000 GROUP BY costs"""
    selects["stored_null_rows"] = """SELECT *, COUNT(*) AS n_records FROM all_cabinets
 WHERE adset_name IS NULL GROUP BY ALL"""
    selects["stored_repeated_values"] = _unique("all_cabinets", "campaign_name")
    selects["sink_rebuilt"] = "SELECT * FROM all_cabinets WHERE costs IS NOT NULL"
    selects["check_mart_campaign"] = "SELECT * FROM mart WHERE campaign_name IS NULL"
    selects["check_mart_platform"] = _accepted("mart")
    for key in ("check_results", "checks_on_tables"):
        selects[key] = _check_results()
    selects["failed_checks"] = f"""SELECT "check", 'Failure in test ' || "check" AS message
 FROM ({_check_results()}) WHERE status = 'fail'"""
    selects["source_times"] = " UNION ALL ".join(
        f"""SELECT 'advertising' AS source_group, '{c.table.lower()}' AS table_name, newest,
 CASE WHEN newest >= TIMESTAMP '2022-05-07 12:00:00' THEN 'pass' ELSE 'error' END AS status
FROM (SELECT CAST(MAX({_name(c.date)}) AS TIMESTAMP) AS newest FROM {_raw(c)})"""
        for c in CABINETS
    )
    selects["stale_sources"] = f"""SELECT table_name AS "check",
 'Failure in test freshness of source ' || table_name AS message
FROM ({selects['source_times']}) WHERE status = 'error'"""
    selects["sink_view"] = selects["sink_table"] = "SELECT * FROM all_cabinets"
    selects["sink_partitioned"] = "SELECT * FROM stg_af_installs"
    result = {key: _with(select) for key, select in selects.items()}
    result["safe_cast_metrics"] = f"""SELECT l_orderkey, l_linenumber, raw,
 {_int('raw')} AS as_int, {_float('raw')} AS as_float FROM ({_DIRTY})"""
    return result
