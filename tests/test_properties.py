"""Column functions against plain Python on many generated values at once."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from adloom import functions as A
from adloom.functions import fixed_values as fixed
from adloom.operators.installs import first_install, number_installs
from adloom.session import new_folder

STRING = T.StringType()
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

pieces = st.sampled_from(
    ["realweb", "Realweb", "_", "[", "]", "ret", "OLD", "p01", "P02", "[p:ios]", "_iOS_", "_and_"]
    + ["android", "[P:and]", "fb", "hw", "mt", "tiktok", "uac", "vk", "ya", "ya2", " ", "\t", "x"]
    + [" ", "\n", "кампания"]
)
names = st.lists(st.none() | st.lists(pieces, max_size=9).map("".join), min_size=150, max_size=300)

number_pieces = st.sampled_from(
    list("0123456789") + ["+", "-", ".", "e", "E", "0x", "0X", "f", "d", "a", " ", "\t", "_", ","]
    + ["inf", "nan", "12", "9223372036854775807", "9223372036854775808"]
)
numbers = st.lists(
    st.none() | st.lists(number_pieces, max_size=5).map("".join), min_size=150, max_size=300
)


def clean(name):
    return name.lower().strip(fixed.WHITE_SPACE)


def known(function):
    return lambda value: None if value is None else function(value)


@FEW
@given(names)
def test_classification(column, values):
    assert column(A.process_strings("x"), values) == list(map(known(clean), values))

    def starts(name):
        return clean(name).startswith("realweb")

    def retargeting(name):
        return re.search(r"[\[_](old|ret)[\]_]", name.lower()) is not None

    def platform(name):
        if name and re.search(r"\[p:ios\]|_ios_|p02", name.lower()):
            return "ios"
        if name and re.search(r"\[p:and\]|_and_|android|p01", name.lower()):
            return "android"
        return "no_platform"

    def source(name):
        code = re.search(r"realweb_([a-z]+)_", clean(name or ""))
        return fixed.SOURCE_BY_CODE.get(code and code.group(1), "other")

    assert column(A.is_realweb("x"), values) == list(map(known(starts), values))
    assert column(A.is_ret_campaign("x"), values) == list(map(known(retargeting), values))
    assert column(A.platform("x"), values) == list(map(platform, values))
    assert column(A.install_source("x"), values) == list(map(source, values))


def python_int(text):
    text = text.strip(" \t\n\v\f\r")
    if re.fullmatch(r"[+-]?[0-9]+", text):
        value = int(text)
    elif re.fullmatch(r"[+-]?0[xX][0-9a-fA-F]+", text):
        value = int(text, 16)
    else:
        return None
    return value if -(2**63) <= value < 2**63 else None


def python_float(text):
    if "_" in text or not text.isascii():
        return None
    try:
        return float(text)
    except ValueError:
        return None


@FEW
@given(numbers)
def test_casts(column, values):
    assert column(A.safe_int("x", STRING), values) == list(map(known(python_int), values))
    found = column(A.safe_float("x", STRING), values)
    assert list(map(str, found)) == list(map(str, map(known(python_float), values)))


rows = st.lists(
    st.tuples(
        *[st.sampled_from([None, "", "a", "b", "é"])] * 6, st.sampled_from([None, "i", "j", "k"])
    ),
    min_size=1,
    max_size=60,
)


@pytest.mark.parametrize("slices", [1, 7])
@FEW
@given(rows=rows)
def test_first_install_is_number_one(spark, slices, rows):
    raw = spark.createDataFrame(
        rows,
        "event_time string, Campaign string, af_c_id string, af_adset string, "
        "Media_Source string, platform string, appsflyer_id string",
    ).repartition(slices)
    numbered = number_installs(raw, new_folder(spark, "slices"))
    first = numbered.where("id_counter = 1").drop("id_counter")
    assert Counter(map(tuple, first.collect())) == Counter(map(tuple, first_install(raw).collect()))
    assert numbered.count() == len(set(rows))
