"""Lenient casts of raw metrics: a value that cannot be cast becomes NULL.

Strings pass a pattern before ``try_cast``.  This settles which spellings count, and it is much
faster on dirty data: a failing ``try_cast`` raises and catches a Java exception for each row.
"""

from __future__ import annotations

from pyspark.sql import types as T

from adloom.functions.text import literal

_DECIMAL_INT = literal(r"^\s*[+-]?\d+\s*\z")
_HEX_INT = literal(r"^\s*([+-]?)0[xX]0*([0-9a-fA-F]{1,16})\s*\z")
_FLOAT = literal(r"(?i)^\s*[+-]?(inf(inity)?|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)\s*\z")
_NAN = literal(r"(?i)^\s*[+-]?nan\s*\z")


def safe_int(value: str, dtype: T.DataType) -> str:
    """Cast to a 64-bit integer, or NULL; fractional numbers round half away from zero."""
    if isinstance(dtype, T.StringType):
        sign = f"regexp_extract({value}, {_HEX_INT}, 1)"
        magnitude = f"conv(regexp_extract({value}, {_HEX_INT}, 2), 16, 10)"
        return f"""CASE
            WHEN {value} RLIKE {_DECIMAL_INT} THEN try_cast({value} AS BIGINT)
            WHEN {value} RLIKE {_HEX_INT}
            THEN try_cast(concat({sign}, {magnitude}) AS BIGINT) END"""
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return f"CAST({value} AS BIGINT)"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return f"try_cast(round({value}) AS BIGINT)"
    raise TypeError(f"cannot cast {dtype.simpleString()} to an integer")


def safe_float(value: str, dtype: T.DataType) -> str:
    """Cast to a double, or NULL; Java-only spellings such as 1.0d or 0x1p3 are refused.

    Not-a-number may have a sign, which means nothing.
    """
    if isinstance(dtype, T.StringType):
        return f"""CASE WHEN {value} RLIKE {_FLOAT} THEN try_cast({value} AS DOUBLE)
            WHEN {value} RLIKE {_NAN} THEN double('NaN') END"""
    if isinstance(dtype, T.NumericType):
        return f"CAST({value} AS DOUBLE)"
    raise TypeError(f"cannot cast {dtype.simpleString()} to a float")
