"""Day and second of an install, read from its time text.

Text that does not fit the pattern gives NULL.  Text that fits but is no valid date raises,
so that a broken export is noticed.

Nearly all text is in the usual full form.  There the parts sit at fixed places and a plain cast
reads them, which is several times faster than extracting and parsing by format.
"""

from __future__ import annotations

from adloom.functions import fixed_values as fixed
from adloom.functions.text import extract_or_null, literal, trim_white_space

_SPACES = literal(r"\s+")
_USUAL = literal(fixed.EVENT_TIME_USUAL)


def event_date(text: str) -> str:
    day = extract_or_null(text, fixed.EVENT_DAY_PATTERN)
    return f"""CASE WHEN {text} RLIKE {_USUAL} THEN CAST(left({text}, 10) AS DATE)
        ELSE to_date({day}, {literal(fixed.DAY_FORMAT)}) END"""


def event_datetime(text: str) -> str:
    """Timestamp without time zone; milliseconds are cut off."""
    seconds = trim_white_space(extract_or_null(text, fixed.EVENT_SECOND_PATTERN))
    single_spaced = f"regexp_replace({seconds}, {_SPACES}, ' ')"
    return f"""CASE WHEN {text} RLIKE {_USUAL} THEN CAST(left({text}, 19) AS TIMESTAMP_NTZ)
        ELSE to_timestamp_ntz({single_spaced}, {literal(fixed.SECOND_FORMAT)}) END"""
