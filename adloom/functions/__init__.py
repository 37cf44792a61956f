"""Column functions as SQL text.

Each takes a column name (or any SQL expression) and returns a SQL expression, for ``selectExpr``,
``F.expr`` or a ``spark.sql`` statement.  Text reaches the JVM in one call per frame, while
``Column`` objects cost one or more calls per operator, which adds up over the whole mart.
"""

from adloom.functions.campaign import install_source, is_realweb, is_ret_campaign, platform
from adloom.functions.casts import safe_float, safe_int
from adloom.functions.event_time import event_date, event_datetime
from adloom.functions.text import (
    contains_any,
    extract_or_null,
    identifier,
    literal,
    process_strings,
    trim_white_space,
)

__all__ = [
    "contains_any",
    "event_date",
    "event_datetime",
    "extract_or_null",
    "identifier",
    "install_source",
    "is_realweb",
    "is_ret_campaign",
    "literal",
    "platform",
    "process_strings",
    "safe_float",
    "safe_int",
    "trim_white_space",
]
