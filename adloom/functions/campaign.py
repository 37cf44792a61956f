"""Classification of campaigns by their names.

Names are cleaned first.  ``cleaned=True`` says that this was done before and saves doing it twice.
"""

from __future__ import annotations

from adloom.functions import fixed_values as fixed
from adloom.functions.text import contains_any, literal, process_strings

def is_realweb(campaign: str, cleaned: bool = False) -> str:
    """Does the cleaned name start with the agency prefix?  NULL for a NULL name."""
    name = campaign if cleaned else process_strings(campaign)
    return f"startswith({name}, {literal(fixed.AGENCY_PREFIX)})"


def is_ret_campaign(campaign: str, cleaned: bool = False) -> str:
    """Is this a retargeting campaign?  NULL for a NULL name.

    The pattern runs only on names that hold one of its words at all.
    """
    name = campaign if cleaned else f"lower({campaign})"
    possible = contains_any(name, fixed.RETARGETING_WORDS)
    return f"({possible} AND {name} RLIKE {literal(fixed.RETARGETING_PATTERN)})"


def platform(campaign: str, cleaned: bool = False) -> str:
    """ios, android or no_platform; a NULL name has no platform.

    No marker holds white space, so raw and cleaned names give the same answer.
    Staging relies on that to classify after aggregation, on groups, not on rows.
    """
    name = campaign if cleaned else f"lower({campaign})"
    return f"""CASE
        WHEN {contains_any(name, fixed.IOS_MARKERS)} THEN {literal(fixed.IOS)}
        WHEN {contains_any(name, fixed.ANDROID_MARKERS)} THEN {literal(fixed.ANDROID)}
        ELSE {literal(fixed.NO_PLATFORM)} END"""


def install_source(campaign: str) -> str:
    """Advertising network named by the code in the campaign, or ``other``.

    One map lookup runs the regex once; a chain of comparisons could run it per branch.
    """
    pattern = literal(fixed.INSTALL_CODE_PATTERN)
    code = f"regexp_extract({process_strings(campaign)}, {pattern}, 1)"
    networks = ", ".join(literal(x) for pair in fixed.SOURCE_BY_CODE.items() for x in pair)
    other = literal(fixed.UNKNOWN_SOURCE)
    return f"coalesce(try_element_at(map({networks}), {code}), {other})"
