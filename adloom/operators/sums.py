"""Sums per group that do not depend on the order of the rows.

A sum of doubles is rounded at every step, so its last digits follow the order in which rows
happen to arrive.  Here doubles are summed exactly and rounded once, to the nearest double, half to
even, which is what a sum without any error in between would give.

Every double is split into six whole numbers of 21 bits at fixed places, which 64-bit sums take up
for 2 ** 41 rows a group.  Six places hold 126 bits, enough for amounts from 2 ** -21 to 2 ** 42; for
others the places are moved by multiples of 63 bits.  How far they are moved is the window of the
double.  Rows are summed per group and window first, combining in each task; the few windows of a
group are put together after that, from rows that are sums already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits of a place, places of a window, places that windows are apart.
BITS, PLACES, APART = 21, 6, 3
BASE = 1 << BITS

# The lowest and the highest place of window 0; place g counts units of 2 ** (21 * g).
LOWEST, HIGHEST = -4, 1

# Places above the highest that a sum can carry into, and one for its sign.
CARRIES = 4


def _finite(value: str) -> str:
    return f"abs({value}) < double('Infinity')"


def _window(value: str) -> str:
    """The window of a double; next to a border either of the two would do."""
    usual = f"abs({value}) >= {2.0 ** -BITS!r}D AND abs({value}) < {2.0 ** (2 * BITS)!r}D"
    span = BITS * APART
    return f"""CAST(CASE WHEN {value} IS NULL OR {usual} OR {value} = 0 OR NOT {_finite(value)} THEN 0
        ELSE floor((log2(abs({value})) + {BITS}) / {span}) END AS INT)"""


def _moved(value: str, bits: str) -> str:
    """The value times a power of two, in two steps, as the power alone may be out of range."""
    return f"{value} * pow(2D, ({bits}) DIV 2) * pow(2D, ({bits}) - ({bits}) DIV 2)"


def _places(value: str) -> list[str]:
    """The whole numbers at the places of window 0, the highest first."""

    def above(place: int) -> str:
        return f"rint({value} * {2.0 ** (-BITS * place)!r}D)"

    rest = [f"{above(g)} - {above(g + 1)} * {BASE}D" for g in range(HIGHEST - 1, LOWEST - 1, -1)]
    return [f"CAST({sql} AS BIGINT)" for sql in (above(HIGHEST), *rest)]


def exact_sums(frame: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The sums of the metrics per group, with the keys before them.

    Doubles are summed exactly; other numbers as Spark sums them.  A sum of nothing but NULL is
    NULL; NaN makes a sum NaN, and so do infinities of both signs.
    """
    dtypes = {field.name: field.dataType for field in frame.schema}
    exact = [m for m in metrics if isinstance(dtypes[m], T.DoubleType)]
    plain = [m for m in metrics if m not in exact]
    if not exact:
        return frame.groupBy(*keys).agg(*(F.expr(f"sum({m}) AS {m}") for m in plain))
    windowed = frame.selectExpr(
        *keys, *plain, *exact, *(f"{_window(m)} AS {m}_window" for m in exact)
    ).selectExpr(
        *keys,
        *plain,
        *(f"{m}_window" for m in exact),
        *(f"IF({_finite(m)}, NULL, {m}) AS {m}_odd" for m in exact),
        *(
            f"""CASE WHEN NOT {_finite(m)} THEN NULL WHEN {m}_window = 0 THEN {m}
                ELSE {_moved(m, f'-{BITS * APART} * {m}_window')} END AS {m}_near"""
            for m in exact
        ),
    )
    first = [f"sum({m}) AS {m}" for m in plain]
    second = list(first)
    for m in exact:
        first += [f"sum({sql}) AS {m}_{j}" for j, sql in enumerate(_places(f"{m}_near"))]
        first.append(f"sum({m}_odd) AS {m}_odd")
        sums = f"array({', '.join(f'{m}_{j}' for j in range(PLACES))})"
        # A group has few windows: there are 34 in all.
        window = f"struct({m}_window AS window, {sums} AS sums)"
        second.append(f"collect_list(IF({m}_0 IS NULL, NULL, {window})) AS {m}_windows")
        second.append(f"sum({m}_odd) AS {m}_odd")
    summed = (
        windowed.groupBy(*keys, *(f"{m}_window" for m in exact))
        .agg(*map(F.expr, first))
        .groupBy(*keys)
        .agg(*map(F.expr, second))
    )
    for m in exact:
        summed = _rounded(summed, m)
    return summed.select(*keys, *metrics)


def _carried(sums: str) -> str:
    """Digits below the base from whole numbers, the lowest first, and what is carried out."""
    at_hand = "carry + s"
    return f"""aggregate({sums}, struct(CAST(array() AS ARRAY<BIGINT>) AS digits, 0L AS carry),
        (a, s) -> struct(concat(a.digits, array((a.{at_hand}) & {BASE - 1}L)) AS digits,
            shiftright(a.{at_hand}, {BITS}) AS carry))"""


def _rounded(frame: DataFrame, metric: str) -> DataFrame:
    """Put the windows of an exact sum together and round it to a double.

    The first 62 bits or so become a whole number whose last bit also tells whether anything
    follows; turning that into a double rounds as the whole sum would be rounded.
    """
    kept = [name for name in frame.columns if name not in (f"{metric}_windows", f"{metric}_odd")]
    windows, odd = f"{metric}_windows", f"{metric}_odd"
    place = f"{HIGHEST} + {APART} * w.window - g"
    at = f"aggregate({windows}, 0L, (a, w) -> a + coalesce(get(w.sums, {place}), 0L))"
    low = f"array_min(transform({windows}, w -> w.window)) * {APART} + {LOWEST}"
    high = f"array_max(transform({windows}, w -> w.window)) * {APART} + {HIGHEST + CARRIES}"
    digit = "coalesce(get(digits, top - {}), 0L)"
    steps = (
        {"low": f"IF(size({windows}) = 0, 0, {low})", "high": f"IF(size({windows}) = 0, 0, {high})"},
        {"sums": f"transform(sequence(low, high), g -> {at})"},
        {"negative": f"({_carried('sums')}).carry < 0"},
        {"digits": f"({_carried('transform(sums, s -> IF(negative, -s, s))')}).digits"},
        {"top": "array_max(filter(sequence(0, size(digits) - 1), i -> digits[i] != 0))"},
        {
            "leading": f"({digit.format(0)} * {BASE} + {digit.format(1)}) * {BASE}"
            f" + {digit.format(2)}",
            "following": digit.format(3),
            "room": f"greatest({BITS - 1} - length(bin(digits[top])), 0)",
        },
        {
            "bits": f"shiftleft(leading, room) + shiftright(following, {BITS} - room)",
            "sticky": f"""(following & (shiftleft(1L, {BITS} - room) - 1)) != 0
                OR exists(slice(digits, 1, greatest(top - 3, 0)), d -> d != 0)""",
            "moved": f"{BITS} * (low + top - 2) - room",
        },
    )
    for step in steps:
        frame = frame.selectExpr("*", *(f"{sql} AS {name}" for name, sql in step.items()))
    size = _moved("CAST(bits | CAST(sticky AS BIGINT) AS DOUBLE)", "moved")
    value = f"""CASE WHEN {odd} IS NOT NULL THEN {odd} WHEN size({windows}) = 0 THEN NULL
        WHEN top IS NULL THEN 0D WHEN negative THEN -({size}) ELSE {size} END"""
    # Filters on the sum stay above a generator; they would repeat all steps below it.
    return frame.selectExpr(*kept, f"inline(array(struct({value} AS {metric})))")
