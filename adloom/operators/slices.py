"""Slices: parts of a table that follow one another in the order of a key.

A window over a whole table, or over a hot key, would sort its rows in one task.  A window over
slices does not, and what has to be known beyond a slice is little: a row or two per slice.
Unlike the partitions of a range shuffle, slices are numbered by an expression, so a window over
them needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows sampled per slice, for slices of about the same size.
SAMPLED = 20

# Slices hash to partitions; several for each keep the partitions alike.
SLICES_PER_PARTITION = 4

_GROUPS = "slice_bounds"


@dataclass(frozen=True)
class Slices:
    """The lowest key of each slice, rising; keys are structs, which compare with NULL first."""

    key: tuple[str, ...]
    bounds: tuple[T.Row, ...]
    schema: T.StructType

    @property
    def number(self) -> int:
        return max(1, len(self.bounds))

    @property
    def key_sql(self) -> str:
        return f"struct({', '.join(f'{sql} AS k{i}' for i, sql in enumerate(self.key))})"

    def place(self, frame: DataFrame, name: str = "slice", begins: str | None = None) -> DataFrame:
        """Add the number of each row's slice, and whether the row has the slice's lowest key.

        Bounds lie in groups of about the root of their number, so that a row is compared with few.
        They travel as one broadcast row of at most as many keys as there are slices.
        """
        width = max(1, round(self.number**0.5))
        groups = [self.bounds[k : k + width] for k in range(0, len(self.bounds), width)] or [()]
        schema = T.StructType(
            [T.StructField(_GROUPS, T.ArrayType(T.ArrayType(self.schema["key"].dataType)))]
        )
        bounds = frame.sparkSession.createDataFrame([([list(g) for g in groups],)], schema)
        # Of keys before the lowest bound there are none, unless the table has changed.
        group = f"greatest(1, size(filter({_GROUPS}, g -> g[0] <= slice_key)))"
        within = "greatest(1, size(filter(slice_group, b -> b <= slice_key)))"
        placed = (
            frame.selectExpr("*", f"{self.key_sql} AS slice_key")
            .join(F.broadcast(bounds))
            .selectExpr("*", f"{group} AS slice_major")
            .selectExpr("*", f"{_GROUPS}[slice_major - 1] AS slice_group")
            .selectExpr("*", f"{within} AS slice_minor")
        )
        added = [f"CAST((slice_major - 1) * {width} + slice_minor - 1 AS INT) AS {name}"]
        if begins:
            added.append(f"slice_group[slice_minor - 1] = slice_key AS {begins}")
        return placed.selectExpr(*frame.columns, *added)


def slices_of(frame: DataFrame, key: Sequence[str], number: int) -> Slices:
    """Bounds for about so many slices of a table, from a sample and the lowest key.

    ``key`` holds SQL expressions.  The sample grows with the number of slices, not with the table.
    """
    key_sql = f"struct({', '.join(f'{sql} AS k{i}' for i, sql in enumerate(key))})"
    keys = frame.selectExpr(f"{key_sql} AS key")
    rows, lowest = keys.agg(F.count(F.lit(1)), F.min("key")).first()
    found = [] if lowest is None else [lowest]
    if number > 1 and rows > 1:
        share = min(1.0, SAMPLED * number / rows)
        sample = keys.sample(share, seed=1).orderBy("key").collect()
        found += [sample[k * len(sample) // number].key for k in range(1, number) if sample]
    # Equal bounds follow one another.
    bounds = [b for k, b in enumerate(found) if not k or b != found[k - 1]]
    return Slices(tuple(key), tuple(bounds), keys.schema)
