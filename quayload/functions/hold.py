"""Intermediate results that several later expressions read.

A rule names what it needs more than once. Held columns become projections of
their own, level by level, before the final one. Catalyst keeps such a projection
apart when its columns are read more than once, so each is computed once per row
and the generated methods stay small enough for the JVM to compile.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Takes a level and a column, gives the column to use from then on.
Holder = Callable[[int, Column], Column]

# Order of the levels: later ones may read earlier ones.
DECODED, SPLIT, SCALED, ROUNDED, JUDGED, NULL_JUDGED = range(6)


def inline(level: int, column: Column) -> Column:
    """Hold nothing: the expression stays where it is used."""
    return column


class Hold:
    """Collects held columns and adds them to a DataFrame."""

    def __init__(self) -> None:
        self.levels: dict[int, dict[str, Column]] = defaultdict(dict)
        self.count = 0

    def __call__(self, level: int, column: Column) -> Column:
        name = f"__held_{self.count}"
        self.count += 1
        self.levels[level][name] = column
        return F.col(name)

    def add_to(self, df: DataFrame) -> DataFrame:
        for level in sorted(self.levels):
            df = df.withColumns(self.levels[level])
        return df
