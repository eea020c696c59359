"""Separate the few huge groups of a frame from the many ordinary ones."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.operators.materialize import materialize

# A group beyond this many cells (rows times columns) is no longer handled inside one task: the exact medians of
# all its columns take some hundred bytes a cell. Both ways give the same rows; the tests hold them against
# each other at the limit itself.
HOT_CELLS = 3_000_000


def hot_rows_of(df: DataFrame) -> int:
    return max(1, HOT_CELLS // max(1, len(df.columns)))


class Split(NamedTuple):
    ordinary: DataFrame
    hot: DataFrame | None    # None if there is no hot group
    groups: int              # number of hot groups


def split_hot(df: DataFrame, keys: list[str], hot_rows: int | None = None, counted: DataFrame | None = None) -> Split:
    """Ordinary rows and the rows of hot groups, a group being hot with more than hot_rows rows. NULL keys are a
    group like any other.

    Runs one count per group, combined map-side; give it a frame that is cheap to read again, or counted with the same groups. The list of hot
    groups holds at most rows/hot_rows keys and is written. Usually it is empty, and then df itself is all there is;
    otherwise its size decides at run time how it is joined."""
    limit = hot_rows_of(df) if hot_rows is None else hot_rows
    hot = (df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = materialize(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys]), "hot-keys")
    found = hot.count()
    if not found:
        return Split(df, None, 0)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    return Split(df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi"), found)
