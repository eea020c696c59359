"""A running number over a total order, without a global window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skycal.operators.materialize import materialize

_ROW_BITS = 33     # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def running_id(df: DataFrame, order: list, name: str = "MATCHID", per: list[str] | None = None) -> DataFrame:
    """Number rows 1, 2, ... in the given order; with per, in each of the groups of those columns.

    The rows are range-partitioned and sorted, numbered inside each partition, and written, once; a cumulative sum
    over one count per partition then gives each partition its offset. The numbers are those of this one
    write, so it does not matter that partition bounds come from a sample. Rows that are equal in the order, full
    copies among them, are spread over partitions by their place in the input. Groups are ranges of the same
    order, each counted where it lies, so that numbering within them takes no further pass over the rows."""
    per = list(per or [])
    source = df.withColumn("_copy", F.monotonically_increasing_id())
    order = [*[F.col(c) for c in per], *order, F.col("_copy")]
    placed = (
        source.repartitionByRange(*order).sortWithinPartitions(*order).drop("_copy")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id")
    )
    # A table that is read once or twice: a dictionary of its doubles costs more than it saves.
    placed = materialize(placed, "ordered", dictionary=False)
    counts = placed.groupBy("_part", *per).agg(F.count(F.lit(1)).alias("_c"), F.min("_row").alias("_first"))
    # One row per partition of the range shuffle, and per group in it: a short list, whatever the number of rows. It is
    # written, so that its size decides how it is joined.
    before = Window.partitionBy(*per).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")
    offsets = materialize(counts.select("_part", *per, offset.alias("_offset")), "offsets")
    on = reduce(lambda x, y: x & y, [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in per], F.col("a._part") == F.col("b._part"))
    return (
        placed.alias("a").join(offsets.alias("b") if per else F.broadcast(offsets).alias("b"), on)
        .select((F.col("b._offset") + F.col("a._row") + 1).alias(name), *[F.col(f"a.`{c}`") for c in df.columns])
    )


def match_ids(matched: DataFrame, star_order: list[str], obs_order: list[str], per: list[str] | None = None) -> DataFrame:
    """MATCHID over (star order, observation order); with per, 1, 2, ... in each of the groups of those columns."""
    return running_id(matched, [F.col(c) for c in [*star_order, *obs_order]], per=per)
