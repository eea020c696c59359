"""Exact medians, for ordinary groups in one pass over sorted rows and for huge groups without gathering them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skycal.operators.materialize import materialize
from skycal.operators.skew import split_hot

# Bits of a key that one pass decides: a group has at most 2^BITS counts a pass and task, 64 / BITS passes in all.
BITS = 16
_LOW = (1 << 63) - 1


def _bits(method: str, x: Column) -> Column:
    """java.lang.Double's view of a double as a long, or the other way."""
    return F.java_method(F.lit("java.lang.Double"), F.lit(method), x)


def _sortable(x: Column, whole: bool) -> Column:
    """A long that sorts as the number does: whole numbers themselves; of doubles the bits, all but the sign turned over
    below zero, where larger bits are smaller numbers."""
    if whole:
        return x.cast("bigint")
    bits = _bits("doubleToLongBits", x.cast("double")).cast("bigint")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit(_LOW)))


def _number(key: Column, whole: bool) -> Column:
    if whole:
        return key.cast("double")
    return _bits("longBitsToDouble", key.bitwiseXOR(F.shiftright(key, 63).bitwiseAND(F.lit(_LOW)))).cast("double")


def median_of_large_groups(df: DataFrame, keys: list[str], value: str, name: str = "median", bits: int = BITS) -> DataFrame:
    """Exact median of value per key for groups of any size, by radix selection.

    Numbers become longs that sort alike, written once. Each pass counts the rows of every group by the next `bits` bits of
    their long, with map-side combining, and keeps the one or two prefixes that hold the two middle ranks; the next pass
    counts below those alone. The number of passes follows from `bits`, whatever the values, and nothing comes to the driver.
    A window orders the counts of one prefix: at most 2^bits rows. NULL values are passed over, as are rows with a NULL
    key; NaN is the largest number."""
    if not 1 <= bits <= 32:
        raise ValueError(f"bits: {bits} is not between 1 and 32")
    whole = df.schema[value].dataType.typeName() in ("byte", "short", "integer", "long")
    rows = df.where(F.col(value).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    by = keys or ["_all"]
    rows = rows.select(*(keys or [F.lit(0).alias("_all")]), _sortable(F.col(value), whole).alias("_key"))
    rows = materialize(rows, "keys")
    prefix = lambda left: F.shiftright("_key", left)
    group, state, left = Window.partitionBy(*by), None, 64
    while left:
        above, left = left, max(0, left - bits)
        if state is None:
            counts = rows.groupBy(*by, prefix(left).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
            n = F.sum("_c").over(group)
            # Ranks (n+1) div 2 and n div 2 + 1 are the middle row, or the two middle rows.
            counts = counts.withColumns({"_first": F.floor((n + 1) / 2), "_second": F.floor(n / 2) + 1, "_below": F.lit(0).cast("bigint")})
            within = group
        else:
            counts = rows.withColumn("_top", prefix(above)).join(state, [*by, "_top"]).groupBy(*by, "_top", prefix(left).alias("_p")).agg(
                F.count(F.lit(1)).alias("_c"), *[F.max(c).alias(c) for c in ("_first", "_second", "_below")])
            within = Window.partitionBy(*by, "_top")
        found = counts.withColumn("_upto", F.col("_below") + F.sum("_c").over(within.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)))
        found = found.where((F.col("_upto") >= F.col("_first")) & (F.col("_upto") - F.col("_c") < F.col("_second")))
        state = found.select(*by, F.col("_p").alias("_top"), "_first", "_second", (F.col("_upto") - F.col("_c")).alias("_below"))
    covers = lambda rank: (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_c") < F.col(rank))
    at = lambda rank: F.max(F.when(covers(rank), F.col("_p"))).alias(rank)
    middle = found.groupBy(*by).agg(at("_first"), at("_second")).select(
        *keys, _number(F.col("_first"), whole).alias("_a"), _number(F.col("_second"), whole).alias("_b"))
    return middle.select(*keys, F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise((F.col("_a") + F.col("_b")) / 2.0).alias(name))


def grouped_medians(df: DataFrame, keys: list[str], columns: list[str], suffix: str = "_MEDIAN",
                    hot_rows: int | None = None) -> DataFrame:
    """Exact median of each column per key, for any number of groups of any size."""
    ordinary, hot, _ = split_hot(df, keys, hot_rows)
    small = medians_in_one_pass(ordinary, keys, columns, suffix)
    return small if hot is None else small.unionByName(medians_of_hot_groups(hot, keys, columns, suffix))


def first_of_each(df: DataFrame, keys: list[str], columns: list) -> DataFrame:
    """One row per group of aggregates over it. Groups come one after the other in sorted rows, so a task keeps the
    values of one group at a time; a hash aggregate would keep those of many."""
    whole = Window.partitionBy(*keys)
    numbered = df.select(*keys, *[c(whole) for c in columns], F.row_number().over(whole.orderBy(*keys)).alias("_row"))
    return numbered.where("_row = 1").drop("_row")


def medians_in_one_pass(df: DataFrame, keys: list[str], columns: list[str], suffix: str = "_MEDIAN") -> DataFrame:
    return first_of_each(df, keys, [lambda w, c=c: F.median(c).over(w).alias(c + suffix) for c in columns])


def medians_of_hot_groups(hot: DataFrame, keys: list[str], columns: list[str], suffix: str = "_MEDIAN") -> DataFrame:
    """All columns at once: (column, value) rows under a common routine, then back to columns."""
    if not columns:
        return hot.select(*keys).distinct()
    # NULL keys are a group too, but never equal in the joins to come: they travel as a flag beside the key.
    marked = [f"_null_{k}" for k in keys]
    filled = hot.select(*[F.col(k).isNull().alias(m) for k, m in zip(keys, marked)], *[_some(hot, k) for k in keys], *[
        F.col(c).cast("double").alias(f"_v{j}") for j, c in enumerate(columns)])
    long = filled.select(*marked, *keys, F.explode(F.array(*[
        F.struct(F.lit(j).alias("_column"), F.col(f"_v{j}").alias("_value")) for j in range(len(columns))
    ])).alias("_cell")).select(*marked, *keys, "_cell.*")
    med = median_of_large_groups(long, [*marked, *keys, "_column"], "_value", "_median")
    wide = med.groupBy(*marked, *keys).agg(*[
        F.max(F.when(F.col("_column") == j, F.col("_median"))).alias(c + suffix) for j, c in enumerate(columns)])
    # A group whose columns are all NULL has no median rows but is still a group.
    groups = filled.select(*marked, *keys).distinct()
    return groups.join(wide, [*marked, *keys], "left").select(
        *[F.when(~F.col(m), F.col(k)).alias(k) for k, m in zip(keys, marked)], *[c + suffix for c in columns])


def _some(df: DataFrame, key: str):
    """The key, or any value of its type where it is NULL."""
    kind = df.schema[key].dataType
    return F.coalesce(F.col(key), F.lit("" if kind.typeName() == "string" else 0).cast(kind)).alias(key)
