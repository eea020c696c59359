"""Histograms with the bin rules of the usual plotting call: half-open bins, the last one closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count_bins(rows: DataFrame, bins: int, index: Column, lo: Column, hi: Column) -> DataFrame:
    """(bin, lo, hi, n) with every bin present. bins is a plot's resolution, so the result is small."""
    counts = rows.select(index.alias("bin")).where(F.col("bin").between(0, bins - 1)).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"))
    every = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin", lo.alias("lo"), hi.alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def histogram_log(df: DataFrame, column: str, lo_exp: float = -3.0, hi_exp: float = 0.0, edges: int = 50) -> DataFrame:
    """Bins between log-spaced edges 10**linspace(lo_exp, hi_exp, edges); values outside are dropped.

    The logarithm gives the bin up to rounding at an edge; comparing the value with the two edges
    next to it settles that exactly."""
    bins = edges - 1
    step = (hi_exp - lo_exp) / bins
    edge = lambda i: F.pow(F.lit(10.0), lo_exp + step * i)
    x = F.col(column).cast("double")
    guess = F.floor((F.log10(x) - lo_exp) / step)
    index = F.when(x < edge(guess), guess - 1).when(x >= edge(guess + 1), guess + 1).otherwise(guess)
    index = F.when(x == edge(F.lit(bins)), F.lit(bins - 1)).otherwise(index).cast("int")
    return _count_bins(df.where(x > 0), bins, index, edge(F.col("bin")), edge(F.col("bin") + 1))


def histogram_linear(df: DataFrame, column: str, lo: float = 0.0, hi: float = 100.0, bins: int = 50) -> DataFrame:
    """Equal-width bins on [lo, hi]; values outside are dropped."""
    x = F.col(column).cast("double")
    width = (hi - lo) / bins
    index = (F.width_bucket(x, F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)) - 1).cast("int")
    index = F.when(x == hi, F.lit(bins - 1)).otherwise(index)
    return _count_bins(df.where(x.isNotNull()), bins, index, lo + width * F.col("bin"), lo + width * (F.col("bin") + 1))


def histogram_auto(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between the column's smallest and largest value (one half either side of a
    single value). The range is a one-row scalar subquery, so the data is read twice and never moved."""
    x = F.col(column).cast("double")
    rng = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).select(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("mn"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("mx"))
    lo, hi = rng.select("mn").scalar(), rng.select("mx").scalar()
    rows = df.where(x.isNotNull()).select(x.alias("_x"), lo.alias("_lo"), hi.alias("_hi"))
    index = F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)
    index = F.least(index, F.lit(bins - 1)).cast("int")
    edge = lambda i: lo + (hi - lo) / bins * i
    return _count_bins(rows, bins, index, edge(F.col("bin")), edge(F.col("bin") + 1))
