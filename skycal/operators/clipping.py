"""Iterated sigma clipping per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skycal.operators.counts import StepCounts, watched
from skycal.operators.materialize import materialize

# Float noise guard: values this close to the mean, relative to it, never count as outliers.
# A group of equal values has zero deviation but a mean that may be off in its last digit.
_NOISE = 1e-12


def is_outlier(x: Column, mean: Column, std: Column, nsigma: float) -> Column:
    """|x - mean| > nsigma * std; not an outlier where there is no deviation to speak of."""
    return F.coalesce(F.abs(x - mean) > nsigma * std + _NOISE * F.abs(mean), F.lit(False))


def flag_outliers(df: DataFrame, keys: list[str], value: str, nsigma: float = 3.0, name: str = "Outlier") -> DataFrame:
    """Add the outlier flag against the group's mean and sample deviation, one window per group."""
    group = Window.partitionBy(*keys)
    return df.withColumn(name, is_outlier(
        F.col(value), F.avg(value).over(group), F.stddev_samp(value).over(group), nsigma))


def _still_in(passes: int, value: str, nsigma: float) -> Column:
    """Rows that no one of the first passes flags, by the group's statistics of each of them."""
    still = F.lit(True)
    for k in range(passes):
        still = still & ~is_outlier(F.col(value), F.col(f"_mean{k}"), F.col(f"_std{k}"), nsigma)
    return still


def _clip_hot_groups(df: DataFrame, keys: list[str], value: str, nsigma: float, passes: int, counts: StepCounts | None) -> DataFrame:
    """The same flags for few huge groups, which never meet in one task. What a pass leaves of a group follows from the mean and
    deviation of the passes before, so each pass is one scan of keys and values, aggregated with map-side combine
    under the one row that each group has so far, which is written; the rows themselves are read once, at the end."""
    stats = None
    for k in range(passes):
        rows = df.select(*keys, value)
        if stats is not None:
            rows = rows.join(stats, keys).where(_still_in(k, value, nsigma))
        before = [f"_{what}{j}" for j in range(k) for what in ("mean", "std")]
        stats = rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in before], F.avg(value).alias(f"_mean{k}"),
                                        F.stddev_samp(value).alias(f"_std{k}"), F.count(F.lit(1)).alias("_rows"))
        stats = materialize(watched(counts, stats, f"clip pass {k + 1}", F.col("_rows")).drop("_rows"), "hot-statistics")
    last = passes - 1
    flagged = df.join(stats, keys).where(_still_in(last, value, nsigma)).withColumn(
        "Outlier", is_outlier(F.col(value), F.col(f"_mean{last}"), F.col(f"_std{last}"), nsigma))
    return flagged.select(*df.columns, "Outlier")


def sigma_clip(df: DataFrame, keys: list[str], value: str, nsigma: float = 3.0, passes: int = 3,
               apply_last: bool = False, hot_groups: int = 0, counts: StepCounts | None = None) -> DataFrame:
    """Flag `passes` times, removing flagged rows before each new pass.

    The last pass's flags stay in column Outlier and remove nothing unless apply_last is set, so the
    default of three passes removes twice. The windows of all passes and a later aggregate on the same
    keys share one shuffle and one sort. Groups too large for a window (hot_groups of them) are clipped by aggregate and join. Rows with a NULL key belong to no group.
    counts takes the rows that come into each pass."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    if not passes:
        return df
    if hot_groups:
        df = _clip_hot_groups(df, keys, value, nsigma, passes, counts)
        return df.where(~F.col("Outlier")) if apply_last else df
    for i in range(passes):
        if i:
            df = df.where(~F.col("Outlier")).drop("Outlier")
        df = flag_outliers(watched(counts, df, f"clip pass {i + 1}"), keys, value, nsigma)
    return df.where(~F.col("Outlier")) if apply_last else df
