"""One photometric zero point per image from matched observations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skycal.functions import photometry as phot
from skycal.functions.numeric import nan_to_null, numeric_columns, require_columns
from skycal.operators.clipping import sigma_clip
from skycal.operators.counts import StepCounts, watched
from skycal.operators.materialize import materialize
from skycal.operators.medians import first_of_each, median_of_large_groups, medians_of_hot_groups
from skycal.operators.skew import split_hot

# Half-width in magnitudes of the window around the typical difference.
WINDOW = 5.0


def magnitudes(matched: DataFrame, band: Column, flux: str = "FLUX_APER_08_2") -> DataFrame:
    """Rows inside the colour range of their band, with MAG_STD, MAGERR_STD, MAG_OBS and MAG_DIFF."""
    return (
        matched.where(phot.colour_ok(band))
        .withColumn("MAG_STD", phot.mag_std(band))
        .withColumn("MAGERR_STD", phot.magerr_std(band))
        .withColumn("MAG_OBS", phot.inst_mag(F.col(flux)))
        .withColumn("MAG_DIFF", F.col("MAG_STD") - F.col("MAG_OBS"))
    )


def quality_cut(mags: DataFrame) -> DataFrame:
    return mags.where(phot.quality_ok(F.col("MAG_STD"), F.col("MAGERR_STD")))


def unit_medians(rows: DataFrame, per: list[str]) -> DataFrame:
    """Median MAG_DIFF of every (tile, band), computed once and kept, so the passes that follow only join it."""
    return materialize(median_of_large_groups(rows, per, "MAG_DIFF", "_med"), "median")


def median_window(rows: DataFrame, per: list[str], half_width: float = WINDOW, med: DataFrame | None = None) -> DataFrame:
    """Rows strictly within half_width of the median MAG_DIFF of their (tile, band), or of the given ones."""
    med = unit_medians(rows, per) if med is None else med
    with_med = rows.join(med, per) if per else rows.withColumn("_med", med.scalar())
    near = (F.col("MAG_DIFF") > F.col("_med") - half_width) & (F.col("MAG_DIFF") < F.col("_med") + half_width)
    return with_med.where(near).drop("_med")


def zero_point_stats(value: str = "MAG_DIFF", over: Callable[[Column], Column] = lambda c: c) -> list[Column]:
    """Mean, deviation, count and the error of the mean with n-1; NULL error for a single row. Aggregates, or the
    same over a window."""
    n, std = over(F.count(value)), over(F.stddev_samp(value))
    return [
        over(F.avg(value)).alias("MAG_ZERO_MEAN"),
        std.alias("MAG_ZERO_STD"),
        F.when(n > 1, std / F.sqrt(n - 1)).alias("MAG_ZERO_MEAN_ERR"),
        n.alias("MAG_ZERO_NUM"),
    ]


def clip_and_aggregate(rows: DataFrame, keys: list[str], medians: list[str], nsigma: float = 3.0,
                       passes: int = 3, apply_last: bool = False, hot_rows: int | None = None,
                       counts: StepCounts | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Clip per image and aggregate. Ordinary images take one shuffle and one sort: the windows of the clip, the
    statistics and every median share them, and a task holds one image at a time. Images beyond hot_rows
    rows (by default so many that their cells are HOT_CELLS) never meet in one task. counted holds the same rows in a
    form that is cheaper to count; rows themselves are then read once, and those of huge images written."""
    ordinary, hot, groups = split_hot(rows, keys, hot_rows, counted)
    if hot is not None and counted is not None:
        hot = materialize(hot, "hot-rows")
    ordinary = sigma_clip(ordinary, keys, "MAG_DIFF", nsigma, passes, apply_last, counts=counts)
    names = list(dict.fromkeys([*medians, "MAG_DIFF"]))
    last = [*keys, *[f"{c}_MEDIAN" for c in medians], F.col("MAG_DIFF_MEDIAN").alias("MAG_ZERO_MEDIAN"),
            "MAG_ZERO_MEAN", "MAG_ZERO_STD", "MAG_ZERO_MEAN_ERR", "MAG_ZERO_NUM"]

    small = first_of_each(ordinary, keys, [
        *[lambda w, c=c: F.median(c).over(w).alias(f"{c}_MEDIAN") for c in names],
        *[lambda w, k=k: zero_point_stats(over=lambda c: c.over(w))[k] for k in range(len(zero_point_stats()))]])
    if hot is None:
        return small.select(*last)
    hot = materialize(sigma_clip(hot, keys, "MAG_DIFF", nsigma, passes, apply_last, groups, counts), "hot-clipped")
    large = hot.groupBy(*keys).agg(*zero_point_stats()).join(medians_of_hot_groups(hot, keys, names), keys)
    return small.select(*last).unionByName(large.select(*last))


def zero_points(matched: DataFrame, band: str | Column, flux: str = "FLUX_APER_08_2",
                fluxerr: str = "FLUXERR_APER_08_2", key: str = "FILENAME_2", median_per: list[str] | None = None,
                all_medians: bool = True, nsigma: float = 3.0, passes: int = 3, apply_last: bool = False,
                hot_rows: int | None = None, counts: StepCounts | None = None, stored: bool = False) -> DataFrame:
    """Zero points of every image in a matched frame.

    band is a band name, or a column with each row's band (rows of a band without a transform give
    nothing). median_per names the columns of one calibration unit, tile and band in a survey.
    The rows that pass the quality cut are written once, since the median, the group sizes, the clip
    and the aggregates each read them. stored says that matched is a table of files: then only keys and differences are
    written for the median and the group sizes, and clip and aggregates read of the table the columns they need. counts takes the rows of quality, of each clip pass and of
    the result, which is written then, so that they are there on return."""
    need = ["G_1", "R_1", "I_1", "Z_1", "DG_1", "DR_1", "DI_1", "DZ_1", flux, fluxerr, key,
            "FLUX_PSF_2", "FLAGS_2", "SPREAD_MODEL_2", *(median_per or [])]
    require_columns(matched, need)
    if isinstance(band, str):
        band = F.lit(phot.check_band(band))
    per = list(median_per or [])
    keep_keys = list(dict.fromkeys([key, *per]))

    rows = quality_cut(magnitudes(nan_to_null(matched), band, flux))
    medians = [c for c in numeric_columns(rows) if c not in keep_keys] if all_medians else []
    wanted = rows.select(*keep_keys, *(medians or ["MAG_DIFF"]))
    kept = materialize(watched(counts, rows.select(*keep_keys, "MAG_DIFF") if stored else wanted, "quality"), "quality")
    med = unit_medians(kept, per)
    near = median_window(kept, per, med=med)
    solved = clip_and_aggregate(median_window(wanted, per, med=med) if stored else near, keep_keys, medians, nsigma, passes,
                                apply_last, hot_rows, counts, near if stored else None)
    return solved if counts is None else materialize(counts.watch(solved, "zero_points"), "zero_points")
