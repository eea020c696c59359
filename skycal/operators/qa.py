"""Quality reports over zero points and the exposures behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skycal.functions.names import expnum_from_name
from skycal.operators.medians import median_of_large_groups

# The class limits of the quality report.
LOW_COUNT, FEW, MANY, GOOD_ERR = 5, 30, 55, 1e-2
BAD_CHI2, BAD_ERR, HIGH_CHI2 = 1000.0, 0.1, 200.0


def low_count(zp: DataFrame, below: int = LOW_COUNT, ra_above: float | None = None,
              ra: str = "RA_1_MEDIAN") -> DataFrame:
    """Zero points from fewer than `below` stars, optionally only east of an RA."""
    bad = zp.where(F.col("MAG_ZERO_NUM") < below)
    return bad if ra_above is None else bad.where(F.col(ra) > ra_above)


def zp_class() -> Column:
    """c1 many and precise, c2 fewer and precise, c3 imprecise, c4 few. All limits are strict, so
    rows exactly on one have no class."""
    num, err = F.col("MAG_ZERO_NUM"), F.col("MAG_ZERO_MEAN_ERR")
    return (F.when((num > MANY) & (err < GOOD_ERR), "c1")
            .when((num < MANY) & (num > FEW) & (err < GOOD_ERR), "c2")
            .when((num > FEW) & (err > GOOD_ERR), "c3")
            .when(num < FEW, "c4"))


def zp_classes(zp: DataFrame) -> DataFrame:
    """Complete rows (no NULL in any column) with their class in ZP_CLASS."""
    return zp.na.drop("any").withColumn("ZP_CLASS", zp_class())


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of rows per class, unclassed rows under NULL. The total is taken over the
    counts, of which there is a handful, so the rows are read once."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def err_stats(zp: DataFrame, column: str = "MAG_ZERO_MEAN_ERR", decimals: int = 4) -> DataFrame:
    """Minimum, mean, median, population deviation and count of the non-NULL errors, in one row."""
    med = median_of_large_groups(zp, [], column).select("median").scalar()
    r = lambda c: F.round(c, decimals)
    return zp.where(F.col(column).isNotNull()).agg(
        F.count(column).alias("n"), r(F.min(column)).alias("err_min"), r(F.avg(column)).alias("err_mean"),
        r(F.stddev_pop(column)).alias("err_std")).withColumn("err_median", r(med))


def with_expnum(zp: DataFrame, name: str = "FILENAME_2") -> DataFrame:
    return zp.withColumn("EXPNUM", expnum_from_name(F.col(name)).cast("bigint"))


def exposures_of(zp: DataFrame) -> DataFrame:
    return with_expnum(zp).select("EXPNUM").where(F.col("EXPNUM").isNotNull()).distinct()


def flagged_exposures(exposure: DataFrame, zp: DataFrame) -> DataFrame:
    """Exposures that a set of zero points comes from."""
    return exposure.join(exposures_of(zp), "EXPNUM", "left_semi")


def flag_exposures(exposure: DataFrame, zp: DataFrame, name: str = "FLAGGED") -> DataFrame:
    """Every exposure row with a membership flag."""
    bad = exposures_of(zp).withColumn(name, F.lit(True))
    return exposure.join(bad, "EXPNUM", "left").withColumn(name, F.coalesce(name, F.lit(False)))


def exposure_lookup(zp: DataFrame, exposure: DataFrame) -> DataFrame:
    """Exposure row per zero point; zero points that share an exposure each get it."""
    return with_expnum(zp).join(exposure, "EXPNUM")


def chi2_class(chi2: str = "astrom_chi2") -> Column:
    """Bad astrometry; good astrometry but a large error; everything else."""
    c, err = F.col(chi2), F.col("MAG_ZERO_MEAN_ERR")
    return (F.when(c > BAD_CHI2, "bad_astrometry")
            .when((c < BAD_CHI2) & (err > BAD_ERR), "large_error")
            .otherwise("rest"))


def chi2_band(chi2: str = "astrom_chi2") -> Column:
    """The three populations compared in the count histogram; NULL on a limit."""
    c, err = F.col(chi2), F.col("MAG_ZERO_MEAN_ERR")
    return (F.when((c < HIGH_CHI2) & (err < BAD_ERR), "low_chi2_small_error")
            .when((c < HIGH_CHI2) & (err > BAD_ERR), "low_chi2_large_error")
            .when(c > HIGH_CHI2, "high_chi2"))


def chi2_classes(zp: DataFrame, exposure: DataFrame) -> DataFrame:
    """Zero points with the astrometry of their exposure and both classes."""
    return (exposure_lookup(zp, exposure)
            .withColumn("CHI2_CLASS", chi2_class()).withColumn("CHI2_BAND", chi2_band()))


def distinct_exposures(zp: DataFrame) -> DataFrame:
    """Zero points and the distinct exposures behind them, in one row."""
    return with_expnum(zp).agg(F.count(F.lit(1)).alias("n_zero_points"),
                               F.count_distinct("EXPNUM").alias("n_exposures"))


def share(df: DataFrame, condition: Column, name: str = "share") -> DataFrame:
    return df.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("int")).alias(name))


def top_rows(df: DataFrame, order: list[str], n: int, skip: int = 0) -> DataFrame:
    """Rows skip+1 .. skip+n in order; a top-k per task, not a full sort, for small n."""
    ordered = df.orderBy(*order)
    return (ordered.offset(skip) if skip else ordered).limit(n)
