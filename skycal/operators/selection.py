"""Which exposures, images and catalogue files to calibrate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skycal.functions import names
from skycal.operators.tiles import assign_tiles, in_box

# The survey's selection.
BANDS = ("g", "r", "i", "z")
MIN_ABS_GLAT = 10.0
MIN_EXPTIME = 1.0
FILETYPE = "fullcat"

IMAGE_COLUMNS = ("expnum", "ccdnum", "band", "rac1", "decc1", "rac2", "decc2", "rac3", "decc3", "rac4", "decc4",
                 "ra_cent", "dec_cent", "racmax", "racmin", "crossra0")

Box = tuple[float, float, float, float]


def usable_exposures(exposure: DataFrame, bands=BANDS, min_glat=MIN_ABS_GLAT, min_exptime=MIN_EXPTIME) -> DataFrame:
    """Positioned, off the galactic plane, long enough and in a wanted band."""
    return exposure.where(
        F.col("radeg").isNotNull() & F.col("decdeg").isNotNull()
        & (F.abs("glat") > min_glat) & (F.col("exptime") > min_exptime) & F.col("band").isin(*bands))


def _region(df: DataFrame, box: Box | None, bounds: str) -> DataFrame:
    return df if box is None else df.where(in_box(F.col("radeg"), F.col("decdeg"), box, bounds))


def select_filepaths(archive: DataFrame, exposure: DataFrame, box: Box | None = None, bounds="half_open",
                     filetype=FILETYPE, **cuts) -> DataFrame:
    """(expnum, ccdnum, band, filepath) of the catalogue files of usable exposures."""
    exp = _region(usable_exposures(exposure, **cuts), box, bounds).select("expnum", "band")
    return (
        archive.where(F.col("filetype") == filetype).join(exp, "expnum")
        .select("expnum", "ccdnum", "band",
                names.file_path(F.col("path"), F.col("filename"), F.col("compression")).alias("filepath"))
    )


def select_exposures(exposure: DataFrame, box: Box | None = None, bounds="half_open", extra: tuple[str, ...] = (),
                     **cuts) -> DataFrame:
    """Exposure metadata with the commas in its free text replaced by spaces."""
    clean = lambda c: names.without_commas(F.col(c)).alias(c)
    return _region(usable_exposures(exposure, **cuts), box, bounds).select(
        "expnum", F.col("radeg").alias("expra"), F.col("decdeg").alias("expdec"), "exptime", "airmass",
        "band", "nite", "mjd_obs", clean("field"), clean("object"), clean("program"), *extra)


def select_images(image: DataFrame, exposure: DataFrame, box: Box | None = None, bounds="half_open",
                  bands=BANDS) -> DataFrame:
    """Image footprints in a wanted band whose exposure lies in the region. The exposure only filters."""
    exp = _region(exposure, box, bounds).select("expnum")
    return image.where(F.col("band").isin(*bands)).join(exp, "expnum", "left_semi").select(*IMAGE_COLUMNS)


def merge_selection(exposures: DataFrame, images: DataFrame, filepaths: DataFrame) -> DataFrame:
    """Exposure, image and file rows joined into one row per catalogue file, upper-case names."""
    up = names.upper_columns
    img_file = names.merge_keep_left(up(images), up(filepaths), ["EXPNUM", "CCDNUM"])
    return names.merge_keep_left(up(exposures), img_file, ["EXPNUM"])


def with_files(exposures: DataFrame, archive: DataFrame, image: DataFrame, bands=BANDS, filetype=FILETYPE) -> DataFrame:
    """merge_selection in one pass over selected exposures: images meet their files by exposure and chip, and the
    exposures, which filter both, are joined once."""
    images = image.where(F.col("band").isin(*bands)).select(*IMAGE_COLUMNS)
    files = archive.where(F.col("filetype") == filetype).select(
        "expnum", "ccdnum", names.file_path(F.col("path"), F.col("filename"), F.col("compression")).alias("filepath"))
    return merge_selection(exposures, images, files)


def select_survey_images(exposure: DataFrame, archive: DataFrame, image: DataFrame, tiles: DataFrame,
                         **cuts) -> DataFrame:
    """Every catalogue file of every tile, in one plan; TILE is the exposure's tile."""
    located = assign_tiles(usable_exposures(exposure, **cuts), tiles)
    exposures = select_exposures(located, extra=("tile",), **cuts)
    return with_files(exposures, archive, image, cuts.get("bands", BANDS))


def in_pixels(df: DataFrame, pixels: DataFrame, column: str = "hpix") -> DataFrame:
    """Rows whose pixel number is in a frame of pixels. A semi join, so the list may be any length."""
    return df.join(pixels.select(F.col(pixels.columns[0]).alias(column)), column, "left_semi")


def band_is(band: str) -> Column:
    return F.col("BAND") == band
