"""Per-image object catalogues: flatten, stack, attach image metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.functions import names
from skycal.functions.numeric import nan_to_null
from skycal.functions.sky import ra_wrap

APERTURES = 12


def aperture(vector: str, n: int = APERTURES) -> list:
    """Numbered scalar columns of an aperture vector; NULL past its end."""
    return [F.get(vector, F.lit(i)).alias(f"{vector}_{i + 1:02d}") for i in range(n)]


def flatten_catalog(objects: DataFrame) -> DataFrame:
    """One scalar column per aperture, sky position under plain names, NaN as NULL.
    A projection over the scan: an aperture nobody asks for is not even taken from its vector."""
    flat = objects.select(
        names.base_name(F.col("FILENAME")).alias("FILENAME"), "NUMBER", "X_IMAGE", "Y_IMAGE",
        ra_wrap(F.col("ALPHAWIN_J2000")).alias("RA_WRAP"),
        F.col("ALPHAWIN_J2000").alias("RA"), F.col("DELTAWIN_J2000").alias("DEC"),
        "FLUX_PSF", "FLUXERR_PSF", *aperture("FLUX_APER"), *aperture("FLUXERR_APER"),
        "CLASS_STAR", "SPREAD_MODEL", "SPREADERR_MODEL", "FLAGS")
    return nan_to_null(flat)


def stack_catalogs(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def attach_metadata(objects: DataFrame, images: DataFrame, band: str | None = None) -> DataFrame:
    """Objects joined to the row of their image by file name. The image table grows with the survey,
    so its size decides at run time whether it is broadcast; it is not forced."""
    meta = images.withColumn("FILENAME", names.base_name(F.col("FILEPATH")))
    if band is not None:
        meta = meta.where(F.col("BAND") == band)
    return names.merge_keep_left(meta, objects, ["FILENAME"])


def attach_to_matches(matched: DataFrame, images: DataFrame) -> DataFrame:
    """The same join made after matching, on columns suffixed _2: only observations that found a star
    take part in it."""
    meta = images.withColumn("FILENAME", names.base_name(F.col("FILEPATH")))
    return names.merge_keep_left(names.suffix_columns(meta, "_2"), matched, ["FILENAME_2"])


def of_images(objects: DataFrame, images: DataFrame) -> DataFrame:
    """Objects of the listed images. A semi join whatever their number; its size at run time decides whether the
    list is sent to the scan."""
    listed = images.select(names.base_name(F.col("FILEPATH")).alias("FILENAME"))
    return objects.join(listed, "FILENAME", "left_semi")


def missing_catalogs(objects: DataFrame, images: DataFrame) -> DataFrame:
    """File names the image table lists and the object catalogues lack."""
    listed = images.select(names.base_name(F.col("FILEPATH")).alias("FILENAME")).distinct()
    return listed.join(objects.select("FILENAME").distinct(), "FILENAME", "left_anti")
