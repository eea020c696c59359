"""The part of an all-sky reference catalogue that a set of images needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.functions.numeric import round_fractions
from skycal.functions.sky import add_healpix, ra_wrap

NSIDE = 8          # 768 pixels, each about 7.3 degrees wide
PIXEL = "hpx8"
CELL = 0.05              # degrees: objects in one cell are asked about once
POINTS_AROUND = 16

# The five points of an image that pick its pixels.
POINTS = [("RAC1", "DECC1"), ("RAC2", "DECC2"), ("RAC3", "DECC3"), ("RAC4", "DECC4"), ("RA_CENT", "DEC_CENT")]


def image_pixels(images: DataFrame, per: list[str] | None = None) -> DataFrame:
    """Distinct pixels under the corners and centres of the images: at most 768 rows, for each group of the columns per."""
    per = list(per or [])
    points = F.array(*[F.struct(F.col(ra).alias("ra"), F.col(dec).alias("dec")) for ra, dec in POINTS])
    points = images.select(*per, F.explode(points).alias("p")).select(*per, "p.ra", "p.dec")
    return add_healpix(points, NSIDE, "ra", "dec", PIXEL).select(*per, PIXEL).where(F.col(PIXEL).isNotNull()).distinct()


def object_pixels(observed: DataFrame, per: list[str] | None = None, tol_arcsec: float = 2.0) -> DataFrame:
    """Distinct pixels that hold every star within the tolerance of an object (RA, DEC), for each group of the columns per.

    Objects collapse to cells of CELL degrees where they are read, and a cell is looked at once for all groups. Around each cell, the pixels of its middle and of
    POINTS_AROUND points on a circle of four times its reach are taken: a pixel that comes as near as a star may be is seen from
    one of them, as its corners are wider than the angle between two. Around a pole the circle is a whole ring."""
    per = list(per or [])
    reach = 4 * (CELL * 0.75 + tol_arcsec / 3600)
    cells = observed.where("RA IS NOT NULL AND DEC IS NOT NULL").select(
        *per, F.floor(F.col("RA") / CELL).alias("_i"), F.floor(F.col("DEC") / CELL).alias("_j")).distinct()
    own, cells = cells, cells.select("_i", "_j").distinct() if per else cells
    ra, dec = (F.col("_i") + 0.5) * CELL, (F.col("_j") + 0.5) * CELL
    step = 360.0 / POINTS_AROUND
    turn = F.sequence(F.lit(0), F.lit(POINTS_AROUND - 1))
    point = lambda a, b: F.struct(a.alias("ra"), F.greatest(F.lit(-90.0), F.least(F.lit(90.0), b)).alias("dec"))
    around = F.transform(turn, lambda k: point(
        ra + reach * F.cos(F.radians(k * step)) / F.cos(F.radians(dec)), dec + reach * F.sin(F.radians(k * step))))
    ring = lambda b: F.transform(turn, lambda k: point(k * step, dec + b))
    rings = F.concat(ring(-reach), ring(0.0), ring(reach))
    points = F.when(F.abs(dec) > 87, rings).otherwise(F.concat(F.array(point(ra, dec)), around))
    points = cells.select("_i", "_j", F.explode(points).alias("p")).select("_i", "_j", "p.ra", "p.dec")
    found = add_healpix(points, NSIDE, "ra", "dec", PIXEL)
    if per:
        found = own.join(found.select("_i", "_j", PIXEL).distinct(), ["_i", "_j"])
    return found.select(*per, PIXEL).distinct()


def with_pixel(refcat: DataFrame) -> DataFrame:
    """Add the storage pixel; a catalogue written with partitionBy(PIXEL) has it already."""
    if PIXEL in refcat.columns:
        return refcat
    return add_healpix(refcat, NSIDE, "RA", "DEC", PIXEL)


def prune_reference(refcat: DataFrame, images: DataFrame, decimals: int | None = 6, pixels: DataFrame | None = None) -> DataFrame:
    """Catalogue rows in the images' pixels, or in the given ones, with RA_WRAP. On a catalogue partitioned by pixel the
    semi join prunes partitions at run time; its pixel side is bounded by the 768 pixels of the sky.
    Fractional columns are rounded, as the stored form of the catalogue has them."""
    stars = refcat.withColumnRenamed("Dec", "DEC")
    stars = with_pixel(stars).join(F.broadcast(image_pixels(images) if pixels is None else pixels.select(PIXEL).distinct()), PIXEL, "left_semi")
    stars = stars.withColumn("RA_WRAP", ra_wrap(F.col("RA")))
    return stars if decimals is None else round_fractions(stars, decimals)


def missing_pixels(refcat: DataFrame, images: DataFrame) -> DataFrame:
    """Pixels the images need and the catalogue lacks."""
    have = with_pixel(refcat).select(PIXEL).distinct()
    return image_pixels(images).join(have, PIXEL, "left_anti")
