"""The whole calibration as one plan over all tiles and bands."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.operators.catalog import attach_to_matches, flatten_catalog, missing_catalogs, of_images
from skycal.operators.counts import StepCounts, watched
from skycal.operators.crossmatch import crossmatch
from skycal.operators.matchid import match_ids
from skycal.operators.materialize import dropped_afterwards, materialize
from skycal.operators.refcat import missing_pixels, object_pixels, prune_reference
from skycal.operators.selection import select_survey_images
from skycal.operators.zeropoints import zero_points
from skycal.sources.sinks import write_table


# What orders reference stars at one position.
STAR_ORDER = ["G", "R", "I", "Z", "DG", "DR", "DI", "DZ"]


class Calibration(NamedTuple):
    images: DataFrame        # one row per catalogue file, with tile and metadata
    stars: DataFrame         # reference stars near those images
    matched: DataFrame       # MATCHID, star columns _1, observation and image columns _2
    zero_points: DataFrame   # one row per image
    missing_catalogs: DataFrame   # files of those images without an object
    missing_pixels: DataFrame     # pixels of those images without a reference star


def _keep(df: DataFrame, store: str | None, name: str, partition_by: list[str] | None = None) -> DataFrame:
    if store is None:
        return df
    path = f"{store.rstrip('/')}/{name}"
    write_table(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def calibrate(exposure: DataFrame, archive: DataFrame, image: DataFrame, objects: DataFrame, refcat: DataFrame,
              tiles: DataFrame, tol_arcsec: float = 2.0, pick: str = "first", bands: tuple[str, ...] | None = None,
              all_medians: bool = True, flux: str = "FLUX_APER_08_2", fluxerr: str = "FLUXERR_APER_08_2",
              images: DataFrame | None = None, matched: DataFrame | None = None, store: str | None = None,
              prune: str = "images", number_per: list[str] | None = None, keep_matched: Callable[[DataFrame], DataFrame] | None = None,
              counts: StepCounts | None = None, **clip) -> Calibration:
    """Select images, prune the reference catalogue, flatten, match, attach metadata, and solve.

    Tile and band are columns, so what used to be one run per tile and band is one job; the median
    window is taken per tile and band. bands=None takes the survey's selection. A step is skipped by
    passing its result (images, matched) from an earlier run; store names a folder to keep them in,
    matches by band and tile; keep_matched stores the matches in another way, and returns them. MATCHID runs over all
    matches, or over those of each group of the columns number_per.

    prune="images" keeps the reference stars in the pixels of the images' corners and centres, so that which stars an image
    meets depends on the other images of the run; prune="objects" keeps those near any object, which loses none.

    counts takes the rows of each step: images, matched, quality, every clip pass, zero_points; of images and matches that
    are passed in none. All counts are there on return.

    The image table is written first, since several steps read it. Metadata is joined after the match, which depends on positions alone, so that the wide
    rows that find no star are shuffled once and not twice."""
    cuts = {} if bands is None else {"bands": tuple(bands)}
    if images is None:
        images = watched(counts, select_survey_images(exposure, archive, image, tiles, **cuts), "images")
        images = materialize(images, "images") if store is None else _keep(images, store, "images")
    if prune not in ("images", "objects"):
        raise ValueError(f"prune: {prune!r} is neither 'images' nor 'objects'")
    observed = of_images(flatten_catalog(objects), images)
    stars = prune_reference(refcat, images, pixels=object_pixels(observed, tol_arcsec=tol_arcsec) if prune == "objects" else None)
    own = matched is None
    if own:
        matched = attach_to_matches(crossmatch(stars, observed, tol_arcsec, pick, tie_break=STAR_ORDER), images)
        # Once the matches are kept, the ordered rows that their numbers were told by are a second copy of them.
        with dropped_afterwards(refcat.sparkSession) if keep_matched or store is not None else nullcontext():
            # The running number goes by star and then observation, as a sorted match file has it.
            matched = match_ids(matched, ["RA_WRAP_1", "DEC_1"], ["RA_WRAP_2", "DEC_2", "NUMBER_2", "FILENAME_2"], number_per)
            matched = watched(counts, matched, "matched")
            matched = keep_matched(matched) if keep_matched else _keep(matched, store, "matched", ["BAND_2", "TILE_2"])
    solved = zero_points(matched, F.col("BAND_2"), flux, fluxerr, median_per=["TILE_2", "BAND_2"],
                         all_medians=all_medians, counts=counts, stored=own, **clip)
    return Calibration(images, stars, matched, _keep(solved, store, "zero_points"),
                       missing_catalogs(flatten_catalog(objects), images), missing_pixels(refcat, images))
