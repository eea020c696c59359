"""Magnitudes, the reference-to-survey colour transforms, and the row cuts."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Transform(NamedTuple):
    base: str      # magnitude the transform starts from
    blue: str      # colour = blue - red
    red: str
    slope: float
    offset: float
    error: str     # error column taken over unchanged
    lo: float      # valid for lo < colour <= hi
    hi: float


# Published colour terms per survey band, survey = base + slope * (blue - red) + offset.
TRANSFORMS = {
    "g": Transform("G", "G", "R", 0.0994, -0.0076, "DG", -0.2, 1.2),
    "r": Transform("R", "G", "R", -0.1335, 0.0189, "DR", -0.2, 1.2),
    "i": Transform("I", "I", "Z", -0.3407, 0.0026, "DI", -0.2, 0.3),
    "z": Transform("Z", "I", "Z", -0.2575, -0.0074, "DZ", -0.2, 0.3),
    "Y": Transform("Z", "I", "Z", -0.6032, 0.0185, "DZ", -0.2, 0.3),
}


def check_band(band: str) -> str:
    if band not in TRANSFORMS:
        raise ValueError(f"band {band!r} has no transform; known bands are {', '.join(TRANSFORMS)}")
    return band


def _by_band(band: Column, value) -> Column:
    """One expression per band; bands without a transform give NULL."""
    out = None
    for name, t in TRANSFORMS.items():
        out = F.when(band == name, value(t)) if out is None else out.when(band == name, value(t))
    return out


def mag_std(band: Column, suffix: str = "_1") -> Column:
    """Reference magnitude in the survey's band."""
    c = lambda name: F.col(name + suffix)
    return _by_band(band, lambda t: c(t.base) + t.slope * (c(t.blue) - c(t.red)) + t.offset)


def magerr_std(band: Column, suffix: str = "_1") -> Column:
    return _by_band(band, lambda t: F.col(t.error + suffix))


def colour_ok(band: Column, suffix: str = "_1") -> Column:
    """Colour inside the transform's range: open below, closed above."""
    def inside(t: Transform) -> Column:
        colour = F.col(t.blue + suffix) - F.col(t.red + suffix)
        return (colour > t.lo) & (colour <= t.hi)

    return _by_band(band, inside)


def inst_mag(flux: Column) -> Column:
    """-2.5 log10(flux): +inf at zero flux, NULL below zero (the logarithm is undefined)."""
    return F.when(flux > 0, -2.5 * F.log10(flux)).when(flux == 0, F.lit(float("inf")))


def quality_ok(mag: Column, err: Column, suffix: str = "_2") -> Column:
    """Usable star: sane magnitude and error, bright, unflagged, point-like. NULL counts as bad."""
    return reduce(and_, [
        mag >= 0.0,
        mag <= 25.0,
        F.col("FLUX_PSF" + suffix) > 10.0,
        F.col("FLAGS" + suffix) < 2,
        F.abs(F.col("SPREAD_MODEL" + suffix)) < 0.01,
        err < 0.1,
    ])
