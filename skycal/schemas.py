"""Declared schemas of the tables the calibration reads. A missing number is NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
          "array<double>": T.ArrayType(T.DoubleType())}


def schema(columns: str) -> T.StructType:
    """"name type, ..." as a schema; unlike Spark's own parser it needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


EXPOSURE = schema(
    "expnum bigint, radeg double, decdeg double, glat double, exptime double, airmass double, "
    "band string, nite string, mjd_obs double, field string, object string, program string")

EXPOSURE_QA = T.StructType(EXPOSURE.fields + schema("hpix bigint, t_eff double, astrom_chi2 double").fields)

ARCHIVE = schema(
    "expnum bigint, ccdnum int, path string, filename string, compression string, filetype string")

IMAGE = schema(
    "expnum bigint, ccdnum int, band string, rac1 double, decc1 double, rac2 double, decc2 double, "
    "rac3 double, decc3 double, rac4 double, decc4 double, ra_cent double, dec_cent double, "
    "racmax double, racmin double, crossra0 string")

OBJECT_CATALOG = schema(
    "FILENAME string, NUMBER int, X_IMAGE double, Y_IMAGE double, ALPHAWIN_J2000 double, "
    "DELTAWIN_J2000 double, FLUX_PSF double, FLUXERR_PSF double, FLUX_APER array<double>, "
    "FLUXERR_APER array<double>, CLASS_STAR double, SPREAD_MODEL double, SPREADERR_MODEL double, FLAGS int")

REFCAT = schema(
    "RA double, DEC double, G double, R double, I double, Z double, "
    "DG double, DR double, DI double, DZ double, hpx8 bigint")

TILES = schema("index int, ramin double, ramax double, decmin double, decmax double")
