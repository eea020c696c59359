"""A sky derived from the driver's business tables, which hold no astronomy.

Each table is one SQL text that Spark and DuckDB evaluate alike: integer arithmetic, then one scaling
(1e-2 is a double in both engines, 0.01 is not). Spark runs it over DataFrames, the oracle over views.
All of it grows with the driver's tables and uses every row of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skycal.operators.materialize import materialize

# Reference stars, one per part, and a close twin (0.0003, 0.0001 degrees away) for a fifth of them.
STAR = """
SELECT p_partkey*2 AS star_id, CAST((p_partkey*3701) % 36000 AS DOUBLE)*1e-2 AS ra,
  CAST((p_partkey*53) % 1000 AS DOUBLE)*1e-1-80 AS dec,
  14+CAST(p_partkey % 50 AS DOUBLE)*1e-1 AS g,
  14+CAST(p_partkey % 50 AS DOUBLE)*1e-1-(CAST(p_partkey % 17 AS DOUBLE)*1e-1-3e-1) AS r,
  14+CAST(p_partkey % 50 AS DOUBLE)*1e-1-CAST(p_partkey % 11 AS DOUBLE)*2e-2 AS i,
  14+CAST(p_partkey % 50 AS DOUBLE)*1e-1-CAST(p_partkey % 11 AS DOUBLE)*2e-2
    -(CAST(p_partkey % 8 AS DOUBLE)*1e-1-3e-1) AS z,
  CAST(p_partkey % 13 AS DOUBLE)*1e-2 AS dg, CAST(p_partkey % 12 AS DOUBLE)*1e-2 AS dr,
  CAST(p_partkey % 11 AS DOUBLE)*1e-2 AS di, CAST(p_partkey % 10 AS DOUBLE)*1e-2 AS dz
FROM {part}
UNION ALL
SELECT p_partkey*2+1, CAST((p_partkey*3701) % 36000 AS DOUBLE)*1e-2+3e-4,
  CAST((p_partkey*53) % 1000 AS DOUBLE)*1e-1-80+1e-4,
  14+CAST(p_partkey % 50 AS DOUBLE)*1e-1, 13.5e0+CAST(p_partkey % 50 AS DOUBLE)*1e-1,
  14+CAST(p_partkey % 50 AS DOUBLE)*1e-1, 13.9e0+CAST(p_partkey % 50 AS DOUBLE)*1e-1,
  2e-2, 2e-2, 2e-2, 2e-2
FROM {part} WHERE p_size % 5 = 0
"""

# Observed objects near the stars, with outliers and zero and negative fluxes among them. The sine
# keeps means off the short decimals, where two engines may round a half differently.
OBS = """
SELECT obs_id, agg, ccdnum, CASE WHEN ra0 < 0 THEN ra0+360 ELSE ra0 END AS ra, dec,
  flux, flux*1e-2 AS fluxerr, flux_psf, flags, spread,
  'D00'||lpad(CAST(agg % 1000000 AS STRING), 6, '0')||'_g_'||lpad(CAST(ccdnum AS STRING), 2, '0')
    ||'_r1p1_fullcat.fits' AS filename
FROM (
  SELECT l_orderkey*10+l_linenumber AS obs_id, min(l_suppkey) AS agg, l_linenumber AS ccdnum,
    CAST((min(l_partkey)*3701) % 36000 AS DOUBLE)*1e-2
      + CAST((l_linenumber*3+CAST(min(l_quantity) AS BIGINT)) % 9 - 4 AS DOUBLE)*17e-5 AS ra0,
    CAST((min(l_partkey)*53) % 1000 AS DOUBLE)*1e-1-80
      + CAST((min(l_suppkey)+l_linenumber) % 7 - 3 AS DOUBLE)*13e-5 AS dec,
    CASE WHEN l_orderkey % 53 = 0 THEN 0e0 WHEN l_orderkey % 59 = 0 THEN -1e0
      ELSE power(10e0, -4e-1*(14+CAST(min(l_partkey) % 50 AS DOUBLE)*1e-1 - 31
        + CASE WHEN l_orderkey % 61 = 0 THEN 3e0 WHEN l_orderkey % 67 = 0 THEN 8e-1
               WHEN l_orderkey % 71 = 0 THEN 2e-1 ELSE (min(l_quantity)-25)*2e-3 END
        + sin(CAST(l_orderkey AS DOUBLE))*1e-4)) END AS flux,
    min(l_extendedprice)*1e-3 AS flux_psf, CAST(l_linenumber % 4 AS INT) AS flags,
    (min(l_discount)-5e-2)*25e-2 AS spread
  FROM {lineitem} GROUP BY l_orderkey, l_linenumber
) AS o
"""

EXPOSURE = """
SELECT o_orderkey AS expnum,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST((o_orderkey*137) % 3600 AS DOUBLE)*1e-1 END AS radeg,
  CAST((o_orderkey*211) % 1800 AS DOUBLE)*1e-1-90 AS decdeg,
  CAST((o_orderkey*31) % 1800 AS DOUBLE)*1e-1-90 AS glat, CAST((o_custkey*7) % 120 AS DOUBLE)*1e-1 AS exptime,
  1+CAST(o_custkey % 10 AS DOUBLE)*1e-1 AS airmass,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'g' WHEN '2-HIGH' THEN 'r' WHEN '3-MEDIUM' THEN 'i'
    WHEN '4-NOT SPECIFIED' THEN 'z' ELSE 'Y' END AS band,
  '2020'||lpad(CAST(o_orderkey % 366 AS STRING), 4, '0') AS nite,
  58000+CAST(o_orderkey % 1000 AS DOUBLE)*1e-1 AS mjd_obs,
  o_orderstatus||','||o_orderpriority AS field, 'obj,'||CAST(o_custkey AS STRING) AS object,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'prog,'||o_orderstatus||',x' END AS program,
  CAST(o_custkey % 120 AS DOUBLE)*1e-2 AS t_eff, o_totalprice*4e-3 AS astrom_chi2
FROM {orders}
"""

# One catalogue file per order line; names carry band, exposure and chip the way survey files do.
ARCHIVE = """
SELECT a.expnum, a.ccdnum, '/arch/'||CAST(a.expnum % 7 AS STRING) AS path,
  'D00'||lpad(CAST(a.expnum % 1000000 AS STRING), 6, '0')||'_'||e.band||'_'
    ||lpad(CAST(a.ccdnum AS STRING), 2, '0')||'_r1p1_fullcat.fits' AS filename,
  CASE WHEN a.ccdnum = 5 THEN NULL WHEN a.ccdnum = 6 THEN '.fz' ELSE '' END AS compression,
  CASE WHEN a.ccdnum = 7 THEN 'segmap' ELSE 'fullcat' END AS filetype
FROM (SELECT DISTINCT l_orderkey AS expnum, l_linenumber AS ccdnum FROM {lineitem}) AS a
JOIN {exposure} AS e ON a.expnum = e.expnum
"""

# Chip footprints; the last chip of an exposure has no archived file of the right kind.
IMAGE = """
SELECT expnum, ccdnum, band,
  CASE WHEN ra-15e-2 < 0 THEN ra-15e-2+360 ELSE ra-15e-2 END AS rac1, greatest(dec-1e-1, -90e0) AS decc1,
  CASE WHEN ra-15e-2 < 0 THEN ra-15e-2+360 ELSE ra-15e-2 END AS rac2, dec+1e-1 AS decc2,
  ra+15e-2 AS rac3, dec+1e-1 AS decc3, ra+15e-2 AS rac4, greatest(dec-1e-1, -90e0) AS decc4,
  ra AS ra_cent, dec AS dec_cent, ra+15e-2 AS racmax,
  CASE WHEN ra-15e-2 < 0 THEN ra-15e-2+360 ELSE ra-15e-2 END AS racmin,
  CASE WHEN ra-15e-2 < 0 THEN 'Y' ELSE 'N' END AS crossra0
FROM (
  SELECT a.expnum, a.ccdnum, e.band, e.radeg + CAST(a.ccdnum AS DOUBLE)*2e-1 - 8e-1 AS ra, e.decdeg AS dec
  FROM (SELECT DISTINCT l_orderkey AS expnum, l_linenumber AS ccdnum FROM {lineitem}) AS a
  JOIN {exposure} AS e ON a.expnum = e.expnum
) AS f
"""

# A second set for the end-to-end run, where objects must lie on their exposure: the observed sky is
# cut into 12 x 10 degree fields, each an exposure of two chips.
FIELD_OBS = """
SELECT o.obs_id, o.ra, o.dec, o.flux, o.fluxerr, o.flux_psf, o.flags, o.spread, o.expnum, o.ccdnum,
  'D00'||lpad(CAST(o.expnum AS STRING), 6, '0')||'_'||o.band||'_'||lpad(CAST(o.ccdnum AS STRING), 2, '0')
    ||'_r1p1_fullcat.fits' AS filename, o.band
FROM (
  SELECT *, CASE expnum % 5 WHEN 0 THEN 'g' WHEN 1 THEN 'r' WHEN 2 THEN 'i' WHEN 3 THEN 'z' ELSE 'Y' END AS band
  FROM (
    SELECT obs_id, ra, dec, flux, fluxerr, flux_psf, flags, spread,
      CAST(floor((dec+90)/10) AS BIGINT)*30 + CAST(floor(ra/12) AS BIGINT) AS expnum,
      CAST(obs_id % 2 + 1 AS INT) AS ccdnum
    FROM {obs}
  ) AS c
) AS o
"""

FIELD_EXPOSURE = """
SELECT expnum, CAST(expnum % 30 AS DOUBLE)*12+6 AS radeg, CAST((expnum - expnum % 30)/30 AS DOUBLE)*10-85 AS decdeg,
  CAST((expnum*31) % 1800 AS DOUBLE)*1e-1-90 AS glat, CAST((expnum*7) % 120 AS DOUBLE)*1e-1 AS exptime,
  1e0 AS airmass, band, '20200101' AS nite, 58000e0 AS mjd_obs,
  'f,1' AS field, 'o,2' AS object, 'p,3' AS program
FROM (SELECT DISTINCT expnum, band FROM {field_obs}) AS e
"""

FIELD_ARCHIVE = """
SELECT DISTINCT expnum, ccdnum, '/arch/'||CAST(expnum % 7 AS STRING) AS path, filename, '' AS compression,
  'fullcat' AS filetype
FROM {field_obs}
"""

FIELD_IMAGE = """
SELECT a.expnum, a.ccdnum, e.band,
  e.radeg-35e-1 AS rac1, e.decdeg-3 AS decc1, e.radeg-35e-1 AS rac2, e.decdeg+3 AS decc2,
  e.radeg+35e-1 AS rac3, e.decdeg+3 AS decc3, e.radeg+35e-1 AS rac4, e.decdeg-3 AS decc4,
  e.radeg AS ra_cent, e.decdeg AS dec_cent, e.radeg+35e-1 AS racmax, e.radeg-35e-1 AS racmin, 'N' AS crossra0
FROM {field_archive} AS a JOIN {field_exposure} AS e ON a.expnum = e.expnum
"""

TEXTS = {
    "star": STAR, "obs": OBS, "exposure": EXPOSURE, "archive": ARCHIVE, "image": IMAGE, "field_obs": FIELD_OBS,
    "field_exposure": FIELD_EXPOSURE, "field_archive": FIELD_ARCHIVE, "field_image": FIELD_IMAGE,
}
NEEDS = {
    "star": ["part"], "obs": ["lineitem"], "exposure": ["orders"], "archive": ["lineitem", "exposure"],
    "image": ["lineitem", "exposure"], "field_obs": ["obs"], "field_exposure": ["field_obs"],
    "field_archive": ["field_obs"], "field_image": ["field_archive", "field_exposure"],
}


def table(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A derived table, or one of the driver's own; given holds tables already at hand."""
    if given and name in given:
        return given[name]
    if name not in TEXTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(TEXTS[name], **{n: table(spark, sf_dir, n, given) for n in NEEDS[name]})


_stored: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A derived table kept as files for the session, the way a survey has its catalogues on disk; given as in table()."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = materialize(table(spark, sf_dir, name, given), name)
    return _stored[key]


def ctes(*names: str) -> str:
    """The same tables as a comma-separated list of common table expressions, inputs first."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in TEXTS and name not in done:
            for n in NEEDS[name]:
                add(n)
            done[name] = TEXTS[name].format(**{n: n for n in NEEDS[name]})

    for n in names:
        add(n)
    return ",\n".join(f"{n} AS ({t.strip()})" for n, t in done.items())


def object_catalog(objects: DataFrame) -> DataFrame:
    """Derived objects in the form of a per-image catalogue: positions under their long names, flux as
    a vector of twelve apertures whose eighth is the flux itself."""
    aper = lambda c: F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: F.col(c) * (k / F.lit(8.0)))
    return objects.select(
        F.col("filename").alias("FILENAME"), F.col("obs_id").alias("NUMBER"),
        (F.col("obs_id") % 2048).cast("double").alias("X_IMAGE"), (F.col("obs_id") % 4096).cast("double").alias("Y_IMAGE"),
        F.col("ra").alias("ALPHAWIN_J2000"), F.col("dec").alias("DELTAWIN_J2000"),
        F.col("flux_psf").alias("FLUX_PSF"), (F.col("flux_psf") * 1e-2).alias("FLUXERR_PSF"),
        aper("flux").alias("FLUX_APER"), aper("fluxerr").alias("FLUXERR_APER"),
        F.lit(1.0).alias("CLASS_STAR"), F.col("spread").alias("SPREAD_MODEL"),
        F.lit(1e-3).alias("SPREADERR_MODEL"), F.col("flags").alias("FLAGS"))


def star_catalog(stars: DataFrame) -> DataFrame:
    """Derived stars under the reference catalogue's names."""
    return stars.toDF(*[c.upper() for c in stars.columns])


def observed_catalog(obs: DataFrame) -> DataFrame:
    """Derived objects with the columns that matching and zero points read."""
    return obs.select(
        F.col("obs_id").alias("OBS_ID"), F.col("filename").alias("FILENAME"), F.col("agg").alias("AGG"),
        F.col("ra").alias("RA"), F.col("dec").alias("DEC"), F.col("flux").alias("FLUX_APER_08"),
        F.col("fluxerr").alias("FLUXERR_APER_08"), F.col("flux_psf").alias("FLUX_PSF"),
        F.col("flags").alias("FLAGS"), F.col("spread").alias("SPREAD_MODEL"))
