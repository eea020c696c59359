"""The registered queries: each runs an operator over the whole derived sky, next to the plain SQL
that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skycal.functions import names, photometry as phot, sky
from skycal.functions.numeric import round_fractions
from skycal.operators import catalog, histograms, medians, qa, refcat, selection, tiles, zeropoints
from skycal.operators.clipping import flag_outliers, sigma_clip
from skycal.operators.counts import StepCounts
from skycal.operators.crossmatch import crossmatch
from skycal.operators.matchid import match_ids
from skycal.operators.materialize import materialize, shared_folder
from skycal.plans import oracle as sql
from skycal.plans.calibrate import calibrate as calibrate_survey
from skycal.plans.proxy import object_catalog, observed_catalog, star_catalog, stored, table
from skycal.plans.resume import calibrate_changed
from skycal.sources.catalog_store import attach_bucketed, buckets_for, read_unit_catalogs, write_bucketed, write_unit_catalogs
from skycal.sources.headers import read_csv_by_header
from skycal.sources.sinks import fixed_decimals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register


def r6(c: str | Column, name: str | None = None) -> Column:
    return F.round(c, 6).alias(name or c)


# ---- selection -------------------------------------------------------------------------------------

BOX = (30.0, 330.0, -70.35988, 2.705224)
IN_BOX = "radeg >= 30 AND radeg < 330 AND decdeg >= -70.35988e0 AND decdeg < 2.705224e0"
FILEPATHS_SQL = f"""SELECT a.expnum, a.ccdnum, e.band, a.path||'/'||a.filename||a.compression AS filepath
  FROM archive AS a JOIN exposure AS e ON a.expnum = e.expnum
  WHERE {sql.USABLE} AND a.filetype = 'fullcat' AND {IN_BOX}"""
EXPOSURES_SQL = f"""SELECT expnum, radeg AS expra, decdeg AS expdec, exptime, airmass, band, nite, mjd_obs,
  replace(field, ',', ' ') AS field, replace(object, ',', ' ') AS object, replace(program, ',', ' ') AS program
  FROM exposure WHERE {sql.USABLE} AND {IN_BOX}"""
IMAGE_COLUMNS = """i.expnum, i.ccdnum, i.band, i.rac1, i.decc1, i.rac2, i.decc2, i.rac3, i.decc3, i.rac4, i.decc4,
  i.ra_cent, i.dec_cent, i.racmax, i.racmin, i.crossra0"""
IMAGES_SQL = f"""SELECT {IMAGE_COLUMNS} FROM image AS i JOIN exposure AS e ON i.expnum = e.expnum
  WHERE {IN_BOX} AND i.band IN ('g', 'r', 'i', 'z')"""


@query(sql.with_tables(["archive", "exposure"], FILEPATHS_SQL))
def select_filepaths(spark, d):
    return selection.select_filepaths(table(spark, d, "archive"), table(spark, d, "exposure"), BOX)


@query(sql.with_tables(["exposure"], EXPOSURES_SQL))
def select_exposures(spark, d):
    return selection.select_exposures(table(spark, d, "exposure"), BOX)


@query(sql.with_tables(["image", "exposure"], IMAGES_SQL))
def select_images(spark, d):
    return selection.select_images(table(spark, d, "image"), table(spark, d, "exposure"), BOX)


@query(sql.with_tables(["image", "archive"], f"""SELECT {IMAGE_COLUMNS}, p.filepath
  FROM ({IMAGES_SQL}) AS i JOIN ({FILEPATHS_SQL}) AS p ON i.expnum = p.expnum AND i.ccdnum = p.ccdnum"""))
def img_file_merge(spark, d):
    return names.merge_keep_left(select_images(spark, d), select_filepaths(spark, d), ["expnum", "ccdnum"])


@query(sql.with_tables(["image", "archive"], f"""SELECT e.expnum AS "EXPNUM", e.expra AS "EXPRA", e.expdec AS "EXPDEC",
  e.band AS "BAND", e.field AS "FIELD", e.program AS "PROGRAM", i.ccdnum AS "CCDNUM", i.ra_cent AS "RA_CENT",
  p.filepath AS "FILEPATH"
  FROM ({EXPOSURES_SQL}) AS e JOIN ({IMAGES_SQL}) AS i ON e.expnum = i.expnum
  JOIN ({FILEPATHS_SQL}) AS p ON i.expnum = p.expnum AND i.ccdnum = p.ccdnum"""))
def exp_img_file_merge(spark, d):
    merged = selection.with_files(select_exposures(spark, d), table(spark, d, "archive"), table(spark, d, "image"))
    return merged.select("EXPNUM", "EXPRA", "EXPDEC", "BAND", "FIELD", "PROGRAM", "CCDNUM", "RA_CENT", "FILEPATH")


@query(sql.with_tables(["exposure"], f"""SELECT expnum, radeg, decdeg FROM exposure WHERE {sql.USABLE}
  AND radeg > 170 AND radeg < 180.6e0 AND decdeg > -25 AND decdeg < -15"""))
def box_open(spark, d):
    e = selection.usable_exposures(table(spark, d, "exposure"))
    return e.where(tiles.in_box(F.col("radeg"), F.col("decdeg"), (170, 180.6, -25, -15), "open")).select(
        "expnum", "radeg", "decdeg")


@query(sql.with_tables(["archive", "exposure"], f"""SELECT e.*, f.ccdnum, f.path, f.filename, f.compression, f.filetype
  FROM exposure AS e JOIN archive AS f ON e.expnum = f.expnum WHERE {sql.USABLE} AND f.filetype = 'fullcat'
    AND e.radeg > 30 AND e.radeg < 330 AND e.decdeg > -60 AND e.decdeg < 0
  ORDER BY e.expnum, f.ccdnum LIMIT 1000"""))
def exposure_archive_all_columns(spark, d):
    e = selection.usable_exposures(table(spark, d, "exposure"))
    e = e.where(tiles.in_box(F.col("radeg"), F.col("decdeg"), (30, 330, -60, 0), "open")).alias("e")
    f = table(spark, d, "archive").where("filetype = 'fullcat'").alias("f")
    both = e.join(f, F.col("e.expnum") == F.col("f.expnum")).select("e.*", "f.*")
    return qa.top_rows(names.first_of_duplicates(both), ["expnum", "ccdnum"], 1000)


LINSPACE = lambda i, a, b, n: f"({float(a)}e0 + {float(b - a)}e0*({i})/{float(n - 1)}e0)"


@query(sql.with_tables(["exposure"], f"""SELECT e.expnum, e.hpix FROM
  ({sql.pixel_columns('exposure', 64, 'radeg', 'decdeg', 'hpix', 'expnum')}) AS e
  WHERE e.hpix IN (SELECT p FROM ({sql.pixel_columns('grid', 64, 'ra', 'dec', 'p')}))""", [
    ("grid", f"""SELECT {LINSPACE('CAST(floor(k/100e0) AS BIGINT)', 180, 190, 100)} AS ra,
      {LINSPACE('k % 100', -20, -10, 100)} AS dec FROM (SELECT unnest(range(10000)) AS k) AS ks""")]))
def hpix_in_list(spark, d):
    grid = tiles.sky_grid(spark, (180, 190), (-20, -10), 100)
    pixels = sky.add_healpix(grid, 64, "ra", "dec", "hpix").select("hpix").distinct()
    e = sky.add_healpix(table(spark, d, "exposure"), 64, "radeg", "decdeg", "hpix")
    return selection.in_pixels(e, pixels).select("expnum", "hpix")


PATHS_SQL = """SELECT expnum, ccdnum, path||'/'||filename||compression AS filepath FROM archive"""


def _paths(spark, d):
    a = table(spark, d, "archive")
    return a.select("expnum", "ccdnum", names.file_path(F.col("path"), F.col("filename"), F.col("compression"))
                    .alias("filepath"))


@query(sql.with_tables(["archive"], f"""SELECT expnum, ccdnum, substring(filepath, -22, 1) AS band,
  regexp_extract(filepath, '[^/]*$') AS filename,
  regexp_replace(regexp_extract(filepath, '[^/]*$'), '\\.[^.]*$', '') AS stem FROM ({PATHS_SQL}) AS p"""))
def band_from_filename(spark, d):
    base = names.base_name(F.col("filepath"))
    return _paths(spark, d).select("expnum", "ccdnum", names.band_from_path(F.col("filepath")).alias("band"),
                                   base.alias("filename"), names.strip_extension(base).alias("stem"))


@query(sql.with_tables(["archive"], """SELECT filename, TRY_CAST(substring(filename, 4, 6) AS INTEGER) AS expnum,
  count(*) AS n FROM archive GROUP BY ALL"""))
def expnum_from_filename(spark, d):
    a = table(spark, d, "archive").select("filename", names.expnum_from_name(F.col("filename")).alias("expnum"))
    return a.groupBy("filename", "expnum").agg(F.count(F.lit(1)).alias("n"))


# ---- tiles and sky geometry --------------------------------------------------------------------------

@query(sql.with_tables(["exposure"], sql.in_tile("exposure", columns="e.expnum, e.band, CAST(t.tile AS INTEGER) AS tile"),
                       [("tiles", sql.TILES)]))
def tile_assign(spark, d):
    return tiles.assign_tiles(table(spark, d, "exposure"), tiles.survey_tiles(spark)).select("expnum", "band", "tile")


@query(sql.with_tables(["exposure"], f"""SELECT CAST(tile AS INTEGER) AS tile, band, count(*) AS n_exposures,
  round(sum(exptime), 6) AS exptime FROM ({sql.in_tile('exposure')}) AS x GROUP BY tile, band""", [("tiles", sql.TILES)]))
def tile_exposure_count(spark, d):
    placed = tiles.assign_tiles(table(spark, d, "exposure"), tiles.survey_tiles(spark))
    return placed.groupBy("tile", "band").agg(F.count(F.lit(1)).alias("n_exposures"), r6(F.sum("exptime"), "exptime"))


AREA_SQL = lambda ra1, ra2, d1, d2: f"degrees(1e0)*abs({ra1}-{ra2})*(sin(radians({d1}))-sin(radians({d2})))"


@query(sql.with_tables(["exposure"], f"""SELECT CAST(t.tile AS INTEGER) AS tile,
  round({AREA_SQL('t.ramin', 't.ramax', 't.decmax', 't.decmin')}, 6) AS area, count(*) AS n_exposures,
  round(count(*)/({AREA_SQL('t.ramin', 't.ramax', 't.decmax', 't.decmin')}), 6) AS per_sq_deg
  FROM tiles AS t JOIN exposure AS e
    ON e.radeg >= t.ramin AND e.radeg < t.ramax AND e.decdeg >= t.decmin AND e.decdeg < t.decmax
  GROUP BY t.tile, t.ramin, t.ramax, t.decmin, t.decmax""", [("tiles", sql.TILES)]))
def tile_area(spark, d):
    boxes = tiles.survey_tiles(spark)
    area = sky.box_area(F.col("ramin"), F.col("ramax"), F.col("decmax"), F.col("decmin"))
    areas = boxes.select(F.col("index").alias("tile"), area.alias("area"))
    counts = tiles.assign_tiles(table(spark, d, "exposure"), boxes).groupBy("tile").agg(
        F.count(F.lit(1)).alias("n_exposures"))
    return counts.join(areas, "tile").select(
        "tile", r6("area"), "n_exposures", r6(F.col("n_exposures") / F.col("area"), "per_sq_deg"))


@query(sql.with_tables(["exposure"], f"""SELECT round(t.decmin, 6) AS decmin, CAST(t.strip AS INTEGER) AS strip,
  round(t.ramin, 6) AS ramin, round(t.ramax, 6) AS ramax, count(*) AS n_exposures
  FROM made AS t JOIN exposure AS e
    ON e.radeg >= t.ramin AND e.radeg < t.ramax AND e.decdeg >= t.decmin AND e.decdeg < t.decmax
  GROUP BY ALL""", [
    ("tiles", sql.TILES),
    ("bands", """SELECT decmin, decmax, CAST(greatest(1, round(360e0/(radians(5e1)/abs(sin(radians(decmin))
       -sin(radians(decmax)))))) AS BIGINT) AS strips FROM (SELECT DISTINCT decmin, decmax FROM tiles) AS t"""),
    ("made", """SELECT b.decmin, b.decmax, s.i AS strip, s.i*360e0/b.strips AS ramin, (s.i+1)*360e0/b.strips AS ramax
       FROM bands AS b JOIN (SELECT CAST(unnest(range(400)) AS BIGINT) AS i) AS s ON s.i < b.strips""")]))
def equal_area_tiles(spark, d):
    made = tiles.make_tiles(tiles.survey_tiles(spark).select("decmin", "decmax").distinct(), area=50.0)
    key = F.struct("decmin", "strip")
    placed = tiles.assign_tiles(table(spark, d, "exposure"), made.withColumn("index", key))
    counts = placed.groupBy("tile").agg(F.count(F.lit(1)).alias("n_exposures"))
    return counts.select("tile.*", "n_exposures").join(made, ["decmin", "strip"]).select(
        r6("decmin"), "strip", r6("ramin"), r6("ramax"), "n_exposures")


@query(sql.with_tables(["exposure"], """SELECT expnum, round(radians(1e2)/abs(sin(radians(decdeg))
  -sin(radians(least(decdeg+5, 90e0))))+radeg, 6) AS ra_limit FROM exposure WHERE radeg IS NOT NULL"""))
def ra_limit(spark, d):
    e = table(spark, d, "exposure").where(F.col("radeg").isNotNull())
    limit = sky.ra_limit(F.col("radeg"), F.col("decdeg"), F.least(F.col("decdeg") + 5, F.lit(90.0)), F.lit(100.0))
    return e.select("expnum", r6(limit, "ra_limit"))


@query(sql.with_tables(["image"], f"""SELECT hpix, count(*) AS n_points, count(DISTINCT expnum) AS n_exposures FROM
  ({sql.pixel_columns('grid', 64, 'ra', 'dec', 'hpix', 'expnum')}) AS g WHERE hpix IS NOT NULL GROUP BY hpix""", [
    # Corners on both sides of RA 0 are brought to one side before the points between them are made.
    ("sided", """SELECT expnum, decc1, decc3, CASE WHEN rac1 - rac3 > 180 THEN rac1 - 360 ELSE rac1 END AS left1,
      CASE WHEN rac3 - rac1 > 180 THEN rac3 - 360 ELSE rac3 END AS left3 FROM image"""),
    ("grid", """SELECT expnum, left1 + (left3-left1)*floor(k/4e0)/3e0 AS ra, decc1 + (decc3-decc1)*(k % 4)/3e0 AS dec
      FROM sided JOIN (SELECT unnest(range(16)) AS k) AS ks ON TRUE""")]))
def grid_cross(spark, d):
    grid = tiles.footprint_grid(table(spark, d, "image").where(F.col("rac1").isNotNull()),
                                ("rac1", "rac3"), ("decc1", "decc3"), 4)
    return sky.add_healpix(grid, 64, "ra", "dec", "hpix").groupBy("hpix").agg(
        F.count(F.lit(1)).alias("n_points"), F.count_distinct("expnum").alias("n_exposures"))


@query(sql.with_tables(["obs"], f"SELECT obs_id, round({sql.wrap('ra')}, 6) AS ra_wrap FROM obs"))
def ra_wrap(spark, d):
    return table(spark, d, "obs").select("obs_id", r6(sky.ra_wrap(F.col("ra")), "ra_wrap"))


@query(sql.with_tables(["star"], f"SELECT star_id, hpx8 FROM ({sql.pixel_columns('star', 8, 'ra', 'dec', 'hpx8', 'star_id')})"))
def healpix8(spark, d):
    return sky.add_healpix(table(spark, d, "star"), 8, "ra", "dec", "hpx8").select("star_id", "hpx8")


@query(sql.with_tables(["obs"], f"SELECT obs_id, hpix FROM ({sql.pixel_columns('obs', 4096, 'ra', 'dec', 'hpix', 'obs_id')})"))
def healpix4096(spark, d):
    return sky.add_healpix(table(spark, d, "obs"), 4096, "ra", "dec", "hpix").select("obs_id", "hpix")


def _nested_sql(source: str, n: int, keep: str) -> str:
    """NESTED pixels by face and place, their bits put together one by one."""
    bits = n.bit_length() - 1
    woven = " + ".join(f"(((x >> {k}) & 1) << {2 * k}) + (((y >> {k}) & 1) << {2 * k + 1})" for k in range(bits))
    return f"""SELECT {keep}, face*{n * n} + {woven} AS nest FROM (
      SELECT {keep}, CASE WHEN abs(z) > 2e0/3e0 THEN CASE WHEN z > 0 THEN q ELSE q+8 END WHEN jp // {n} = jm // {n} THEN (jp // {n}) % 4 + 4
          WHEN jp // {n} < jm // {n} THEN (jp // {n}) % 4 ELSE (jm // {n}) % 4 + 8 END AS face,
        CASE WHEN abs(z) <= 2e0/3e0 THEN jm % {n} WHEN z > 0 THEN {n - 1} - jm ELSE jp END AS x,
        CASE WHEN abs(z) <= 2e0/3e0 THEN {n - 1} - jp % {n} WHEN z > 0 THEN {n - 1} - jp ELSE jm END AS y
      FROM (SELECT {keep}, z, least(CAST(floor(t) AS BIGINT), 3) AS q,
          CAST(CASE WHEN abs(z) <= 2e0/3e0 THEN floor({n}*(5e-1+t) - {n}*z*75e-2) ELSE least(floor((t-floor(t))*{n}*sqrt(3*(1-abs(z)))), {n - 1}) END AS BIGINT) AS jp,
          CAST(CASE WHEN abs(z) <= 2e0/3e0 THEN floor({n}*(5e-1+t) + {n}*z*75e-2) ELSE least(floor((1-(t-floor(t)))*{n}*sqrt(3*(1-abs(z)))), {n - 1}) END AS BIGINT) AS jm
        FROM (SELECT {keep}, sin(radians(dec)) AS z, {sql.pmod('ra', '360e0')}/90e0 AS t FROM {source}) AS a) AS b) AS c"""


@query(sql.with_tables(["obs"], f"""SELECT obs_id, nest, nest >> 18 AS nest8 FROM ({_nested_sql('obs', 4096, 'obs_id')}) AS n"""))
def healpix_nested(spark, d):
    o = sky.add_healpix_nested(table(spark, d, "obs"), 4096, "ra", "dec", "nest")
    return o.select("obs_id", "nest", sky.nested_parent(F.col("nest"), 4096, 8).alias("nest8"))


def _center_sql(n: int) -> str:
    ncap, npix = 2 * n * (n - 1), 12 * n * n
    return f"""SELECT hpix, round(ra, 6) AS ra, round(degrees(asin(z)), 6) AS dec FROM (
      SELECT hpix,
        CASE WHEN hpix < {ncap} THEN (hpix+1-2*ni*(ni-1)-5e-1)*90/ni
          WHEN hpix < {npix - ncap} THEN ((hpix-{ncap}) % {4 * n} + 1 - 5e-1*(1+(bi+{n}) % 2))*90/{n}
          ELSE (4*si+1-({npix}-hpix-2*si*(si-1))-5e-1)*90/si END AS ra,
        CASE WHEN hpix < {ncap} THEN 1-ni*ni/{3 * n * n}e0 WHEN hpix < {npix - ncap} THEN ({2 * n}-bi)*2/{3 * n}e0
          ELSE si*si/{3 * n * n}e0-1 END AS z
      FROM (SELECT hpix, floor((1+floor(sqrt(1+2*hpix)))/2) AS ni,
          CAST(floor((hpix-{ncap})/{4 * n}e0) AS BIGINT)+{n} AS bi,
          floor((1+floor(sqrt(greatest(2*({npix}-hpix)-1, 0))))/2) AS si
        FROM (SELECT DISTINCT hpix FROM pix) AS p) AS q) AS c"""


@query(sql.with_tables(["obs"], _center_sql(4096), [("pix", sql.pixel_columns("obs", 4096, "ra", "dec", "hpix", "obs_id"))]))
def healpix_center(spark, d):
    pixels = healpix4096(spark, d).select("hpix").distinct()
    return sky.add_healpix_center(pixels, 4096, "hpix", "ra", "dec").select("hpix", r6("ra"), r6("dec"))


# ---- reference catalogue -------------------------------------------------------------------------------

def _images(spark, d):
    """Image rows of the whole sky, as the pruning step gets them."""
    i = selection.select_images(table(spark, d, "image"), table(spark, d, "exposure"))
    return names.upper_columns(i)


POINTS_SQL = """SELECT rac1 AS ra, decc1 AS dec FROM sel UNION ALL SELECT rac2, decc2 FROM sel
  UNION ALL SELECT rac3, decc3 FROM sel UNION ALL SELECT rac4, decc4 FROM sel UNION ALL SELECT ra_cent, dec_cent FROM sel"""
PRUNE_CTES = [
    ("sel", f"""SELECT {IMAGE_COLUMNS} FROM image AS i JOIN exposure AS e ON i.expnum = e.expnum
      WHERE i.band IN ('g', 'r', 'i', 'z')"""),
    ("points", POINTS_SQL),
    ("pixels", f"SELECT DISTINCT hpx8 FROM ({sql.pixel_columns('points', 8, 'ra', 'dec', 'hpx8')}) AS p WHERE hpx8 IS NOT NULL"),
    ("starpix", sql.pixel_columns("star", 8, "ra", "dec", "hpx8")),
]


@query(sql.with_tables(["star", "image"], f"""SELECT star_id, hpx8, round(ra, 6) AS "RA", round(dec, 6) AS "DEC",
  round({sql.wrap('ra')}, 6) AS "RA_WRAP", round(g, 6) AS "G", round(dg, 6) AS "DG"
  FROM starpix WHERE hpx8 IN (SELECT hpx8 FROM pixels)""", PRUNE_CTES))
def refcat_prune(spark, d):
    stars = refcat.prune_reference(star_catalog(table(spark, d, "star")), _images(spark, d))
    return stars.select(F.col("STAR_ID").alias("star_id"), "hpx8", "RA", "DEC", "RA_WRAP", "G", "DG")


@query(sql.with_tables(["star", "image"], """SELECT hpx8 FROM pixels
  WHERE hpx8 NOT IN (SELECT hpx8 FROM starpix)""", PRUNE_CTES))
def missing_pixels(spark, d):
    return refcat.missing_pixels(star_catalog(table(spark, d, "star")), _images(spark, d))


# ---- object catalogues ---------------------------------------------------------------------------------

def _vector_catalog(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(
        F.concat(F.lit("/arch/cat_"), F.col("label").cast("string"), F.lit(".fits")).alias("FILENAME"),
        F.col("vec_id").alias("NUMBER"), *[F.lit(1.0).alias(c) for c in ("X_IMAGE", "Y_IMAGE")],
        (F.col("vec_id") % 360).cast("double").alias("ALPHAWIN_J2000"),
        (F.col("vec_id") % 180 - 90).cast("double").alias("DELTAWIN_J2000"),
        F.get("embedding", F.lit(60)).cast("double").alias("FLUX_PSF"), F.lit(1.0).alias("FLUXERR_PSF"),
        F.col("embedding").cast("array<double>").alias("FLUX_APER"),
        F.reverse("embedding").cast("array<double>").alias("FLUXERR_APER"),
        *[F.lit(1.0).alias(c) for c in ("CLASS_STAR", "SPREAD_MODEL", "SPREADERR_MODEL")], F.lit(0).alias("FLAGS"))


@query("SELECT 'cat_'||CAST(label AS VARCHAR)||'.fits' AS \"FILENAME\", vec_id AS \"NUMBER\", "
       + "CAST(vec_id % 360 AS DOUBLE) AS \"RA\", "
       + "CAST(CASE WHEN vec_id % 360 > 180 THEN vec_id % 360 - 360 ELSE vec_id % 360 END AS DOUBLE) AS \"RA_WRAP\", "
       + ", ".join(f"round(CAST(embedding[{k}] AS DOUBLE), 6) AS \"FLUX_APER_{k:02d}\"" for k in range(1, 13)) + ", "
       + ", ".join(f"round(CAST(list_reverse(embedding)[{k}] AS DOUBLE), 6) AS \"FLUXERR_APER_{k:02d}\""
                   for k in range(1, 13)) + " FROM embeddings")
def flatten_vectors(spark, d):
    flat = catalog.flatten_catalog(_vector_catalog(spark, d))
    aper = [f"{v}_{k:02d}" for v in ("FLUX_APER", "FLUXERR_APER") for k in range(1, 13)]
    return flat.select("FILENAME", "NUMBER", "RA", "RA_WRAP", *[r6(c) for c in aper])


@query(sql.with_tables(["obs"], """SELECT obs_id, filename, CASE WHEN flags < 2 THEN round(spread, 6) END AS spread,
  flags, CASE WHEN flags >= 2 THEN round(flux_psf, 6) END AS flux_psf FROM obs"""))
def stack_catalogs(spark, d):
    o = table(spark, d, "obs")
    clean = o.where("flags < 2").select("obs_id", "filename", "flags", r6("spread"))
    flagged = o.where("flags >= 2").select("flags", "obs_id", "filename", r6("flux_psf"))
    return catalog.stack_catalogs([clean, flagged]).select("obs_id", "filename", "spread", "flags", "flux_psf")


FIELD_SELECTION = [
    ("tiles", sql.TILES),
    ("located", sql.in_tile("field_exposure")),
    ("exps", f"SELECT * FROM located WHERE {sql.USABLE}"),
    ("images", """SELECT e.expnum, e.tile, e.band, i.ccdnum, i.rac1, i.decc1, i.rac2, i.decc2, i.rac3, i.decc3,
      i.rac4, i.decc4, i.ra_cent, i.dec_cent, a.filename
      FROM exps AS e JOIN field_image AS i ON e.expnum = i.expnum
      JOIN field_archive AS a ON a.expnum = i.expnum AND a.ccdnum = i.ccdnum
      WHERE i.band IN ('g', 'r', 'i', 'z') AND a.filetype = 'fullcat'"""),
]
FIELD_TABLES = ["field_obs", "field_exposure", "field_archive", "field_image"]


def _field(spark, d):
    """The derived field objects and the metadata tables over them, each made once: a survey has them as tables."""
    given: dict[str, DataFrame] = {}
    for t in ("obs", "exposure", "archive", "image"):
        given[f"field_{t}"] = stored(spark, d, f"field_{t}", given)
    return given["field_obs"], [given[f"field_{t}"] for t in ("exposure", "archive", "image")]


def _field_images(spark, d):
    objects, metadata = _field(spark, d)
    return objects, selection.select_survey_images(*metadata, tiles.survey_tiles(spark))


@query(sql.with_tables(FIELD_TABLES, """SELECT o.filename AS "FILENAME", o.obs_id AS "NUMBER", i.expnum AS "EXPNUM",
  CAST(i.tile AS INTEGER) AS "TILE", i.band AS "BAND", round(o.flux_psf, 6) AS "FLUX_PSF"
  FROM field_obs AS o JOIN images AS i ON o.filename = i.filename WHERE i.band = 'r'""", FIELD_SELECTION))
def attach_metadata(spark, d):
    objects, images = _field_images(spark, d)
    joined = catalog.attach_metadata(catalog.flatten_catalog(object_catalog(objects)), images, band="r")
    return joined.select("FILENAME", "NUMBER", "EXPNUM", "TILE", "BAND", r6("FLUX_PSF"))


@query(sql.with_tables(FIELD_TABLES, """SELECT DISTINCT filename AS "FILENAME" FROM images
  WHERE filename NOT IN (SELECT filename FROM obs)""", FIELD_SELECTION))
def missing_catalogs(spark, d):
    # The other derived sky's catalogues: few of the field images' files are among them.
    _, images = _field_images(spark, d)
    return catalog.missing_catalogs(object_catalog(table(spark, d, "obs")), images)


def _scratch(spark, label: str) -> str:
    """A new folder where the cluster shares files."""
    return f"{shared_folder(spark).rstrip('/')}/skycal-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


# Three kinds of files: other orders, and columns that two of them lack.
HEADERS = [["expnum", "band", "radeg", "decdeg", "exptime"], ["field", "decdeg", "expnum", "radeg", "nite"],
           ["nite", "object", "field", "expnum", "band", "program"]]
HEADER_COLUMNS = ["expnum", "band", "radeg", "decdeg", "exptime", "nite", "field", "object", "program"]


@query(sql.with_tables(["exposure"], "SELECT " + ", ".join(
    c if c == "expnum" else "CASE WHEN " + " OR ".join(f"expnum % 3 = {k}" for k, h in enumerate(HEADERS) if c in h) + f" THEN {c} END AS {c}"
    for c in HEADER_COLUMNS) + " FROM exposure"))
def csv_union_by_header(spark, d):
    """Exposures kept as CSV files of three different headers, read back as one table by column name."""
    e, folder = materialize(table(spark, d, "exposure").select(*HEADER_COLUMNS), "exposure"), _scratch(spark, "headers")
    for k, header in enumerate(HEADERS):
        e.where(F.col("expnum") % 3 == k).select(*header).write.option("header", True).option("escape", '"').csv(f"{folder}/{k}")
    return read_csv_by_header(spark, folder, e.schema)


@query(sql.with_tables(FIELD_TABLES, """SELECT o.filename AS "FILENAME", o.obs_id AS "NUMBER", i.expnum AS "EXPNUM",
  CAST(i.tile AS INTEGER) AS "TILE", i.band AS "BAND", round(o.flux_psf, 6) AS "FLUX_PSF"
  FROM field_obs AS o JOIN images AS i ON o.filename = i.filename WHERE i.band IN ('r', 'z') AND i.expnum % 4 < 2""", FIELD_SELECTION))
def listed_catalog_scan(spark, d):
    """Objects stored by band and tile; the scan is driven by a list of images and opens their units only."""
    objects, images = _field_images(spark, d)
    images, folder = materialize(images, "images"), _scratch(spark, "units")
    write_unit_catalogs(catalog.flatten_catalog(object_catalog(objects)), images, folder)
    found = read_unit_catalogs(spark, folder, images.where("BAND IN ('r', 'z') AND EXPNUM % 4 < 2"))
    return found.select("FILENAME", "NUMBER", "EXPNUM", "TILE", "BAND", r6("FLUX_PSF"))


@query(sql.with_tables(FIELD_TABLES, """SELECT o.filename AS "FILENAME", o.obs_id AS "NUMBER", i.expnum AS "EXPNUM",
  CAST(i.tile AS INTEGER) AS "TILE", i.band AS "BAND", round(o.ra, 6) AS "RA"
  FROM field_obs AS o JOIN images AS i ON o.filename = i.filename""", FIELD_SELECTION))
def attach_metadata_bucketed(spark, d):
    """Objects stored in buckets of their file names: the join with the images does not move them."""
    objects, images = _field_images(spark, d)
    name = f"objects_{uuid.uuid4().hex}"
    flat = catalog.flatten_catalog(object_catalog(objects))
    write_bucketed(flat, name, _scratch(spark, "buckets"), buckets_for(flat, least=16))
    return attach_bucketed(spark, name, images).select("FILENAME", "NUMBER", "EXPNUM", "TILE", "BAND", r6("RA"))


# ---- cross-match ---------------------------------------------------------------------------------------

def _stars(spark, d):
    return round_fractions(star_catalog(stored(spark, d, "star")), 6)


def _matched(spark, d, pick="first"):
    return crossmatch(_stars(spark, d), observed_catalog(stored(spark, d, "obs")), pick=pick, tie_break=["STAR_ID"])


MATCH_COLUMNS = """SELECT obs_id AS "OBS_ID_2", star_id AS "STAR_ID_1", round(ra_1, 6) AS "RA_1",
  round(g, 6) AS "G_1", round(ra, 6) AS "RA_2" FROM matched"""


def _match_columns(m):
    return m.select("OBS_ID_2", "STAR_ID_1", r6("RA_1"), r6("G_1"), r6("RA_2"))


@query(sql.with_tables(["star", "obs"], MATCH_COLUMNS, sql.match()))
def xmatch_first(spark, d):
    return _match_columns(_matched(spark, d))


@query(sql.with_tables(["star", "obs"], MATCH_COLUMNS, sql.match("d2, ra_wrap_1, dec_1, star_id")))
def xmatch_nearest(spark, d):
    return _match_columns(_matched(spark, d, "nearest"))


@query(sql.with_tables(["star", "obs"], f"""SELECT m.obs_id AS "OBS_ID_2", m.star_id AS "STAR_ID_1",
  round(sqrt({sql.sep_sq('m.ra', 'm.dec', 'm.ra_1', 'm.dec_1')})*3600, 6) AS sep_arcsec FROM matched AS m""", sql.match()))
def sep_sq(spark, d):
    sep = F.sqrt(sky.sep_sq(F.col("RA_2"), F.col("DEC_2"), F.col("RA_1"), F.col("DEC_1"))) * 3600
    return _matched(spark, d).select("OBS_ID_2", "STAR_ID_1", r6(sep, "sep_arcsec"))


@query(sql.with_tables(["star", "obs"], f"""SELECT row_number() OVER (ORDER BY ra_wrap_1, dec_1, star_id,
  {sql.wrap('ra')}, dec, obs_id) AS "MATCHID", star_id AS "STAR_ID_1", obs_id AS "OBS_ID_2" FROM matched""", sql.match()))
def match_id(spark, d):
    m = _matched(spark, d).withColumn("RA_WRAP_1", sky.ra_wrap(F.col("RA_1"))).withColumn(
        "RA_WRAP_2", sky.ra_wrap(F.col("RA_2")))
    m = m.select("STAR_ID_1", "RA_WRAP_1", "DEC_1", "OBS_ID_2", "RA_WRAP_2", "DEC_2")
    return match_ids(m, ["RA_WRAP_1", "DEC_1", "STAR_ID_1"], ["RA_WRAP_2", "DEC_2", "OBS_ID_2"]).select(
        "MATCHID", "STAR_ID_1", "OBS_ID_2")


# ---- magnitudes and clipping ---------------------------------------------------------------------------

def _color_query(band: str) -> None:
    @query(sql.with_tables(["star", "obs"], """SELECT obs_id AS "OBS_ID_2", star_id AS "STAR_ID_1",
      round(mag_std, 6) AS "MAG_STD", round(magerr_std, 6) AS "MAGERR_STD" FROM mags""",
                           [*sql.match(), ("mags", sql.magnitudes("matched", band))]), name=f"color_{band.lower()}")
    def run(spark, d):
        m = zeropoints.magnitudes(_matched(spark, d), F.lit(phot.check_band(band)))
        return m.select("OBS_ID_2", "STAR_ID_1", r6("MAG_STD"), r6("MAGERR_STD"))


for _band in phot.TRANSFORMS:
    _color_query(_band)

MAGS_G = [*sql.match(), ("mags", sql.magnitudes("matched", "g"))]


def _mags(spark, d):
    return zeropoints.magnitudes(_matched(spark, d), F.lit("g"))


def _quality(spark, d):
    q = zeropoints.quality_cut(_mags(spark, d))
    return materialize(q.select("OBS_ID_2", "AGG_2", "FILENAME_2", "MAG_STD", "MAG_OBS", "MAG_DIFF", "FLUX_PSF_2"), "quality")


def _near(spark, d):
    return zeropoints.median_window(_quality(spark, d), [])


@query(sql.with_tables(["star", "obs"], """SELECT obs_id AS "OBS_ID_2",
  CASE WHEN flux > 0 THEN round(mag_obs, 6) ELSE mag_obs END AS "MAG_OBS",
  CASE WHEN flux > 0 THEN round(mag_diff, 6) ELSE mag_diff END AS "MAG_DIFF" FROM mags""", MAGS_G))
def inst_mag(spark, d):
    # Infinite magnitudes (zero flux) are compared as they are.
    finite = lambda c: F.when(F.col("FLUX_APER_08_2") > 0, F.round(c, 6)).otherwise(F.col(c)).alias(c)
    return _mags(spark, d).select("OBS_ID_2", finite("MAG_OBS"), finite("MAG_DIFF"))


@query(sql.with_tables(["star", "obs"], """SELECT obs_id AS "OBS_ID_2", round(mag_std, 6) AS "MAG_STD" FROM quality""",
                       [*MAGS_G, ("quality", sql.QUALITY)]))
def quality_cut(spark, d):
    return zeropoints.quality_cut(_mags(spark, d)).select("OBS_ID_2", r6("MAG_STD"))


@query(sql.with_tables(["star", "obs"], """SELECT round(quantile_cont(mag_diff, 0.5), 6) AS median_diff,
  (SELECT count(*) FROM near) AS n_near FROM quality""", [*MAGS_G, *sql.clip_ctes("agg", passes=0)]))
def global_median(spark, d):
    q = _quality(spark, d)
    med = medians.median_of_large_groups(q, [], "MAG_DIFF", name="median_diff")
    near = zeropoints.median_window(q, []).agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return med.select(r6("median_diff"), near.alias("n_near"))


@query(sql.with_tables(["obs"], """SELECT flags, round(quantile_cont(flux_psf, 0.5), 6) AS flux_psf_median,
  round(quantile_cont(ra, 0.5), 5) AS ra_median FROM obs GROUP BY flags"""))
def large_group_medians(spark, d):
    o = materialize(table(spark, d, "obs").select("flags", "flux_psf", "ra"), "obs")
    # Every group is treated as too large for one task.
    med = medians.grouped_medians(o, ["flags"], ["flux_psf", "ra"], "_median", hot_rows=0)
    return med.select("flags", r6("flux_psf_median"), F.round("ra_median", 5).alias("ra_median"))


@query(sql.with_tables(["star", "obs"], """SELECT obs_id AS "OBS_ID_2", agg AS "AGG_2", outlier AS "Outlier" FROM clip1""",
                       [*MAGS_G, *sql.clip_ctes("agg", passes=1)]))
def outlier_flag(spark, d):
    return flag_outliers(_near(spark, d), ["AGG_2"], "MAG_DIFF").select("OBS_ID_2", "AGG_2", "Outlier")


@query(sql.with_tables(["star", "obs"], """SELECT obs_id AS "OBS_ID_2", agg AS "AGG_2", outlier AS "Outlier" FROM clip3""",
                       [*MAGS_G, *sql.clip_ctes("agg")]))
def clip3(spark, d):
    return sigma_clip(_near(spark, d), ["AGG_2"], "MAG_DIFF").select("OBS_ID_2", "AGG_2", "Outlier")


@query(sql.with_tables(["star", "obs"], """SELECT obs_id AS "OBS_ID_2", agg AS "AGG_2" FROM clip3 WHERE NOT outlier""",
                       [*MAGS_G, *sql.clip_ctes("agg", nsigma="2e0")]))
def clip_2sigma(spark, d):
    return sigma_clip(_near(spark, d), ["AGG_2"], "MAG_DIFF", nsigma=2.0, apply_last=True).select("OBS_ID_2", "AGG_2")


@query(sql.with_tables(["star", "obs"], """SELECT obs_id AS "OBS_ID_2", agg AS "AGG_2", outlier AS "Outlier" FROM clip3""",
                       [*MAGS_G, *sql.clip_ctes("agg")]))
def clip3_hot_groups(spark, d):
    """The same clip by aggregate and join, the way groups too large for one task take it."""
    near = materialize(_near(spark, d), "near")
    groups = near.select("AGG_2").distinct().count()
    return sigma_clip(near, ["AGG_2"], "MAG_DIFF", hot_groups=groups).select("OBS_ID_2", "AGG_2", "Outlier")


# ---- zero points ---------------------------------------------------------------------------------------

ZP = ["MAG_ZERO_MEDIAN", "MAG_ZERO_MEAN", "MAG_ZERO_STD", "MAG_ZERO_MEAN_ERR"]
ZP_OUT = """filename AS "FILENAME_2", round(mag_zero_median, 6) AS "MAG_ZERO_MEDIAN",
  round(mag_zero_mean, 6) AS "MAG_ZERO_MEAN", round(mag_zero_std, 6) AS "MAG_ZERO_STD",
  round(mag_zero_mean_err, 6) AS "MAG_ZERO_MEAN_ERR", mag_zero_num AS "MAG_ZERO_NUM" """


def _zp(spark, d, all_medians=False):
    matched = _matched(spark, d)
    if all_medians:
        matched = matched.withColumns({f"RA_WRAP_{k}": sky.ra_wrap(F.col(f"RA_{k}")) for k in (1, 2)})
        matched = match_ids(matched, ["RA_WRAP_1", "DEC_1", "STAR_ID_1"], ["RA_WRAP_2", "DEC_2", "OBS_ID_2"])
    return zeropoints.zero_points(matched, "g", all_medians=all_medians)


def _zp_columns(zp, *more):
    return zp.select("FILENAME_2", *[r6(c) for c in ZP], "MAG_ZERO_NUM", *more)


def _zp_query(body: str, tables=("star", "obs"), extra=()):
    return query(sql.with_tables(list(tables), body, [*sql.zp_ctes(), *extra]))


@_zp_query(f"SELECT {ZP_OUT} FROM zp")
def zero_points(spark, d):
    return _zp_columns(_zp(spark, d))


MEDIANS = {
    "MATCHID": "matchid",
    "STAR_ID_1": "star_id", "RA_1": "ra_1", "DEC_1": "dec_1", "G_1": "g", "R_1": "r", "I_1": "i", "Z_1": "z",
    "DG_1": "dg", "DR_1": "dr", "DI_1": "di", "DZ_1": "dz", "OBS_ID_2": "obs_id", "AGG_2": "agg", "RA_2": "ra",
    "DEC_2": "dec", "FLUX_APER_08_2": "flux", "FLUXERR_APER_08_2": "fluxerr", "FLUX_PSF_2": "flux_psf",
    "FLAGS_2": "flags", "SPREAD_MODEL_2": "spread", "MAG_STD": "mag_std", "MAGERR_STD": "magerr_std",
    "MAG_OBS": "mag_obs", "MAG_DIFF": "mag_diff",
}


@_zp_query('SELECT filename AS "FILENAME_2", count(mag_diff) AS "MAG_ZERO_NUM", ' + ", ".join(
    f'round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS "{n}_MEDIAN"' for n, c in MEDIANS.items())
    + " FROM clip3 GROUP BY filename")
def zp_all_medians(spark, d):
    zp = _zp(spark, d, all_medians=True)
    return zp.select("FILENAME_2", "MAG_ZERO_NUM", *[r6(f"{n}_MEDIAN") for n in MEDIANS])


# ---- quality reports -----------------------------------------------------------------------------------

def _qa_zp(spark, d):
    return materialize(_zp(spark, d), "zero-points")


def _exposures(spark, d):
    return names.upper_columns(table(spark, d, "exposure").select("expnum", "band", "t_eff", "astrom_chi2"))


@_zp_query(f"SELECT {ZP_OUT} FROM zp WHERE mag_zero_num < 30")
def zp_low_count(spark, d):
    return _zp_columns(qa.low_count(_zp(spark, d), below=qa.FEW))


@_zp_query(f"SELECT {ZP_OUT} FROM zp WHERE mag_zero_num < 5")
def zp_very_low_count(spark, d):
    return _zp_columns(qa.low_count(_zp(spark, d), below=5))


@_zp_query("""SELECT filename AS "FILENAME_2", ra_median AS "RA_1_MEDIAN", n AS "MAG_ZERO_NUM" FROM (
  SELECT filename, round(quantile_cont(ra_1, 0.5), 4) AS ra_median, quantile_cont(ra_1, 0.5) AS m,
    count(mag_diff) AS n FROM clip3 GROUP BY filename) AS x WHERE n < 30 AND m > 100""")
def zp_low_count_region(spark, d):
    bad = qa.low_count(_zp(spark, d, all_medians=True), below=qa.FEW, ra_above=100.0)
    return bad.select("FILENAME_2", F.round("RA_1_MEDIAN", 4).alias("RA_1_MEDIAN"), "MAG_ZERO_NUM")


CLASS_SQL = """CASE WHEN mag_zero_num > 55 AND mag_zero_mean_err < 1e-2 THEN 'c1'
  WHEN mag_zero_num < 55 AND mag_zero_num > 30 AND mag_zero_mean_err < 1e-2 THEN 'c2'
  WHEN mag_zero_num > 30 AND mag_zero_mean_err > 1e-2 THEN 'c3' WHEN mag_zero_num < 30 THEN 'c4' END"""
CLASSED = [("classed", f"SELECT *, {CLASS_SQL} AS cls FROM zp WHERE mag_zero_std IS NOT NULL AND mag_zero_mean_err IS NOT NULL")]


@_zp_query('SELECT filename AS "FILENAME_2", mag_zero_num AS "MAG_ZERO_NUM", cls AS "ZP_CLASS" FROM classed', extra=CLASSED)
def zp_classes(spark, d):
    return qa.zp_classes(_zp(spark, d)).select("FILENAME_2", "MAG_ZERO_NUM", "ZP_CLASS")


@_zp_query("""SELECT cls AS "ZP_CLASS", count(*) AS n, round(count(*)/CAST((SELECT count(*) FROM classed) AS DOUBLE), 6) AS share
  FROM classed GROUP BY cls""", extra=CLASSED)
def zp_class_counts(spark, d):
    return qa.class_counts(qa.zp_classes(_qa_zp(spark, d)), "ZP_CLASS").select("ZP_CLASS", "n", r6("share"))


@_zp_query("""SELECT count(mag_zero_mean_err) AS n, round(min(mag_zero_mean_err), 4) AS err_min,
  round(avg(mag_zero_mean_err), 4) AS err_mean, round(stddev_pop(mag_zero_mean_err), 4) AS err_std,
  round(quantile_cont(mag_zero_mean_err, 0.5), 4) AS err_median FROM zp""")
def zp_err_stats(spark, d):
    return qa.err_stats(_qa_zp(spark, d))


EDGE = "power(10e0, -3e0+(3e0/49)*({}))"


@_zp_query(f"""SELECT CAST(b.k AS INTEGER) AS bin, round({EDGE.format('b.k')}, 6) AS lo, round({EDGE.format('b.k+1')}, 6) AS hi,
  count(z.filename) AS n FROM (SELECT unnest(range(49)) AS k) AS b LEFT JOIN zp AS z
    ON z.mag_zero_mean_err >= {EDGE.format('b.k')} AND (z.mag_zero_mean_err < {EDGE.format('b.k+1')}
      OR (b.k = 48 AND z.mag_zero_mean_err = {EDGE.format('b.k+1')}))
  GROUP BY b.k""")
def hist_log(spark, d):
    return histograms.histogram_log(_qa_zp(spark, d), "MAG_ZERO_MEAN_ERR").select("bin", r6("lo"), r6("hi"), "n")


@_zp_query("""SELECT CAST(b.k AS INTEGER) AS bin, b.k*2e0 AS lo, b.k*2e0+2 AS hi, count(z.filename) AS n
  FROM (SELECT unnest(range(50)) AS k) AS b LEFT JOIN zp AS z ON z.mag_zero_num >= b.k*2
    AND (z.mag_zero_num < b.k*2+2 OR (b.k = 49 AND z.mag_zero_num = 100)) GROUP BY b.k""")
def hist_linear(spark, d):
    return histograms.histogram_linear(_qa_zp(spark, d), "MAG_ZERO_NUM").select("bin", "lo", "hi", "n")


def _auto_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS quantity, CAST(b.k AS INTEGER) AS bin, round(m.lo+(m.hi-m.lo)/10*b.k, 6) AS lo,
      round(m.lo+(m.hi-m.lo)/10*(b.k+1), 6) AS hi, coalesce(c.n, 0) AS n
      FROM (SELECT unnest(range(10)) AS k) AS b
      JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) AS m ON TRUE
      LEFT JOIN (SELECT least(CAST(floor(({column}-lo)/(hi-lo)*10) AS BIGINT), 9) AS k, count(*) AS n
        FROM {source} AS s JOIN (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) AS r ON TRUE
        GROUP BY 1) AS c ON c.k = b.k"""


def _auto_both_sql(source: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({_auto_sql(c, source)}) AS {c}_bins" for c in ("t_eff", "astrom_chi2"))


def _auto_both(df):
    one = lambda c: histograms.histogram_auto(df, c).select(F.lit(c).alias("quantity"), "bin", r6("lo"), r6("hi"), "n")
    return one("t_eff").union(one("astrom_chi2"))


@query(sql.with_tables(["exposure"], _auto_both_sql("exposure")))
def hist_auto(spark, d):
    return _auto_both(table(spark, d, "exposure"))


BAD = [("bad", "SELECT DISTINCT expnum FROM zpx WHERE mag_zero_num < 30"),
       ("flagged", "SELECT * FROM exposure WHERE expnum IN (SELECT expnum FROM bad)")]


@query(sql.with_tables(["star", "obs", "exposure"], _auto_both_sql("flagged"), [*sql.zp_ctes(), *BAD]))
def hist_auto_flagged(spark, d):
    return _auto_both(qa.flagged_exposures(_exposures(spark, d), qa.low_count(_qa_zp(spark, d), qa.FEW)))


@_zp_query("""SELECT e.expnum AS "EXPNUM", e.band AS "BAND", e.expnum IN (SELECT expnum FROM bad) AS "FLAGGED"
  FROM exposure AS e""", ("star", "obs", "exposure"), BAD)
def flag_exposures(spark, d):
    bad = qa.low_count(_zp(spark, d), qa.FEW)
    return qa.flag_exposures(_exposures(spark, d), bad).select("EXPNUM", "BAND", "FLAGGED")


@_zp_query("""SELECT z.filename AS "FILENAME_2", z.expnum AS "EXPNUM", round(e.t_eff, 6) AS "T_EFF",
  round(e.astrom_chi2, 6) AS "ASTROM_CHI2" FROM zpx AS z JOIN exposure AS e ON z.expnum = e.expnum""",
           ("star", "obs", "exposure"))
def zp_exposure_lookup(spark, d):
    return qa.exposure_lookup(_zp(spark, d), _exposures(spark, d)).select(
        "FILENAME_2", "EXPNUM", r6("T_EFF"), r6("ASTROM_CHI2"))


CHI2 = [("chi2", """SELECT z.filename, z.mag_zero_num,
    CASE WHEN astrom_chi2 > 1000 THEN 'bad_astrometry' WHEN astrom_chi2 < 1000 AND mag_zero_mean_err > 1e-1
      THEN 'large_error' ELSE 'rest' END AS cls,
    CASE WHEN astrom_chi2 < 200 AND mag_zero_mean_err < 1e-1 THEN 'low_chi2_small_error'
      WHEN astrom_chi2 < 200 AND mag_zero_mean_err > 1e-1 THEN 'low_chi2_large_error'
      WHEN astrom_chi2 > 200 THEN 'high_chi2' END AS band
  FROM zpx AS z JOIN exposure AS e ON z.expnum = e.expnum""")]


@_zp_query('SELECT filename AS "FILENAME_2", cls AS "CHI2_CLASS", band AS "CHI2_BAND" FROM chi2', ("star", "obs", "exposure"), CHI2)
def chi2_classes(spark, d):
    return qa.chi2_classes(_zp(spark, d), _exposures(spark, d)).select("FILENAME_2", "CHI2_CLASS", "CHI2_BAND")


@_zp_query("""SELECT cls AS "CHI2_CLASS", count(*) AS n,
  round(count(*)/CAST((SELECT count(*) FROM chi2) AS DOUBLE), 6) AS share FROM chi2 GROUP BY cls""",
           ("star", "obs", "exposure"), CHI2)
def chi2_class_counts(spark, d):
    c = materialize(qa.chi2_classes(_zp(spark, d), _exposures(spark, d)).select("CHI2_CLASS"), "chi2")
    return qa.class_counts(c, "CHI2_CLASS").select("CHI2_CLASS", "n", r6("share"))


CHI2_BANDS = ("low_chi2_small_error", "low_chi2_large_error", "high_chi2")


@_zp_query("""SELECT p.band AS population, CAST(b.k AS INTEGER) AS bin, b.k*2e0 AS lo, b.k*2e0+2 AS hi, count(z.filename) AS n
  FROM (SELECT unnest(range(50)) AS k) AS b
  JOIN (VALUES ('low_chi2_small_error'), ('low_chi2_large_error'), ('high_chi2')) AS p(band) ON TRUE
  LEFT JOIN chi2 AS z ON z.band = p.band AND z.mag_zero_num >= b.k*2
    AND (z.mag_zero_num < b.k*2+2 OR (b.k = 49 AND z.mag_zero_num = 100)) GROUP BY p.band, b.k""",
           ("star", "obs", "exposure"), CHI2)
def chi2_count_histogram(spark, d):
    c = materialize(qa.chi2_classes(_zp(spark, d), _exposures(spark, d)).select("CHI2_BAND", "MAG_ZERO_NUM"), "chi2")
    one = lambda p: histograms.histogram_linear(c.where(F.col("CHI2_BAND") == p), "MAG_ZERO_NUM").select(
        F.lit(p).alias("population"), "bin", "lo", "hi", "n")
    return reduce(DataFrame.union, map(one, CHI2_BANDS))


@_zp_query("""SELECT count(*) AS n_zero_points, count(DISTINCT expnum) AS n_exposures FROM zpx WHERE mag_zero_num < 30""")
def distinct_bad_exposures(spark, d):
    return qa.distinct_exposures(qa.low_count(_zp(spark, d), qa.FEW))


@_zp_query("""SELECT round(avg(CASE WHEN mag_zero_mean_err < 1e-2 THEN 1e0 ELSE 0e0 END), 6) AS share FROM zp""")
def good_share(spark, d):
    return qa.share(_zp(spark, d), F.col("MAG_ZERO_MEAN_ERR") < qa.GOOD_ERR).select(r6("share"))


@query(sql.with_tables(["archive", "exposure"], f"""SELECT * FROM ({FILEPATHS_SQL}) AS p
  ORDER BY expnum, ccdnum LIMIT 1000"""))
def top_rows(spark, d):
    return qa.top_rows(select_filepaths(spark, d), ["expnum", "ccdnum"], 1000)


@query(sql.with_tables(["archive", "exposure"], f"""SELECT * FROM ({FILEPATHS_SQL}) AS p
  ORDER BY expnum, ccdnum LIMIT 1 OFFSET 2"""))
def row_by_position(spark, d):
    return qa.top_rows(select_filepaths(spark, d), ["expnum", "ccdnum"], 1, skip=2)


@_zp_query("""SELECT filename AS "FILENAME_2", printf('%.4f', mag_zero_mean) AS "MAG_ZERO_MEAN",
  printf('%.4f', mag_zero_mean_err) AS "MAG_ZERO_MEAN_ERR", mag_zero_num AS "MAG_ZERO_NUM" FROM zp""")
def rounded_sink(spark, d):
    zp = _zp(spark, d).select("FILENAME_2", "MAG_ZERO_MEAN", "MAG_ZERO_MEAN_ERR", "MAG_ZERO_NUM")
    return fixed_decimals(zp, 4)


@query(sql.with_tables(["obs"], """SELECT obs_id, printf('%.4f', (obs_id % 20011 - 10005)/32e0) AS ties, printf('%.6f', ra) AS ra,
  printf('%.2f', (obs_id % 4001)*5e-3) AS near_ties, CAST(printf('%.2f', flux_psf) AS DOUBLE) AS flux_psf FROM obs"""))
def exact_decimals(spark, d):
    """Halves that a double holds exactly, halves that it only seems to hold, and ordinary values, as text and read back."""
    o = table(spark, d, "obs")
    df = o.select("obs_id", ((F.col("obs_id") % 20011 - 10005) / F.lit(32.0)).alias("ties"), "ra",
                  ((F.col("obs_id") % 4001) * F.lit(5e-3)).alias("near_ties"), "flux_psf")
    text = fixed_decimals(df.select("obs_id", "ties"), 4).join(fixed_decimals(df.select("obs_id", "ra"), 6), "obs_id")
    return text.join(fixed_decimals(df.select("obs_id", "near_ties"), 2), "obs_id").join(
        round_fractions(df.select("obs_id", "flux_psf"), 2, exact=True), "obs_id")


# ---- the whole calibration -----------------------------------------------------------------------------

FIELD_POINTS = POINTS_SQL.replace("FROM sel", "FROM images")
FIELD_CTES = [
    *FIELD_SELECTION,
    ("points", FIELD_POINTS),
    ("pixels", f"SELECT DISTINCT hpx8 FROM ({sql.pixel_columns('points', 8, 'ra', 'dec', 'hpx8')}) AS p"),
    ("starpix", sql.pixel_columns("star", 8, "ra", "dec", "hpx8")),
    ("observed", """SELECT o.obs_id, o.ra, o.dec, o.flux, o.fluxerr, o.flux_psf, o.flags, o.spread, o.filename,
      i.tile, i.band, i.ra_cent, i.dec_cent FROM field_obs AS o JOIN images AS i ON o.filename = i.filename"""),
    *sql.match(obs="observed", stars=sql.STARS6.replace(
        "FROM star", "FROM (SELECT * FROM starpix WHERE hpx8 IN (SELECT hpx8 FROM pixels)) AS kept")),
    ("mags", " UNION ALL ".join(
        f"SELECT * FROM ({sql.magnitudes(f'(SELECT * FROM matched WHERE band = {chr(39)}{b}{chr(39)})', b)})" for b in "griz")),
    *sql.clip_ctes("filename", per="tile, band"),
]


def _field_ctes(stars: str) -> list[tuple[str, str]]:
    at = [n for n, _ in FIELD_CTES].index("observed") + 1
    return [*FIELD_CTES[:at], *sql.match(obs="observed", stars=stars), *FIELD_CTES[[n for n, _ in FIELD_CTES].index("mags"):]]


#: The same without pruning: every star may be met.
ALL_STARS_CTES = _field_ctes(sql.STARS6)


def _calibrated(spark, d, **options):
    objects, metadata = _field(spark, d)
    return calibrate_survey(*metadata, object_catalog(objects), star_catalog(stored(spark, d, "star")),
                            tiles.survey_tiles(spark), **options)


@query(sql.with_tables([*FIELD_TABLES, "star"], """SELECT filename AS "FILENAME_2", CAST(tile AS INTEGER) AS "TILE_2",
  band AS "BAND_2", round(quantile_cont(ra_cent, 0.5), 6) AS "RA_CENT_2_MEDIAN",
  round(quantile_cont(mag_diff, 0.5), 6) AS "MAG_ZERO_MEDIAN", round(avg(mag_diff), 6) AS "MAG_ZERO_MEAN",
  round(stddev_samp(mag_diff), 6) AS "MAG_ZERO_STD",
  round(CASE WHEN count(mag_diff) > 1 THEN stddev_samp(mag_diff)/sqrt(count(mag_diff)-1) END, 6) AS "MAG_ZERO_MEAN_ERR",
  count(mag_diff) AS "MAG_ZERO_NUM", quantile_cont(CAST(matchid AS DOUBLE), 0.5) AS "MATCHID_MEDIAN"
  FROM clip3 GROUP BY filename, tile, band""", FIELD_CTES))
def calibrate(spark, d):
    zp = _calibrated(spark, d).zero_points
    return zp.select("FILENAME_2", "TILE_2", "BAND_2", r6("RA_CENT_2_MEDIAN"), *[r6(c) for c in ZP], "MAG_ZERO_NUM", "MATCHID_MEDIAN")


@query(sql.with_tables([*FIELD_TABLES, "star"], """SELECT filename AS "FILENAME_2", CAST(tile AS INTEGER) AS "TILE_2",
  band AS "BAND_2", round(quantile_cont(mag_diff, 0.5), 6) AS "MAG_ZERO_MEDIAN", round(avg(mag_diff), 6) AS "MAG_ZERO_MEAN",
  count(mag_diff) AS "MAG_ZERO_NUM", quantile_cont(CAST(matchid_unit AS DOUBLE), 0.5) AS "MATCHID_MEDIAN"
  FROM clip3 JOIN (SELECT matchid AS m, row_number() OVER (PARTITION BY tile, band ORDER BY matchid) AS matchid_unit FROM matched) AS u
    ON u.m = matchid GROUP BY filename, tile, band""", ALL_STARS_CTES))
def calibrate_resumed(spark, d):
    """A calibration kept by band and tile: a first run knows two thirds of the exposures, a second all of them."""
    objects, (exposure, archive, image) = _field(spark, d)
    stars, boxes, store = star_catalog(stored(spark, d, "star")), tiles.survey_tiles(spark), _scratch(spark, "calibration")
    rest = (archive, image, object_catalog(objects), stars, boxes, store)
    calibrate_changed(exposure.where("expnum % 3 <> 0"), *rest)
    zp = calibrate_changed(exposure, *rest).zero_points
    return zp.select("FILENAME_2", "TILE_2", "BAND_2", r6("MAG_ZERO_MEDIAN"), r6("MAG_ZERO_MEAN"), "MAG_ZERO_NUM", "MATCHID_MEDIAN")


@query(sql.with_tables([*FIELD_TABLES, "star"], """SELECT 'catalog' AS kind, filename AS name FROM images
    WHERE filename NOT IN (SELECT filename FROM field_obs)
  UNION SELECT 'pixel', CAST(hpx8 AS VARCHAR) FROM pixels WHERE hpx8 NOT IN (SELECT hpx8 FROM starpix)""",
                       FIELD_CTES[: [n for n, _ in FIELD_CTES].index("starpix") + 1]))
def calibrate_missing(spark, d):
    """What a whole calibration reports as not there: catalogues and reference pixels of its images."""
    run = _calibrated(spark, d)
    return run.missing_catalogs.select(F.lit("catalog").alias("kind"), F.col("FILENAME").alias("name")).union(
        run.missing_pixels.select(F.lit("pixel"), F.col("hpx8").cast("string")))


@query(sql.with_tables([*FIELD_TABLES, "star"], """SELECT 'images' AS step, count(*) AS n_rows FROM images
  UNION ALL SELECT 'matched', count(*) FROM matched UNION ALL SELECT 'quality', count(*) FROM quality
  UNION ALL SELECT 'clip pass 1', count(*) FROM clip1 UNION ALL SELECT 'clip pass 2', count(*) FROM clip2
  UNION ALL SELECT 'clip pass 3', count(*) FROM clip3
  UNION ALL SELECT 'zero_points', count(*) FROM (SELECT DISTINCT filename, tile, band FROM clip3) AS z""", FIELD_CTES))
def calibrate_step_counts(spark, d):
    """Rows of every step of a whole calibration, counted while it runs."""
    counts = StepCounts()
    _calibrated(spark, d, counts=counts)
    return spark.createDataFrame(list(counts.rows().items()), "step string, n_rows bigint")
