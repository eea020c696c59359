import math

import pytest
from pyspark.sql import functions as F

from skycal.functions import sky
from skycal.operators.tiles import footprint_grid, sky_grid


def one(spark, column, **values):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("ra, want", [(0.0, 0.0), (180.0, 180.0), (180.001, -179.999), (359.9999, -0.0001)])
def test_ra_wrap(spark, ra, want):
    assert one(spark, sky.ra_wrap(F.lit(ra))) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("a, b, want", [(0.1, 359.9, 0.2), (359.9, 0.1, -0.2), (-179.9, 179.9, 0.2), (10.0, 350.0, 20.0)])
def test_delta_ra_is_modular(spark, a, b, want):
    assert one(spark, sky.delta_ra(F.lit(a), F.lit(b))) == pytest.approx(want, abs=1e-9)


def test_separation_uses_observed_declination(spark):
    got = one(spark, sky.sep_sq(F.lit(10.0), F.lit(60.0), F.lit(10.5), F.lit(60.1)))
    assert got == pytest.approx((0.5 * math.cos(math.radians(60))) ** 2 + 0.01, rel=1e-9)


def test_box_area_and_ra_limit(spark):
    # The printed examples of a 100 square degree box between Dec -25 and -15 from RA 170.
    area = one(spark, sky.box_area(F.lit(170.0), F.lit(180.6), F.lit(-15.0), F.lit(-25.0)))
    s = math.sin(math.radians(-15)) - math.sin(math.radians(-25))
    assert area == pytest.approx(math.degrees(1) * 10.6 * s)
    limit = one(spark, sky.ra_limit(F.lit(170.0), F.lit(-15.0), F.lit(-25.0), F.lit(100.0)))
    assert limit == pytest.approx(170 + math.radians(100) / s)
    assert one(spark, sky.ra_limit(F.lit(1.0), F.lit(5.0), F.lit(5.0), F.lit(100.0))) is None


@pytest.mark.parametrize("nside", [1, 8, 64])
def test_pixel_center_pixel_round_trip(spark, nside):
    npix = 12 * nside * nside
    pixels = spark.range(npix).withColumnRenamed("id", "p")
    back = sky.add_healpix(sky.add_healpix_center(pixels, nside, "p", "ra", "dec"), nside, "ra", "dec", "q")
    assert back.columns == ["p", "ra", "dec", "q"]
    assert back.where("p <> q or q is null").count() == 0
    assert back.where("ra < 0 or ra >= 360 or abs(dec) > 90").count() == 0


def test_known_pixel_center(spark):
    p = spark.createDataFrame([(45042308,)], "p bigint")
    r = sky.add_healpix_center(p, 4096, "p", "ra", "dec").first()
    assert (r.ra, r.dec) == (pytest.approx(239.150390625), pytest.approx(33.543615978, abs=1e-8))


def test_pixel_of_unknown_position_is_null_and_ra_is_modular(spark):
    df = spark.createDataFrame([(1, None, 0.0), (2, 1.0, None), (3, 361.0, 5.0), (4, 1.0, 5.0), (5, 0.0, 90.0), (6, 0.0, -90.0)],
                               "id int, ra double, dec double")
    got = {r.id: r.p for r in sky.add_healpix(df, 8, "ra", "dec", "p").collect()}
    assert got[1] is None and got[2] is None
    assert got[3] == got[4]
    assert got[5] == 0 and got[6] == 12 * 64 - 4


def test_equal_area_of_pixels(spark):
    # A fine grid in RA and sin(Dec) falls evenly on the 12 pixels of nside 1.
    df = spark.range(360 * 200).select(
        (F.pmod("id", F.lit(360)) + 0.5).alias("ra"),
        F.degrees(F.asin((F.floor(F.col("id") / 360) + 0.5) / 100 - 1)).alias("dec"))
    counts = [r["count"] for r in sky.add_healpix(df, 1, "ra", "dec", "p").groupBy("p").count().collect()]
    assert len(counts) == 12 and max(counts) - min(counts) < 200


def test_sky_grid_has_both_ends(spark):
    g = sky_grid(spark, (180, 190), (-20, -10), 5)
    got = sorted((r.ra, r.dec) for r in g.collect())
    assert got == [(180 + 2.5 * i, -20 + 2.5 * j) for i in range(5) for j in range(5)]


def test_footprint_grid(spark):
    df = spark.createDataFrame([(1, 0.0, 3.0, 10.0, 13.0)], "id int, a double, b double, c double, d double")
    got = sorted((r.ra, r.dec) for r in footprint_grid(df, ("a", "b"), ("c", "d"), 4).collect())
    assert got == [(float(i), 10.0 + j) for i in range(4) for j in range(4)]


def test_footprints_over_ra_zero_stay_together(spark):
    df = spark.createDataFrame([(1, 359.45, 0.35, 10.0, 13.0), (2, 0.35, 359.45, 10.0, 13.0), (3, 20.0, 19.4, 1.0, 1.0)],
                               "id int, a double, b double, c double, d double")
    got = footprint_grid(df, ("a", "b"), ("c", "d"), 4).groupBy("id").agg(F.sort_array(F.collect_set(F.round("ra", 6))).alias("ra"))
    assert {r.id: r.ra for r in got.collect()} == {1: [0.05, 0.35, 359.45, 359.75], 2: [0.05, 0.35, 359.45, 359.75], 3: [19.4, 19.6, 19.8, 20.0]}
