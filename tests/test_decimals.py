import math
import random

import pytest
from pyspark.sql import functions as F

from skycal.functions import sky
from skycal.functions.decimals import with_fixed_text, with_rounded
from skycal.functions.numeric import round_fractions


def values():
    rng = random.Random(1)
    out = [0.0, -0.0, 0.5, 1.5, 2.5, -2.5, 0.125, 0.375, 1.005, 2.675, 1e-9, -1e-9, 0.99999951, 0.9999995, 9.9999995, 1e15, 2.0**52 + 0.5, 2.0**53, 123456789012345678.0,
           9.2e18, 1e-300, 5e-324, 4.35, 0.045, 1.0000005, 8.345, 999999.9999995, 0.1 + 0.2]
    out += [k / 2**j for k in range(-41, 42, 3) for j in (1, 2, 3, 5, 7, 12)]
    out += [round(rng.uniform(-1000, 1000), n) + 5 * 10.0**-(n + 1) for n in range(9) for _ in range(60)]
    out += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 14) for _ in range(2000)]
    return out


@pytest.mark.parametrize("decimals", [0, 1, 2, 4, 6, 9, 15])
def test_text_is_that_of_printf(spark, decimals):
    xs = values()
    df = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x double")
    got = {r.k: r.x for r in with_fixed_text(df, ["x"], decimals).collect()}
    wrong = [(x, got[k], f"{x:.{decimals}f}") for k, x in enumerate(xs) if got[k] != f"{x:.{decimals}f}"]
    assert wrong == []


def test_what_is_no_number(spark):
    df = spark.createDataFrame([(0, None), (1, math.nan), (2, math.inf), (3, -math.inf), (4, 1e22)], "k int, x double").orderBy("k")
    assert [r.x for r in with_fixed_text(df, ["x"], 2).collect()] == [None, None, "inf", "-inf", "10000000000000000000000.00"]
    got = [r.x for r in with_rounded(df, ["x"], 2).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [math.inf, -math.inf, 1e22]
    with pytest.raises(ValueError, match="16"):
        with_fixed_text(df, ["x"], 16)


def test_rounded_frames(spark):
    df = spark.createDataFrame([(2.675, 1.005, 7)], "a double, b float, n int")
    assert tuple(round_fractions(df, 2, exact=True).first())[::2] == (2.67, 7)
    assert round_fractions(df, 2).first().a == 2.68
    clash = spark.createDataFrame([(0.125, 1.0, "x")], "`_d0_3` double, `a.b` double, `_D1_0` string")
    assert tuple(with_fixed_text(clash, ["_d0_3", "a.b"], 2).first()) == ("0.12", "1.00", "x")


def nested(spark, nside, places):
    df = spark.createDataFrame(places, "ra double, dec double")
    return [r.p for r in sky.add_healpix_nested(df, nside, "ra", "dec", "p").collect()]


def test_nested_pixels_nest(spark):
    rng = random.Random(2)
    places = [(rng.uniform(-180, 540), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(3000)]
    places += [(r, d) for r in (0.0, 45.0, 90.0, 180.0, 359.9) for d in (90.0, -90.0, 0.0, 41.8, -41.9)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "k int, ra double, dec double")
    for nside in (1, 2, 8, 64, 4096, 1 << 29):
        df = sky.add_healpix_nested(df, nside, "ra", "dec", f"n{nside}")
    df = sky.add_healpix(df, 1, "ra", "dec", "ring1")
    low, high = sky.nested_range(F.col("n8"), 8, 4096)
    rows = df.select("*", low.alias("low"), high.alias("high"), sky.nested_parent(F.col("n4096"), 4096, 64).alias("up")).collect()
    for r in rows:
        # Twelve pixels have one numbering, and every finer one lies in its parent, but for places on a border itself.
        assert 0 <= r.n4096 < 12 * 4096**2
    inside = [r for r in rows[:3000] if r.low <= r.n4096 <= r.high and r.up == r.n64 and r.n1 == r.ring1 == r.n8 >> 6 == r[f"n{1 << 29}"] >> 58]
    assert len(inside) == 3000


@pytest.mark.parametrize("nside", [1, 2, 4, 16])
def test_ring_and_nested_number_the_same_pixels(spark, nside):
    pixels = sky.add_healpix_center(spark.range(12 * nside * nside).withColumnRenamed("id", "ring"), nside, "ring", "ra", "dec")
    both = sky.add_healpix_nested(sky.add_healpix(pixels, nside, "ra", "dec", "back"), nside, "ra", "dec", "nest").collect()
    assert all(r.ring == r.back for r in both) and sorted(r.nest for r in both) == list(range(12 * nside * nside))


def test_known_nested_pixels(spark):
    # Worked by hand from the definition at nside 2: face 0 has its southern corner pixel first and the pole's last.
    assert nested(spark, 2, [(45.0, 89.0), (45.0, 5.0), (0.0, 89.99), (45.0, -89.0), (0.0, 0.5), (300.0, None)])[:4] == [3, 0, 3, 32]
    assert nested(spark, 2, [(300.0, None), (None, 1.0)]) == [None, None]
    with pytest.raises(ValueError, match="3"):
        sky.add_healpix_nested(spark.range(1), 3, "id", "id", "p")
