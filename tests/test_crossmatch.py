import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan_of
from skycal.operators.crossmatch import crossmatch, expected_copies
from skycal.operators.matchid import match_ids

TOL = 2.0 / 3600


def wrap(ra):
    return ra - 360 if ra > 180 else ra


def delta2(o, s):
    d = o[0] - s[0]
    d = d - 360 if d > 180 else d + 360 if d < -180 else d
    d *= math.cos(math.radians(o[1]))
    return d * d + (o[1] - s[1]) ** 2


def brute_force(stars, obs, pick, tol=TOL):
    out = {}
    for oid, *o in obs:
        near = [(delta2(o, s[1:]), wrap(s[1]), s[2], s[0]) for s in stars if delta2(o, s[1:]) < tol * tol]
        if near:
            out[oid] = (min(near, key=lambda n: n[1:]) if pick == "first" else min(near))[3]
    return out


def match(spark, stars, obs, pick="first", **options):
    std = spark.createDataFrame(stars, "id bigint, ra double, dec double")
    seen = spark.createDataFrame(obs, "id bigint, ra double, dec double")
    return crossmatch(std, seen, pick=pick, std_pos=("ra", "dec"), obs_pos=("ra", "dec"), tie_break=["id"], **options)


def as_map(df):
    rows = df.collect()
    got = {r.ID_2: r.ID_1 for r in rows}
    assert len(got) == len(rows)
    return got


def random_sky(seed, n=150):
    """Dense knots everywhere that is hard: poles, the RA seam, the wrap at 180, and one crowded spot."""
    rng = random.Random(seed)
    knots = [(0.0, 0.0), (180.0, -30.0), (359.9999, 45.0), (10.0, 89.9999), (200.0, -89.9998), (77.0, 87.5),
             (123.4, -60.0), (0.0, -90.0), (45.0, 12.0)]
    def point():
        ra, dec = rng.choice(knots)
        dec = max(-90.0, min(90.0, dec + rng.uniform(-3, 3) * TOL))
        cos = max(math.cos(math.radians(dec)), 1e-4)
        return (ra + rng.uniform(-3, 3) * TOL / cos) % 360, dec
    stars = [(i, *point()) for i in range(n)]
    stars += [(n + i, *stars[i][1:]) for i in range(20)]          # copies of stars
    obs = [(i, *point()) for i in range(2 * n)]
    obs += [(2 * n + i, *obs[i][1:]) for i in range(40)]          # copies of positions
    return stars, obs


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("pick", ["first", "nearest"])
@pytest.mark.parametrize("cell_tols", [1.0, 4.0])
def test_equals_brute_force(spark, seed, pick, cell_tols):
    stars, obs = random_sky(seed)
    want = brute_force(stars, obs, pick)
    assert len(want) > 50
    assert as_map(match(spark, stars, obs, pick, cell_tols=cell_tols)) == want


def test_equals_brute_force_without_broadcast(spark):
    stars, obs = random_sky(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = match(spark, stars, obs)
        assert "SortMergeJoin" in plan_of(df) and "NestedLoop" not in plan_of(df)
        assert as_map(df) == brute_force(stars, obs, "first")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ra=st.floats(0, 359.999999), dec=st.floats(-90, 90), tol=st.sampled_from([0.5, 2.0, 60.0]), seed=st.integers(0, 99))
def test_any_place_any_tolerance(spark, ra, dec, tol, seed):
    rng = random.Random(seed)
    cos = max(math.cos(math.radians(dec)), 1e-3)
    def near():
        return ((ra + rng.uniform(-2, 2) * tol / 3600 / cos) % 360,
                max(-90.0, min(90.0, dec + rng.uniform(-2, 2) * tol / 3600)))
    stars = [(i, *near()) for i in range(20)]
    obs = [(i, *near()) for i in range(20)]
    got = as_map(match(spark, stars, obs, tol_arcsec=tol))
    assert got == brute_force(stars, obs, "first", tol / 3600)


def test_first_is_not_nearest(spark):
    stars = [(1, 10.0, 0.0), (2, 10.0002, 0.0)]
    obs = [(1, 10.0002, 0.0)]
    assert as_map(match(spark, stars, obs)) == {1: 1}
    assert as_map(match(spark, stars, obs, "nearest")) == {1: 2}


def test_tolerance_is_strict(spark):
    tol = 3600 * 0.0009765625          # a power of two in degrees: the distance is exact
    stars = [(1, 10.0, 0.0)]
    obs = [(1, 10.0, 0.0009765625), (2, 10.0, 0.00097656)]
    assert as_map(match(spark, stars, obs, tol_arcsec=tol)) == {2: 1}


def test_both_conventions_of_ra_match(spark):
    assert as_map(match(spark, [(1, -0.0001, 5.0)], [(7, 359.9999, 5.0), (8, 0.0001, 5.0)])) == {7: 1, 8: 1}


def test_unplaced_rows_drop_and_copies_stay(spark):
    stars = [(1, 10.0, 0.0), (2, None, 0.0)]
    obs = [(1, 10.0, 0.0), (1, 10.0, 0.0), (2, None, 0.0), (3, 10.0, float("nan")), (4, 50.0, 0.0)]
    assert [(r.ID_1, r.ID_2) for r in match(spark, stars, obs).collect()] == [(1, 1), (1, 1)]


def test_one_star_takes_many_observations(spark):
    got = as_map(match(spark, [(1, 10.0, 0.0)], [(i, 10.0 + i * 1e-5, 0.0) for i in range(20)]))
    assert got == {i: 1 for i in range(20)}


def test_columns_carry_suffixes(spark):
    df = match(spark, [(1, 10.0, 0.0)], [(1, 10.0, 0.0)])
    assert df.columns == ["ID_1", "RA_1", "DEC_1", "ID_2", "RA_2", "DEC_2"]


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        match(spark, [(1, 1.0, 1.0)], [(1, 1.0, 1.0)], "best")
    with pytest.raises(ValueError):
        match(spark, [(1, 1.0, 1.0)], [(1, 1.0, 1.0)], cell_tols=0.5)


def test_star_copies_are_few(spark):
    from skycal.operators.crossmatch import _star_cells

    n = 20000
    stars = spark.range(n).select((F.rand(1) * 360).alias("_sra"), F.degrees(F.asin(F.rand(2) * 2 - 1)).alias("_sdec"))
    copies = _star_cells(stars, TOL, 4 * TOL).count() / n
    assert copies == pytest.approx(expected_copies(4.0), rel=0.05)


def test_crowded_position_does_not_multiply(spark):
    # A third of all stars and of all observations in one place: still one row per observation.
    stars = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 10.0).otherwise(F.col("id") * 0.1).alias("ra"),
                                     F.lit(5.0).alias("dec"))
    obs = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 10.0).otherwise(F.col("id") * 0.03).alias("ra"),
                                   F.lit(5.0).alias("dec"))
    got = crossmatch(stars, obs, std_pos=("ra", "dec"), obs_pos=("ra", "dec"), tie_break=["id"])
    hot = got.where("RA_2 = 10.0")
    assert hot.count() >= 3000
    assert {r.ID_1 for r in hot.select("ID_1").distinct().collect()} == {0}


def test_match_ids_follow_the_order(spark):
    stars, obs = random_sky(5)
    m = match(spark, stars, obs).withColumn("W_1", F.when(F.col("RA_1") > 180, F.col("RA_1") - 360).otherwise(F.col("RA_1")))
    got = match_ids(m, ["W_1", "DEC_1", "ID_1"], ["RA_2", "DEC_2", "ID_2"])
    rows = sorted(got.collect(), key=lambda r: r.MATCHID)
    assert [r.MATCHID for r in rows] == list(range(1, m.count() + 1))
    keys = [(r.W_1, r.DEC_1, r.ID_1, r.RA_2, r.DEC_2, r.ID_2) for r in rows]
    assert keys == sorted(keys)
