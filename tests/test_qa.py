import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from skycal.operators import histograms as h
from skycal.operators import qa

ZP = "FILENAME_2 string, MAG_ZERO_NUM bigint, MAG_ZERO_MEAN_ERR double, RA_1_MEDIAN double"


def zp(spark):
    cases = [(56, 0.009), (55, 0.009), (54, 0.009), (31, 0.009), (30, 0.009), (29, 0.5), (31, 0.02), (60, 0.01),
             (60, 0.02), (4, 0.3), (1, None), (5, 0.2)]
    return spark.createDataFrame(
        [(f"D00{i // 2:06d}_g_{i:02d}_x.fits", n, e, 90.0 + 5 * i) for i, (n, e) in enumerate(cases)], ZP)


def exposure(spark):
    chi2 = [100.0, 199.0, 200.0, 201.0, 1000.0, 1001.0, 5.0]
    return spark.createDataFrame([(i, c, 0.1 * i) for i, c in enumerate(chi2)], "EXPNUM bigint, astrom_chi2 double, t_eff double")


def test_classes_have_strict_limits(spark):
    got = [r.ZP_CLASS for r in qa.zp_classes(zp(spark)).orderBy("RA_1_MEDIAN").collect()]
    assert got == ["c1", None, "c2", "c2", None, "c4", "c3", None, "c3", "c4", "c4"]    # the incomplete row is gone


def test_class_counts(spark):
    got = {r.ZP_CLASS: (r.n, r.share) for r in qa.class_counts(qa.zp_classes(zp(spark)), "ZP_CLASS").collect()}
    assert got == {"c1": (1, 1 / 11), "c2": (2, 2 / 11), "c3": (2, 2 / 11), "c4": (3, 3 / 11), None: (3, 3 / 11)}


def test_low_count(spark):
    assert qa.low_count(zp(spark)).count() == 2
    assert qa.low_count(zp(spark), 30).count() == 4
    assert qa.low_count(zp(spark), 30, ra_above=120.0).count() == 3


def test_error_statistics(spark):
    errs = [r[0] for r in zp(spark).select("MAG_ZERO_MEAN_ERR").dropna().collect()]
    r = qa.err_stats(zp(spark)).first()
    assert (r.n, r.err_min) == (11, 0.009)
    assert r.err_mean == round(np.mean(errs), 4) and r.err_std == round(np.std(errs), 4)
    assert r.err_median == round(float(np.median(errs)), 4)


def test_exposures_behind_zero_points(spark):
    bad = qa.low_count(zp(spark), 30)
    assert rows(qa.exposures_of(bad), "EXPNUM") == [(2,), (4,), (5,)]
    assert rows(qa.distinct_exposures(bad)) == [(4, 3)]
    assert [r.EXPNUM for r in qa.flagged_exposures(exposure(spark), bad).orderBy("EXPNUM").collect()] == [2, 4, 5]
    flags = {r.EXPNUM: r.FLAGGED for r in qa.flag_exposures(exposure(spark), bad).collect()}
    assert flags == {i: i in (2, 4, 5) for i in range(7)}
    assert qa.exposure_lookup(zp(spark), exposure(spark)).count() == 12      # one row per zero point


def test_chi2_classes(spark):
    got = {r.FILENAME_2[10:14]: (r.CHI2_CLASS, r.CHI2_BAND) for r in qa.chi2_classes(zp(spark), exposure(spark)).collect()}
    by_number = {int(k.strip("_g")): v for k, v in got.items()}
    assert by_number[0] == ("rest", "low_chi2_small_error")
    assert by_number[4] == ("rest", None)                        # chi2 exactly 200
    assert by_number[5] == ("large_error", None)
    assert by_number[6] == ("rest", "high_chi2")                 # 201, small error
    assert by_number[9] == ("rest", "high_chi2")                 # chi2 exactly 1000 is neither above nor below
    assert by_number[11] == ("bad_astrometry", "high_chi2")


def test_share_counts_unknown_as_no(spark):
    assert qa.share(zp(spark), F.col("MAG_ZERO_MEAN_ERR") < 0.01).first()[0] == pytest.approx(5 / 12)


def test_top_rows(spark):
    df = spark.range(100).withColumn("k", F.pmod(F.col("id") * 37, F.lit(100)))
    assert [r.k for r in qa.top_rows(df, ["k"], 3).collect()] == [0, 1, 2]
    assert [r.k for r in qa.top_rows(df, ["k"], 1, skip=2).collect()] == [2]
    assert "TakeOrderedAndProject" in plan_of(qa.top_rows(df, ["k"], 3), "simple")


# ---- histograms against the usual library's counts ----

VALUES = [1e-4, 1e-3, 0.0010001, 0.01, 0.0123, 0.05, 0.1, 0.5, 0.999, 1.0, 1.0001, 7.0, -1.0, 0.0]


def counts(df):
    return [r.n for r in df.orderBy("bin").collect()]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")


def test_log_histogram(spark):
    rng = np.random.default_rng(0)
    edges = 10 ** np.linspace(-3, 0, 50)
    values = [*VALUES, *10 ** rng.uniform(-4, 1, 500)]
    df = h.histogram_log(frame(spark, values), "x")
    assert counts(df) == list(np.histogram(values, bins=edges)[0])
    got = df.orderBy("bin").collect()
    assert np.allclose([r.lo for r in got], edges[:-1]) and np.allclose([r.hi for r in got], edges[1:])


def test_log_histogram_on_its_own_edges(spark):
    edges = frame(spark, []).sparkSession.range(50).select(F.pow(F.lit(10.0), -3.0 + 3.0 / 49 * F.col("id")).alias("x"))
    assert counts(h.histogram_log(edges, "x")) == [1] * 48 + [2]


def test_linear_histogram(spark):
    values = [*range(-3, 104), 99.99, 2.0, 1.9999]
    assert counts(h.histogram_linear(frame(spark, values), "x")) == list(np.histogram(values, bins=50, range=(0, 100))[0])


def test_auto_histogram(spark):
    values = list(np.random.default_rng(2).gamma(2.0, 40.0, 400))
    df = h.histogram_auto(frame(spark, values), "x")
    assert counts(df) == list(np.histogram(values)[0])
    assert counts(h.histogram_auto(frame(spark, [3.0, 3.0]), "x")) == list(np.histogram([3.0, 3.0])[0])
    assert counts(h.histogram_auto(frame(spark, []), "x")) == [0] * 10
    plan = plan_of(df, "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
