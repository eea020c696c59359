import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from skycal.functions import photometry as phot
from skycal.functions.numeric import nan_to_null
from skycal.operators import zeropoints as z
from skycal.operators.clipping import flag_outliers, sigma_clip
from skycal.operators.counts import StepCounts
from skycal.operators.materialize import materialize
from skycal.operators.medians import grouped_medians, median_of_large_groups, medians_in_one_pass
from skycal.operators.skew import split_hot

STAR = "G_1 double, R_1 double, I_1 double, Z_1 double, DG_1 double, DR_1 double, DI_1 double, DZ_1 double"


# ---- magnitudes and cuts ----

# Worked by hand from the published colour terms at g=18, r=17.5, i=17.2, z=17.1.
@pytest.mark.parametrize("band, want, err", [
    ("g", 18 + 0.0994 * 0.5 - 0.0076, 0.01), ("r", 17.5 - 0.1335 * 0.5 + 0.0189, 0.02),
    ("i", 17.2 - 0.3407 * 0.1 + 0.0026, 0.03), ("z", 17.1 - 0.2575 * 0.1 - 0.0074, 0.04),
    ("Y", 17.1 - 0.6032 * 0.1 + 0.0185, 0.04)])
def test_transforms(spark, band, want, err):
    df = spark.createDataFrame([(18.0, 17.5, 17.2, 17.1, 0.01, 0.02, 0.03, 0.04)], STAR)
    r = df.select(phot.mag_std(F.lit(band)).alias("m"), phot.magerr_std(F.lit(band)).alias("e")).first()
    assert r.m == pytest.approx(want, abs=1e-12) and r.e == err


def test_unknown_band(spark):
    df = spark.createDataFrame([(18.0, 17.5, 17.2, 17.1, 0.01, 0.02, 0.03, 0.04)], STAR)
    assert df.where(phot.colour_ok(F.lit("u"))).count() == 0
    with pytest.raises(ValueError, match="'u'"):
        phot.check_band("u")


def test_colour_range_is_open_below_and_closed_above(spark):
    # Dyadic magnitudes make the colours exact; the limits themselves are compared as doubles.
    df = spark.createDataFrame([(c, 0.0, c, 0.0, *[0.01] * 4) for c in (-0.2, -0.19, 0.3, 0.31, 1.2, 1.21)], STAR)
    ok = lambda b: [r.G_1 for r in df.where(phot.colour_ok(F.lit(b))).collect()]
    assert ok("g") == ok("r") == [-0.19, 0.3, 0.31, 1.2]
    assert ok("i") == ok("z") == ok("Y") == [-0.19, 0.3]


def test_instrumental_magnitude(spark):
    df = spark.createDataFrame([(100.0,), (0.0,), (-1.0,), (None,)], "f double")
    got = [r[0] for r in df.select(phot.inst_mag(F.col("f"))).collect()]
    assert got == [-5.0, math.inf, None, None]


def test_quality_limits(spark):
    cols = "n string, m double, e double, FLUX_PSF_2 double, FLAGS_2 int, SPREAD_MODEL_2 double"
    good = ("ok", 0.0, 0.0, 10.1, 1, 0.0099)
    bad = [("mag", -0.1, 0.0, 10.1, 1, 0.0), ("mag", 25.1, 0.0, 10.1, 1, 0.0), ("flux", 1.0, 0.0, 10.0, 1, 0.0),
           ("flags", 1.0, 0.0, 10.1, 2, 0.0), ("spread", 1.0, 0.0, 10.1, 1, 0.01), ("spread", 1.0, 0.0, 10.1, 1, -0.01),
           ("err", 1.0, 0.1, 10.1, 1, 0.0), ("null", 1.0, None, 10.1, 1, 0.0)]
    df = spark.createDataFrame([good, ("ok", 25.0, 0.09, 11.0, 0, -0.0099), *bad], cols)
    got = df.where(phot.quality_ok(F.col("m"), F.col("e"))).select("n").collect()
    assert [r.n for r in got] == ["ok", "ok"]


# ---- medians ----

@pytest.mark.parametrize("bits", [16, 7])      # four passes, or ten with a short last one
def test_median_of_large_groups(spark, bits):
    rng = random.Random(4)
    data = [("odd", float(v)) for v in rng.sample(range(1000), 501)]
    data += [("even", rng.gauss(0, 1e6)) for _ in range(400)]
    data += [("copies", 5.0)] * 300 + [("copies", float(i)) for i in range(100)]
    data += [("one", 3.5), ("null", None), ("two", 1.0), ("two", 2.0)]
    data += [("inf", -math.inf)] * 3 + [("inf", 7.0), ("inf", 8.0), ("inf", 9.0), ("inf", 10.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r["median"] for r in median_of_large_groups(df, ["k"], "v", bits=bits).collect()}
    want = pd.DataFrame(data, columns=["k", "v"]).dropna().groupby("k")["v"].median().to_dict()
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-15), k


def test_radix_medians_of_odd_numbers(spark):
    inf, tiny = math.inf, 5e-324
    groups = {"zeros": [-0.0, 0.0, -0.0], "signs": [-tiny, tiny, -1.5, 1.5], "ends": [-1.7e308, 1.7e308, inf], "below": [-3.0, -1.0, -2.0, -inf],
              "near": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0)], "nan": [1.0, math.nan, 2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [(None, 9.0)], "k string, v double")
    got = {r.k: r["median"] for r in median_of_large_groups(df, ["k"], "v").collect()}
    assert got == {"zeros": 0.0, "signs": 0.0, "ends": 1.7e308, "below": -2.5, "near": 1.0, "nan": 2.0}
    big = (1 << 62) + 1
    whole = spark.createDataFrame([(1, -big), (1, 5), (1, big), (2, -3), (2, -4)], "k int, v bigint")
    assert rows(median_of_large_groups(whole, ["k"], "v")) == [(1, 5.0), (2, -3.5)]
    with pytest.raises(ValueError, match="bits"):
        median_of_large_groups(df, ["k"], "v", bits=0)


def test_radix_medians_run_lazily_in_as_many_passes_whatever_the_values(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") * F.pow(F.lit(10.0), F.col("id") % 200 - 100)).alias("v"))
    plan = plan_of(median_of_large_groups(df, ["k"], "v"), "simple")
    assert plan.count("FileScan parquet") == 4 and "CartesianProduct" not in plan and "ObjectHashAggregate" not in plan
    got = {r.k: r["median"] for r in median_of_large_groups(df, ["k"], "v").collect()}
    assert got == df.toPandas().groupby("k")["v"].median().to_dict()


def test_median_without_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    assert rows(median_of_large_groups(df, [], "v")) == [(5.0,)]
    assert rows(median_of_large_groups(df.where("v > 100"), [], "v")) == []


def test_grouped_medians_mix_ordinary_and_hot(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.choice(["a", "a", "a", "b", "c"], 600), "x": rng.normal(size=600), "y": rng.integers(0, 9, 600)})
    pdf.loc[pdf.k == "c", "x"] = np.nan
    df = nan_to_null(spark.createDataFrame(pdf))
    want = pdf.groupby("k")[["x", "y"]].median()
    for limit in (0, 200, 10_000):
        got = grouped_medians(df, ["k"], ["x", "y"], hot_rows=limit).toPandas().set_index("k").sort_index()
        assert np.allclose(got["x_MEDIAN"].astype(float), want["x"], equal_nan=True)
        assert np.allclose(got["y_MEDIAN"], want["y"])


def test_split_hot(spark):
    df = spark.range(100).select(F.when(F.col("id") < 60, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    ordinary, hot, groups = split_hot(df, ["k"], 50)
    assert (ordinary.count(), hot.count(), groups) == (40, 60, 1)
    assert split_hot(df, ["k"], 60)[1:] == (None, 0)


def test_a_huge_group_of_null_keys_is_split_off_too(spark):
    df = spark.range(100).select(F.when(F.col("id") < 60, None).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").cast("double").alias("x"))
    ordinary, hot, groups = split_hot(df, ["k"], 50)
    assert (ordinary.count(), hot.count(), groups) == (40, 60, 1)
    got = {r.k: r.x_MEDIAN for r in grouped_medians(df, ["k"], ["x"], hot_rows=50).collect()}
    assert got == {None: 29.5, **{str(i): float(i) for i in range(60, 100)}}


def test_ordinary_groups_are_never_kept_side_by_side_in_a_hash_table(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), *[(F.col("id") * j).cast("double").alias(f"c{j}") for j in range(1, 30)])
    plan = plan_of(medians_in_one_pass(df, ["k"], [f"c{j}" for j in range(1, 30)]), "simple")
    assert "ObjectHashAggregate" not in plan and plan.count("Exchange") == 1


def test_both_ways_agree_at_the_limit_itself(spark):
    pdf = clip_data(11)
    largest = int(pdf.groupby("k").size().max())
    df = spark.createDataFrame(pdf).withColumnRenamed("x", "MAG_DIFF")
    both = [z.clip_and_aggregate(df, ["k"], [], hot_rows=n).toPandas().set_index("k").sort_index() for n in (largest, largest - 1)]
    assert split_hot(df, ["k"], largest)[2] == 0 and split_hot(df, ["k"], largest - 1)[2] >= 1
    assert (both[0]["MAG_ZERO_NUM"] == both[1]["MAG_ZERO_NUM"]).all() and np.allclose(
        both[0].drop(columns="MAG_ZERO_NUM").astype(float), both[1].drop(columns="MAG_ZERO_NUM").astype(float), rtol=1e-12, equal_nan=True)


def test_clip_equals_the_plain_comparison_where_no_values_are_equal(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 6, 900), "x": rng.standard_t(2, 900)})
    group = pdf.groupby("k")["x"]
    want = ((pdf.x - group.transform("mean")).abs() > 3 * group.transform("std")).sum()
    assert flag_outliers(spark.createDataFrame(pdf), ["k"], "x").where("Outlier").count() == want > 0


# ---- clipping ----

def pandas_clip(pdf, key, value, nsigma=3.0, passes=3):
    """Flag, remove, repeat; the last flags are returned and remove nothing."""
    for i in range(passes):
        if i:
            pdf = pdf[~flags]
        # Per group as a Series: its deviation is taken around the very mean it is compared with.
        flags = pd.Series(False, index=pdf.index)
        for _, x in pdf.groupby(key)[value]:
            flags[x.index] = (x - x.mean()).abs() > nsigma * x.std()
    return pdf.assign(flag=flags)


def clip_data(seed=7):
    rng = np.random.default_rng(seed)
    parts = []
    for k in range(8):
        x = np.concatenate([rng.normal(31, 0.02, 60 + 10 * k), rng.normal(31, 0.4, 10), [33.0, 28.0, 31.4, 31.2]])
        parts.append(pd.DataFrame({"k": f"g{k}", "x": x}))
    parts.append(pd.DataFrame({"k": "single", "x": [30.0]}))
    parts.append(pd.DataFrame({"k": "equal", "x": [0.1 + 0.2] * 7}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf["id"] = range(len(pdf))
    return pdf


@pytest.mark.parametrize("hot", [0, 10, 10**9])
@pytest.mark.parametrize("nsigma", [3.0, 2.0])
def test_clip_matches_pandas(spark, hot, nsigma):
    pdf = clip_data()
    want = pandas_clip(pdf, "k", "x", nsigma)
    assert 0 < len(want) < len(pdf) and want.flag.any(), "the third pass must still flag something"
    df = spark.createDataFrame(pdf)
    got = sigma_clip(df, ["k"], "x", nsigma, hot_groups=hot).toPandas().sort_values("id")
    assert list(got["id"]) == list(want["id"])
    assert list(got["Outlier"]) == list(want["flag"])
    applied = sigma_clip(df, ["k"], "x", nsigma, apply_last=True, hot_groups=hot)
    assert applied.count() == (~want.flag).sum()


def test_single_rows_and_equal_values_are_no_outliers(spark):
    df = spark.createDataFrame([("s", 1.0)] + [("e", 0.1)] * 3 + [("n", None)], "k string, x double")
    assert flag_outliers(df, ["k"], "x").where("Outlier").count() == 0


def test_null_keys_belong_to_no_group(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 1.0)], "k string, x double")
    assert sigma_clip(df, ["k"], "x").count() == 1
    assert sigma_clip(df, ["k"], "x", hot_groups=1).count() == 1


def test_clip_and_aggregate_take_one_shuffle(spark):
    df = materialize(spark.createDataFrame(clip_data()))
    clipped = sigma_clip(df, ["k"], "x").groupBy("k").agg(F.median("x"), F.avg("x"))
    plan = plan_of(clipped, "simple")
    assert plan.count("Exchange hashpartitioning") == 1
    # The flags of the third pass remove nothing and nobody asks for them: that window is pruned.
    assert plan.count("Window [") == 2


# ---- zero points ----

def matched_frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    g = rng.uniform(15, 20, n)
    flux = 10 ** (-0.4 * (g - 31 + rng.normal(0, 0.03, n)))
    flux[:5] = [0.0, 0.0, -1.0, np.nan, 1e-9]
    pdf = pd.DataFrame({
        "FILENAME_2": [f"D00{100000 + i % 6}_g_01_r1p1_fullcat.fits" for i in range(n)], "G_1": g, "R_1": g - 0.4,
        "I_1": g - 0.5, "Z_1": g - 0.6, "DG_1": 0.01, "DR_1": 0.01, "DI_1": 0.01, "DZ_1": 0.01,
        "FLUX_APER_08_2": flux, "FLUXERR_APER_08_2": 1.0, "FLUX_PSF_2": 50.0, "FLAGS_2": 0, "SPREAD_MODEL_2": 0.0,
        "MATCHID": np.arange(n), "TILE_2": np.where(np.arange(n) % 6 < 3, 1, 2), "BAND_2": "g"})
    pdf.loc[n - 1, "FILENAME_2"] = "D00999999_g_01_r1p1_fullcat.fits"
    pdf.loc[20, "FILENAME_2"] = None
    return pdf, spark.createDataFrame(pdf)


def pandas_zero_points(pdf):
    pdf = pdf.copy()
    with np.errstate(divide="ignore", invalid="ignore"):
        pdf["MAG_STD"] = pdf.G_1 + 0.0994 * (pdf.G_1 - pdf.R_1) - 0.0076
        pdf["MAG_DIFF"] = pdf.MAG_STD + 2.5 * np.log10(pdf.FLUX_APER_08_2)
    med = pdf.groupby(["TILE_2", "BAND_2"])["MAG_DIFF"].transform("median")
    pdf = pdf[(pdf.MAG_DIFF > med - 5) & (pdf.MAG_DIFF < med + 5)]
    pdf = pandas_clip(pdf[pdf.FILENAME_2.notna()], "FILENAME_2", "MAG_DIFF")
    g = pdf.groupby("FILENAME_2")
    out = pd.DataFrame({"median": g.MAG_DIFF.median(), "mean": g.MAG_DIFF.mean(), "std": g.MAG_DIFF.std(),
                        "n": g.MAG_DIFF.count(), "id": g.MATCHID.median(), "g": g.G_1.median()})
    out["err"] = out["std"] / np.sqrt(out["n"] - 1)
    return out.sort_index()


@pytest.mark.parametrize("hot_rows", [500_000, 60, 0])
def test_zero_points_match_pandas(spark, hot_rows):
    pdf, df = matched_frame(spark)
    got = z.zero_points(df, F.col("BAND_2"), median_per=["TILE_2", "BAND_2"], hot_rows=hot_rows)
    got = got.toPandas().set_index("FILENAME_2").sort_index()
    want = pandas_zero_points(pdf)
    assert list(got.index) == list(want.index)
    for ours, theirs in [("MAG_ZERO_MEDIAN", "median"), ("MAG_ZERO_MEAN", "mean"), ("MAG_ZERO_STD", "std"),
                         ("MAG_ZERO_MEAN_ERR", "err"), ("MAG_ZERO_NUM", "n"), ("MATCHID_MEDIAN", "id"), ("G_1_MEDIAN", "g")]:
        assert np.allclose(got[ours].astype(float), want[theirs].astype(float), rtol=1e-10, equal_nan=True), ours
    # The lone image: no deviation, no error.
    assert np.isnan(got.loc["D00999999_g_01_r1p1_fullcat.fits", "MAG_ZERO_MEAN_ERR"])


@pytest.mark.parametrize("hot_rows", [500_000, 60, 0])
def test_counts_of_the_steps(spark, hot_rows):
    pdf, df = matched_frame(spark)
    counts = StepCounts()
    solve = lambda c: z.zero_points(df, F.col("BAND_2"), median_per=["TILE_2", "BAND_2"], hot_rows=hot_rows, counts=c)
    got, plain = solve(counts), solve(None)
    assert rows(got, "FILENAME_2") == rows(plain, "FILENAME_2")
    with np.errstate(divide="ignore", invalid="ignore"):
        pdf["x"] = pdf.G_1 + 0.0994 * (pdf.G_1 - pdf.R_1) - 0.0076 + 2.5 * np.log10(pdf.FLUX_APER_08_2)
    quality = int(((pdf.FLUX_APER_08_2 >= 0) & (1.0857 / pdf.FLUX_APER_08_2.where(pdf.FLUX_APER_08_2 > 0, np.nan) < 10)).sum())
    med = pdf.groupby("TILE_2")["x"].transform("median")
    left = pdf[(pdf.x > med - 5) & (pdf.x < med + 5) & pdf.FILENAME_2.notna()]
    passes = [len(pandas_clip(left, "FILENAME_2", "x", passes=k)) for k in (1, 2, 3)]
    counted = counts.rows()
    assert [counted[f"clip pass {k}"] for k in (1, 2, 3)] == passes and passes[0] > passes[2]
    assert counted["quality"] >= passes[0] and list(counted)[0] == "quality" and abs(counted["quality"] - quality) <= 5


def test_clip_of_hot_groups_reads_the_rows_once_a_pass(spark):
    df = materialize(spark.createDataFrame(clip_data()))
    plan = plan_of(sigma_clip(df, ["k"], "x", hot_groups=10), "simple")
    assert plan.count("FileScan") == 2 and plan.count("Window [") == 0


def test_counting_adds_no_scan_and_no_shuffle(spark):
    df = materialize(spark.createDataFrame(clip_data()).withColumnRenamed("x", "MAG_DIFF"))
    with_counts, without = [plan_of(z.clip_and_aggregate(df, ["k"], [], counts=c), "simple") for c in (StepCounts(), None)]
    for node in ("FileScan", "Exchange", "Sort ["):
        assert with_counts.count(node) == without.count(node) > 0, node
    assert with_counts.count("CollectMetrics") == 3


def test_missing_columns_are_all_named(spark):
    _, df = matched_frame(spark)
    with pytest.raises(ValueError, match="DZ_1.*FLAGS_2"):
        z.zero_points(df.drop("DZ_1", "FLAGS_2"), "g")
    with pytest.raises(ValueError, match="'u'"):
        z.zero_points(df, "u")


def test_column_names_are_parameters(spark):
    _, df = matched_frame(spark)
    got = z.zero_points(df.withColumnsRenamed({"FLUX_APER_08_2": "F_2", "FLUXERR_APER_08_2": "E_2"}), "g",
                        flux="F_2", fluxerr="E_2", key="TILE_2", all_medians=False)
    assert got.columns == ["TILE_2", "MAG_ZERO_MEDIAN", "MAG_ZERO_MEAN", "MAG_ZERO_STD", "MAG_ZERO_MEAN_ERR", "MAG_ZERO_NUM"]
    assert got.count() == 2


@pytest.mark.parametrize("hot_rows", [500_000, 60])
def test_a_stored_match_table_is_not_written_again(spark, monkeypatch, hot_rows):
    df = materialize(matched_frame(spark)[1])
    written = {}
    monkeypatch.setattr(z, "materialize", lambda rows, label: written.update({label: rows.columns}) or materialize(rows, label))
    solve = lambda **o: z.zero_points(df, F.col("BAND_2"), median_per=["TILE_2", "BAND_2"], hot_rows=hot_rows, **o).toPandas()
    want = solve().sort_values("FILENAME_2", ignore_index=True)
    got = solve(stored=True).sort_values("FILENAME_2", ignore_index=True)
    pd.testing.assert_frame_equal(got, want, rtol=1e-12)
    assert len(got) and written["quality"] == ["FILENAME_2", "TILE_2", "BAND_2", "MAG_DIFF"]


def test_the_limit_of_methods_is_the_sessions_own_again(spark):
    from skycal.operators.materialize import COMPILED, compiled_methods
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), compiled_methods(spark):
        assert int(spark.conf.get(name)) == COMPILED
        raise RuntimeError
    assert spark.conf.get(name) == before
