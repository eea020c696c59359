import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from skycal.functions import names
from skycal.operators import selection as s
from skycal.operators import tiles
from skycal.schemas import ARCHIVE, EXPOSURE, IMAGE

BOX = (170.0, 180.0, -25.0, -15.0)


def exposure(spark):
    base = dict(glat=50.0, exptime=90.0, airmass=1.1, band="g", nite="20200101", mjd_obs=58000.0,
                field="a,b", object="c", program=None)
    cases = [
        dict(radeg=175.0, decdeg=-20.0), dict(radeg=None, decdeg=-20.0), dict(radeg=175.0, decdeg=None),
        dict(radeg=175.0, decdeg=-20.0, glat=10.0), dict(radeg=175.0, decdeg=-20.0, glat=-10.0),
        dict(radeg=175.0, decdeg=-20.0, glat=-10.1), dict(radeg=175.0, decdeg=-20.0, exptime=1.0),
        dict(radeg=175.0, decdeg=-20.0, band="u"), dict(radeg=175.0, decdeg=-20.0, band="Y"),
        dict(radeg=170.0, decdeg=-25.0), dict(radeg=180.0, decdeg=-20.0), dict(radeg=175.0, decdeg=-15.0),
    ]
    return spark.createDataFrame([{"expnum": i, **base, **c} for i, c in enumerate(cases)], EXPOSURE)


def archive(spark, keys=range(12)):
    cases = [(i, 1, "/a", f"D00{i:06d}_g_01.fits", "", "fullcat") for i in keys]
    cases += [(0, 2, "/a", "x.fits", None, "fullcat"), (0, 3, "/a", "y.fits", ".fz", "fullcat"), (0, 4, "/a", "z", "", "segmap")]
    return spark.createDataFrame(cases, ARCHIVE)


def image(spark):
    return spark.createDataFrame([(i, 1, "g" if i != 8 else "Y", *[1.0] * 12, "N") for i in range(12)], IMAGE)


def test_usable_exposures(spark):
    assert [r.expnum for r in s.usable_exposures(exposure(spark)).collect()] == [0, 5, 9, 10, 11]


def test_box_is_half_open_or_open(spark):
    assert [r.expnum for r in s.select_exposures(exposure(spark), BOX).collect()] == [0, 5, 9]
    assert [r.expnum for r in s.select_exposures(exposure(spark), BOX, "open").collect()] == [0, 5]
    with pytest.raises(ValueError):
        s.select_exposures(exposure(spark), BOX, "closed")


def test_text_loses_its_commas(spark):
    r = s.select_exposures(exposure(spark), BOX).orderBy("expnum").first()
    assert (r.field, r.object, r.program) == ("a b", "c", None)


def test_filepaths(spark):
    got = rows(s.select_filepaths(archive(spark), exposure(spark), BOX), "expnum", "ccdnum")
    assert got[:3] == [(0, 1, "g", "/a/D00000000_g_01.fits"), (0, 2, "g", None), (0, 3, "g", "/a/y.fits.fz")]
    assert [r[0] for r in got[3:]] == [5, 9]


def test_images_skip_the_exposure_quality_cuts(spark):
    got = [r.expnum for r in s.select_images(image(spark), exposure(spark), BOX).orderBy("expnum").collect()]
    assert got == [0, 3, 4, 5, 6, 7, 9]


def test_merge_reimposes_them(spark):
    e, a, i = exposure(spark), archive(spark), image(spark)
    m = s.merge_selection(s.select_exposures(e, BOX), s.select_images(i, e, BOX), s.select_filepaths(a, e, BOX))
    assert [(r.EXPNUM, r.CCDNUM) for r in m.orderBy("EXPNUM").collect()] == [(0, 1), (5, 1), (9, 1)]
    assert len(set(m.columns)) == len(m.columns) and m.columns[:4] == ["EXPNUM", "EXPRA", "EXPDEC", "EXPTIME"]
    assert "FILEPATH" in m.columns and m.columns.count("BAND") == 1


def test_survey_selection_takes_each_exposure_once(spark):
    got = s.select_survey_images(exposure(spark), archive(spark), image(spark), tiles.survey_tiles(spark))
    located = tiles.assign_tiles(exposure(spark), tiles.survey_tiles(spark))
    assert got.count() == s.usable_exposures(located).count()


def test_filters_reach_the_scan(spark, tmp_path):
    exposure(spark).write.parquet(str(tmp_path / "e"))
    plan = plan_of(s.select_exposures(spark.read.parquet(str(tmp_path / "e")), BOX))
    assert "GreaterThanOrEqual(radeg,170.0)" in plan and "In(band, [g,i,r,z])" in plan
    # A file-path query reads no other exposure columns than it filters on and returns.
    paths = plan_of(s.select_filepaths(archive(spark), spark.read.parquet(str(tmp_path / "e")), BOX))
    assert "ReadSchema: struct<expnum:bigint,radeg:double,decdeg:double,glat:double,exptime:double,band:string>" in paths


def test_in_pixels(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 5)], "id int, hpix bigint")
    pixels = spark.createDataFrame([(5,), (5,), (7,)], "p bigint")
    assert sorted(r.id for r in s.in_pixels(df, pixels).collect()) == [1, 3]


# ---- tiles ----

def test_tile_table(spark):
    once = tiles.survey_tiles(spark)
    assert once.count() == 216
    by_index = {r["index"]: tuple(r)[1:] for r in once.collect()}
    # Spot rows of the table, among them those of the bands it lists twice, and the polar band.
    assert by_index[0] == (350.0, 360.0, -7.315642, 2.705224)
    assert by_index[35] == (0.0, 10.0, -7.315642, 2.705224)
    assert by_index[36] == (348.0, 360.0, -15.82973, -7.315642)
    assert by_index[192] == (340.0, 360.0, -55.63587, -47.57836)
    assert by_index[263] == (0.0, 30.0, -90.0, -70.35988)
    assert {r["index"] for r in once.collect()} == set(range(264)) - set(range(66, 96)) - set(range(210, 228))


def test_tiles_have_the_same_area(spark):
    from skycal.functions.sky import box_area

    t = tiles.survey_tiles(spark)
    area = t.select(box_area(F.col("ramin"), F.col("ramax"), F.col("decmax"), F.col("decmin")).alias("a"))
    assert area.where("abs(a - 100) > 0.01").count() == 0


def test_generated_tiles_reproduce_the_survey(spark):
    t = tiles.survey_tiles(spark)
    made = tiles.make_tiles(t.select("decmin", "decmax").distinct(), 100.0)
    box = ["ramin", "ramax", "decmin", "decmax"]
    assert made.count() == 216 and made.select(*box).exceptAll(t.select(*box)).count() == 0


def test_assignment_on_the_edges(spark):
    pts = [(0, 0.0, 0.0), (1, 9.999, 2.705223), (2, 10.0, -7.315642), (3, 359.99, 0.0), (4, 360.0, 0.0),
           (5, 5.0, 2.705224), (6, 5.0, -90.0), (7, 30.0, -70.35988), (8, 5.0, 50.0), (9, None, 0.0), (10, 12.0, -15.82973)]
    df = spark.createDataFrame(pts, "id int, radeg double, decdeg double")
    got = {r.id: r.tile for r in tiles.assign_tiles(df, tiles.survey_tiles(spark)).collect()}
    assert got == {0: 35, 1: 35, 2: 34, 3: 0, 6: 263, 7: 250, 10: 64}


def test_assignment_is_a_hash_join(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("radeg"), F.lit(0.0).alias("decdeg"))
    plan = plan_of(tiles.assign_tiles(df, tiles.survey_tiles(spark)), "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_million_tiles_are_not_broadcast_by_hint(spark):
    bands = spark.range(900).selectExpr("-45D + id * 0.1D AS decmin", "-44.9D + id * 0.1D AS decmax")
    made = tiles.make_tiles(bands, area=0.02).withColumn("index", F.struct("decmin", "strip"))
    df = spark.range(10).select((F.col("id") * 7.7).alias("radeg"), F.lit(-0.05).alias("decdeg"))
    placed = tiles.assign_tiles(df, made)
    assert "broadcast" not in plan_of(placed, "extended").split("== Physical Plan ==")[0].lower()
    assert placed.count() == 10 and made.count() > 1_000_000


def test_a_band_without_height_raises(spark):
    with pytest.raises(Exception, match="decmin < decmax"):
        tiles.make_tiles(spark.createDataFrame([(5.0, 5.0)], "decmin double, decmax double")).collect()


def test_selection_in_one_pass_is_the_same(spark):
    e, a, i = exposure(spark), archive(spark), image(spark)
    exposures = s.select_exposures(e, BOX)
    both = s.with_files(exposures, a, i), s.merge_selection(exposures, s.select_images(i, e, BOX), s.select_filepaths(a, e, BOX))
    assert both[0].columns == both[1].columns and rows(both[0], "EXPNUM", "CCDNUM") == rows(both[1], "EXPNUM", "CCDNUM")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(s.select_survey_images(e, a, i, tiles.survey_tiles(spark)), "simple")
        assert plan.count("Exchange hashpartitioning") <= 6 and plan.count("SortMergeJoin") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- names ----

def test_path_functions(spark):
    df = spark.createDataFrame([("/a/b/D00827408_i_48_r1p1_fullcat.fits",), ("/a/D00827408_i_48_r1p1_fullcat.fits.fz",),
                                ("short.fits",), (".hidden",), ("a..b",), (None,)], "p string")
    base = names.base_name(F.col("p"))
    got = rows(df.select(base, names.strip_extension(base), names.band_from_path(F.col("p")), names.expnum_from_name(base)))
    assert got == [
        ("D00827408_i_48_r1p1_fullcat.fits", "D00827408_i_48_r1p1_fullcat", "i", 827408),
        ("D00827408_i_48_r1p1_fullcat.fits.fz", "D00827408_i_48_r1p1_fullcat.fits", "8", 827408),
        ("short.fits", "short", None, None), (".hidden", ".hidden", None, None), ("a..b", "a.", None, None),
        (None, None, None, None)]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert names.upper_columns(df).columns == ["A", "B"]
    assert names.suffix_columns(df, "_1").columns == ["A_1", "B_1"]
    twice = df.join(df.withColumnRenamed("b", "c"), "a").select("a", "b", F.col("c").alias("B"))
    assert rows(names.first_of_duplicates(twice)) == [(1, 2)]


def test_merge_keeps_the_left_column(spark):
    left = spark.createDataFrame([(1, "left")], "k int, v string")
    right = spark.createDataFrame([(1, "right", 5)], "k int, V string, w int")
    m = names.merge_keep_left(left, right, ["k"])
    assert m.columns == ["k", "v", "w"] and rows(m) == [(1, "left", 5)]
