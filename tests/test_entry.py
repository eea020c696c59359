import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from helpers import plan_of
from skycal.plans import queries as q
from skycal.plans.calibrate import calibrate
from skycal.plans.proxy import object_catalog, star_catalog, table

TABLES = ("part", "lineitem", "orders", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(q.QUERIES) == set(q.ORACLES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["exp_img_file_merge", "tile_exposure_count", "refcat_prune", "xmatch_first", "match_id",
                                  "zero_points", "hist_log", "calibrate"])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(cur.fetchall(), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got == want and got


def test_flagship_entry(spark):
    df = entry.entry(spark)
    assert "MAG_ZERO_MEDIAN" in df.columns and df.count() > 0


def test_derived_sky_has_the_worked_out_counts(spark):
    # Counted independently by brute force when the derived sky was designed.
    stars, obs = table(spark, SF_DIR, "star"), table(spark, SF_DIR, "obs")
    assert (stars.count(), obs.count()) == (239, 4599)
    first = q.xmatch_first(spark, SF_DIR)
    assert first.count() == 3785 and first.where("RA_2 > 180").count() == 1836
    near = q.xmatch_nearest(spark, SF_DIR).withColumnRenamed("STAR_ID_1", "near")
    assert first.join(near.select("OBS_ID_2", "near"), "OBS_ID_2").where("near <> STAR_ID_1").count() == 241


def test_calibration_parts(spark):
    objects, metadata = q._field(spark, SF_DIR)
    run = calibrate(*metadata, object_catalog(objects), star_catalog(table(spark, SF_DIR, "star")),
                    q.tiles.survey_tiles(spark), bands=("g", "r"))
    assert {r.BAND for r in run.images.select("BAND").distinct().collect()} <= {"g", "r"}
    files = run.images.count()
    assert 0 < run.zero_points.count() <= files
    # No zero point without matches, and medians of image columns come along.
    assert run.zero_points.join(run.matched, ["FILENAME_2"], "left_anti").count() == 0
    assert {"RA_CENT_2_MEDIAN", "DEC_CENT_2_MEDIAN", "G_1_MEDIAN", "FLUX_APER_08_2_MEDIAN"} <= set(run.zero_points.columns)


def test_no_plan_pairs_everything_with_everything(spark):
    for name in ["xmatch_first", "xmatch_nearest", "tile_assign", "hpix_in_list", "refcat_prune", "hist_auto", "grid_cross",
                 "flag_exposures", "exp_img_file_merge"]:
        plan = plan_of(entry.queries()[name](spark, SF_DIR), "simple")
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_calibration_resumes_from_stored_steps(spark, tmp_path):
    objects, metadata = q._field(spark, SF_DIR)
    inputs = (*metadata, object_catalog(objects), star_catalog(table(spark, SF_DIR, "star")), q.tiles.survey_tiles(spark))
    first = calibrate(*inputs, all_medians=False, store=str(tmp_path))
    assert (tmp_path / "matched").is_dir() and any((tmp_path / "matched").glob("BAND_2=*/TILE_2=*"))
    again = calibrate(*inputs, all_medians=False, images=first.images, matched=first.matched)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(again.zero_points) == key(first.zero_points) and first.zero_points.count() > 0
