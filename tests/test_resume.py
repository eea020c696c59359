import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from helpers import left_after, shuffle_blocks
from skycal.operators.materialize import materialize
from skycal.operators.matchid import match_ids
from skycal.operators.tiles import survey_tiles
from skycal.plans import resume
from skycal.plans.calibrate import calibrate
from skycal.plans.proxy import object_catalog, star_catalog, table
from skycal.plans.resume import calibrate_changed

OPTIONS = {"all_medians": False}


@pytest.fixture(scope="module")
def survey(spark):
    objects = materialize(table(spark, SF_DIR, "field_obs"), "field_obs")
    exposure, archive, image = (materialize(table(spark, SF_DIR, f"field_{t}", {"field_obs": objects}), t) for t in ("exposure", "archive", "image"))
    return [exposure, archive, image, object_catalog(objects), star_catalog(materialize(table(spark, SF_DIR, "star"), "star")), survey_tiles(spark)]


def told(run):
    return sorted(tuple(r) for r in run.zero_points.select(*sorted(run.zero_points.columns)).collect())


def statuses(run):
    return {(r.BAND, r.TILE): r.status for r in run.units.collect()}


def folders(path):
    return {f"{p.parent.name}/{p.name}": sorted((f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet")) for p in path.glob("zero_points/BAND_2=*/TILE_2=*")}


def units_images(spark, inputs):
    return materialize(resume.select_survey_images(*inputs[:3], inputs[5]), "images")


def test_only_changed_units_are_run_again(spark, survey, tmp_path):
    exposure, archive, image, objects, stars, boxes = survey
    first = calibrate_changed(*survey, str(tmp_path / "a"), **OPTIONS)
    units, whole, before = statuses(first), told(first), folders(tmp_path / "a")
    assert len(units) > 5 and set(units.values()) == {"new"} and len(whole) > 5
    # Nothing has changed: nothing is written.
    again = calibrate_changed(*survey, str(tmp_path / "a"), **OPTIONS)
    assert set(statuses(again).values()) == {"kept"} and told(again) == whole and folders(tmp_path / "a") == before
    # One exposure's magnitudes move: its unit alone is redone, and all is as from scratch.
    name = first.zero_points.orderBy("FILENAME_2").first().FILENAME_2
    moved = objects.withColumn("FLUX_APER", F.when(F.col("FILENAME") == name, F.transform("FLUX_APER", lambda x: x * 1.5)).otherwise(F.col("FLUX_APER")))
    changed = [exposure, archive, image, moved, stars, boxes]
    redone = calibrate_changed(*changed, str(tmp_path / "a"), **OPTIONS)
    assert sorted(statuses(redone).values()) == ["changed"] + ["kept"] * (len(units) - 1)
    after = folders(tmp_path / "a")
    assert [u for u in before if before[u] != after[u]] == [u for u in before if u == "BAND_2={}/TILE_2={}".format(*next(k for k, v in statuses(redone).items() if v == "changed"))]
    scratch = calibrate_changed(*changed, str(tmp_path / "b"), **OPTIONS)
    assert told(redone) == told(scratch) != whole
    assert sorted(map(tuple, redone.matched.select("MATCHID", "NUMBER_2", "BAND_2", "TILE_2").collect())) == sorted(
        map(tuple, scratch.matched.select("MATCHID", "NUMBER_2", "BAND_2", "TILE_2").collect()))
    # An exposure that no image is selected of goes: nothing follows from it.
    chosen = {r.EXPNUM for r in units_images(spark, changed).select("EXPNUM").distinct().collect()}
    unused = next(r.expnum for r in exposure.select("expnum").collect() if r.expnum not in chosen)
    same = calibrate_changed(exposure.where(F.col("expnum") != unused), *changed[1:], str(tmp_path / "a"), **OPTIONS)
    assert set(statuses(same).values()) == {"kept"} and told(same) == told(scratch)
    # One with matches goes: its unit is redone without it, or is gone with all its rows.
    used = redone.matched.agg(F.min("EXPNUM_2")).first()[0]
    fewer = [exposure.where(F.col("expnum") != used), archive, image, moved, stars, boxes]
    less = calibrate_changed(*fewer, str(tmp_path / "a"), **OPTIONS)
    gone = fewer[0].select("expnum").collect()
    assert {r.EXPNUM_2 for r in less.matched.select("EXPNUM_2").distinct().collect()} <= {r.expnum for r in gone}
    assert sorted(set(statuses(less).values())) in (["changed", "kept"], ["gone", "kept"])
    # Other options are other fingerprints.
    told_of = lambda **o: {tuple(r) for r in resume.fingerprints(units_images(spark, fewer), moved, stars, o).collect()}
    assert not told_of(nsigma=2.0) & told_of(nsigma=3.0) and told_of(nsigma=2.0) == told_of(nsigma=2.0)
    # No exposure at all.
    none = calibrate_changed(exposure.limit(0), archive, image, moved, stars, boxes, str(tmp_path / "a"), **OPTIONS)
    assert told(none) == [] and set(statuses(none).values()) <= {"gone"}


def test_a_run_that_breaks_off_is_taken_up(spark, survey, tmp_path, monkeypatch):
    store = str(tmp_path / "s")
    whole = told(calibrate_changed(*survey, str(tmp_path / "whole"), **OPTIONS))
    part = [survey[0].where("expnum % 2 = 0"), *survey[1:]]
    calibrate_changed(*part, store, **OPTIONS)
    write, calls = resume._write_units, []

    def broken(df, path):
        calls.append(path)
        if path.endswith("zero_points"):
            raise OSError("lost")
        return write(df, path)

    monkeypatch.setattr(resume, "_write_units", broken)
    with pytest.raises(OSError, match="lost"):
        calibrate_changed(*survey, store, **OPTIONS)
    monkeypatch.undo()
    assert len(calls) == 2
    run = calibrate_changed(*survey, store, **OPTIONS)
    assert "new" in statuses(run).values() and told(run) == whole
    assert set(statuses(calibrate_changed(*survey, store, **OPTIONS)).values()) == {"kept"}


def test_an_empty_store_of_nothing(spark, survey, tmp_path):
    run = calibrate_changed(survey[0].limit(0), *survey[1:], str(tmp_path / "n"), **OPTIONS)
    assert run.zero_points.collect() == [] and run.units.collect() == []


def test_no_second_copy_of_the_matches_stays(spark, survey, tmp_path, monkeypatch):
    """The rows ordered to be numbered are gone when their matches are stored."""
    monkeypatch.setattr("skycal.operators.materialize.shared_folder", lambda spark: str(tmp_path / "shared"))
    run = calibrate_changed(*survey, str(tmp_path / "s"), **OPTIONS)
    labels = {p.name.rsplit("-", 5)[0] for p in tmp_path.glob("shared/skycal-*/*")}
    assert {"images", "units", "quality"} <= labels and not {"ordered", "offsets"} & labels
    assert run.matched.count() > 100 and run.zero_points.count() > 5
    # Without a folder the matches are still made of those rows.
    free = calibrate(*survey, **OPTIONS)
    assert free.matched.count() > 100
    assert "ordered" in {p.name.rsplit("-", 5)[0] for p in tmp_path.glob("shared/skycal-*/*")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_blocks(spark)
    kept = materialize(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "grouped")
    assert left_after(spark, before) == set() and kept.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_numbers_per_group(spark):
    df = spark.createDataFrame([(u, s, o) for u in ("b", None, "a") for s in (2.0, 1.0) for o in (5.0, 3.0)], "u string, s double, o double").repartition(4)
    got = sorted(map(tuple, match_ids(df, ["s"], ["o"], ["u"]).select("u", "MATCHID", "s", "o").collect()), key=repr)
    assert got == sorted([(u, k + 1, s, o) for u in ("b", None, "a") for k, (s, o) in enumerate([(1.0, 3.0), (1.0, 5.0), (2.0, 3.0), (2.0, 5.0)])], key=repr)


def test_numbers_within_groups_write_the_rows_once(spark, monkeypatch):
    """Groups that span partitions, share one, and lack a key: no second table of the rows is made to number them."""
    from skycal.operators import matchid
    written = []
    keep = matchid.materialize
    monkeypatch.setattr(matchid, "materialize", lambda df, label, **options: written.append((label, "x" in df.columns)) or keep(df, label, **options))
    data = [(u, s, s % 3, 1.5) for u, n in (("a", 400), (None, 7), ("b", 1), ("c", 90)) for s in range(n)]
    df = spark.createDataFrame(data, "u string, s int, o int, x double").repartition(5)
    got = match_ids(df, ["s"], ["o"], ["u"]).select("u", "s", "MATCHID").collect()
    assert sorted((r.u or "", r.s, r.MATCHID) for r in got) == sorted((u or "", s, s + 1) for u, s, _, _ in data)
    assert written == [("ordered", True), ("offsets", False)]
