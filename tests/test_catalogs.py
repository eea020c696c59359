import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from skycal.functions.numeric import nan_to_null, numeric_columns, require_columns, round_fractions
from skycal.operators import catalog, refcat
from skycal.operators.materialize import materialize, shared_folder
from skycal.schemas import EXPOSURE_QA, OBJECT_CATALOG, REFCAT, TILES
from skycal.sources import sinks, tables
from skycal.sources.fits import read_fits_catalogs, table_of

NAN = float("nan")


def objects(spark):
    def row(name, number, ra, aper, err):
        return (name, number, 1.0, 2.0, ra, -5.0, 10.0, NAN, aper, err, 1.0, 0.0, 0.0, 0)

    return spark.createDataFrame([
        row("/x/a.fits", 1, 180.0, [float(i) for i in range(12)], [0.5] * 3),
        row("/x/a.fits", 2, 180.001, [NAN] * 12, []),
        row("/x/b.fits", 3, 359.9999, None, [1.0] * 12)], OBJECT_CATALOG)


def test_flatten(spark):
    flat = catalog.flatten_catalog(objects(spark))
    assert flat.columns[:7] == ["FILENAME", "NUMBER", "X_IMAGE", "Y_IMAGE", "RA_WRAP", "RA", "DEC"]
    assert len(flat.columns) == 37
    r = {x.NUMBER: x for x in flat.collect()}
    assert r[1].FILENAME == "a.fits" and r[1].FLUXERR_PSF is None
    assert [r[1][f"FLUX_APER_{k:02d}"] for k in range(1, 13)] == [float(i) for i in range(12)]
    assert [r[1][f"FLUXERR_APER_{k:02d}"] for k in (1, 3, 4, 12)] == [0.5, 0.5, None, None]
    assert r[2].FLUX_APER_01 is None and r[2].FLUXERR_APER_01 is None and r[3].FLUX_APER_12 is None
    assert [r[i].RA_WRAP for i in (1, 2, 3)] == pytest.approx([180.0, -179.999, -0.0001])


def test_flatten_reads_only_what_is_asked(spark, tmp_path):
    objects(spark).write.parquet(str(tmp_path / "o"))
    flat = catalog.flatten_catalog(spark.read.parquet(str(tmp_path / "o"))).select("RA", "FLUX_APER_08")
    assert "ReadSchema: struct<ALPHAWIN_J2000:double,FLUX_APER:array<double>>" in plan_of(flat)


def test_stack_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2.5, 2)], "b double, id int")
    assert rows(catalog.stack_catalogs([a, b]).select("id", "a", "b"), "id") == [(1, "x", None), (2, None, 2.5)]


def images(spark):
    return spark.createDataFrame([("/x/a.fits", "g", 7), ("/x/c.fits", "g", 8), ("/x/b.fits", "r", 9)],
                                 "FILEPATH string, BAND string, EXPNUM int")


def test_attach_metadata(spark):
    flat = catalog.flatten_catalog(objects(spark))
    got = catalog.attach_metadata(flat, images(spark))
    assert rows(got.select("NUMBER", "EXPNUM", "BAND"), "NUMBER") == [(1, 7, "g"), (2, 7, "g"), (3, 9, "r")]
    assert got.columns.count("FILENAME") == 1
    assert catalog.attach_metadata(flat, images(spark), "r").count() == 1
    assert rows(catalog.missing_catalogs(flat, images(spark))) == [("c.fits",)]


def test_attach_before_or_after_matching_is_the_same(spark):
    from skycal.functions.names import suffix_columns

    flat = catalog.flatten_catalog(objects(spark))
    before = suffix_columns(catalog.attach_metadata(flat, images(spark)), "_2")
    after = catalog.attach_to_matches(suffix_columns(flat, "_2"), images(spark))
    assert sorted(before.columns) == sorted(after.columns)
    assert rows(before.select(*sorted(before.columns)), "NUMBER_2") == rows(after.select(*sorted(before.columns)), "NUMBER_2")


def test_objects_of_listed_images(spark):
    flat = catalog.flatten_catalog(objects(spark))
    one = images(spark).where("EXPNUM = 9")
    assert catalog.of_images(flat, one).count() == 1
    assert "BroadcastHint" not in plan_of(catalog.of_images(flat, one), "extended")


# ---- reference catalogue ----

def stars(spark):
    return spark.createDataFrame([(10.12345678, 5.0, 18.0), (200.0, -40.00000049, 17.1234567), (359.0, 80.0, None)],
                                 "RA double, Dec double, G double")


def footprints(spark):
    return spark.createDataFrame([(10.0, 4.9, 10.2, 4.9, 10.2, 5.1, 10.0, 5.1, 10.1, 5.0),
                                  (200.0, -40.0, 200.1, -40.0, 200.1, -40.1, None, None, 200.0, -40.0)],
                                 "RAC1 double, DECC1 double, RAC2 double, DECC2 double, RAC3 double, DECC3 double, "
                                 "RAC4 double, DECC4 double, RA_CENT double, DEC_CENT double")


def test_prune(spark):
    got = refcat.prune_reference(stars(spark), footprints(spark)).orderBy("RA").collect()
    assert [(r.RA, r.DEC, r.RA_WRAP, r.G) for r in got] == [
        (10.123457, 5.0, 10.123457, 18.0), (200.0, -40.0, -160.0, 17.123457)]
    exact = refcat.prune_reference(stars(spark), footprints(spark), decimals=None).orderBy("RA").first()
    assert exact.RA == 10.12345678
    assert refcat.image_pixels(footprints(spark)).count() == 2


def test_prune_skips_partitions_and_missing_ones_are_reported(spark, tmp_path):
    path = str(tmp_path / "refcat")
    sinks.write_refcat(stars(spark).withColumnRenamed("Dec", "DEC"), path)
    stored = tables.read_table(spark, path)
    assert refcat.PIXEL in stored.columns
    pruned = refcat.prune_reference(stored, footprints(spark))
    assert pruned.count() == 2
    # The images come from a filtered table, as they do in a survey: pruning happens at run time.
    footprints(spark).write.parquet(str(tmp_path / "images"))
    some = spark.read.parquet(str(tmp_path / "images")).where("RAC1 > 100")
    assert "dynamicpruning" in plan_of(refcat.prune_reference(stored, some)).lower()
    assert refcat.prune_reference(stored, some).count() == 1
    assert refcat.missing_pixels(stored.where("RA < 100"), footprints(spark)).count() == 1
    assert refcat.missing_pixels(stored, footprints(spark)).count() == 0


# ---- whole-frame helpers, readers and writers ----

def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(NAN, [1.0, NAN], "x"), (1.0, None, None)], "a double, v array<double>, s string")
    assert rows(nan_to_null(df)) == [(None, [1.0, None], "x"), (1.0, None, None)]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 1.23456, "x")], "a int, b double, c string")
    assert numeric_columns(df) == ["a", "b"]
    require_columns(df, ["A", "b"])
    with pytest.raises(ValueError, match="d, e"):
        require_columns(df, ["a", "d", "e"])
    assert rows(round_fractions(df, 2)) == [(1, 1.23, "x")]
    assert EXPOSURE_QA.names[-3:] == ["hpix", "t_eff", "astrom_chi2"] and len(REFCAT) == 11 and len(TILES) == 5


def test_csv_round_trip_with_fixed_decimals(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.00004, "a,b", "g"), (2, None, 'q"q', "r"), (3, 2.0, None, "r")],
                               "id int, x double, s string, band string")
    sinks.write_csv(df, str(tmp_path / "csv"), decimals=4, partition_by=["band"])
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("band=*/part-*.csv"))
    assert "1.0000" in text and "2.0000" in text and "id,x,s" in text and '"a,b"' in text
    back = spark.read.option("header", True).option("escape", "\\").schema("id int, x double, s string").csv(
        str(tmp_path / "csv") + "/band=*")
    assert rows(back.select("id", "x"), "id") == [(1, 1.0), (2, None), (3, 2.0)]


def test_csv_reader_checks_schema_and_prunes(spark, tmp_path):
    (tmp_path / "t.csv").write_text("index,ramin,ramax,decmin,decmax\n0,350,360,-7.3,2.7\n1,340,350,NaN,2.7\n")
    df = tables.read_table(spark, str(tmp_path / "t.csv"), TILES, "csv")
    assert rows(df.select("index", "decmin"), "index") == [(0, -7.3), (1, None)]
    inferred = tables.read_table(spark, str(tmp_path / "t.csv"), fmt="csv")
    assert [f.dataType.simpleString() for f in inferred.schema][:2] == ["int", "int"]
    assert "ReadSchema: struct<index:int,decmin:double>" in plan_of(df.select("index", "decmin"))


def test_catalog_reader_names_rows_after_their_file(spark, tmp_path):
    objects(spark).where("NUMBER = 1").coalesce(1).write.parquet(str(tmp_path / "cats"))
    name = next((tmp_path / "cats").glob("part-*.parquet")).name
    df = tables.read_catalogs(spark, str(tmp_path / "cats"), OBJECT_CATALOG)
    assert rows(df.select("FILENAME", "NUMBER")) == [(name, 1)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_catalogs(spark, str(tmp_path / "gone"), OBJECT_CATALOG)


def test_listed_catalogs_are_read_and_absent_ones_told(spark, tmp_path):
    for n in (1, 2):
        objects(spark).where(f"NUMBER = {n}").coalesce(1).write.parquet(str(tmp_path / f"exp={n}"))
    first = next((tmp_path / "exp=1").glob("part-*.parquet")).name
    listed = spark.createDataFrame([(first,), ("absent.parquet",), (None,), (first,)], "FILENAME string")
    got = tables.read_listed_catalogs(spark, [str(tmp_path / f"exp={n}") for n in (1, 2)], listed, OBJECT_CATALOG)
    assert rows(got.rows.select("FILENAME", "NUMBER")) == [(first, 1)] and rows(got.missing) == [("absent.parquet",)]


def test_tile_table_from_a_file(spark, tmp_path):
    (tmp_path / "tiles.csv").write_text("index,ramin,ramax,decmin,decmax\n7,0,10,-5,5\n3,0,10,-5,5\n4,10,20,-5,5\n")
    assert sorted(tuple(r) for r in tables.read_tiles(spark, str(tmp_path / "tiles.csv")).collect()) == [(3, 0.0, 10.0, -5.0, 5.0), (4, 10.0, 20.0, -5.0, 5.0)]


def test_partitioned_tables_have_about_a_file_each(spark, tmp_path):
    df = spark.range(20_000).repartition(8).selectExpr("id", "id % 5 AS band", "id % 3 AS tile")
    sinks.write_table(df, str(tmp_path / "t"), ["band", "tile"])
    files = list((tmp_path / "t").glob("*/*/*.parquet"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000 and 15 <= len(files) <= 30


def test_ordered_csv(spark, tmp_path):
    df = spark.range(1000).repartition(7).selectExpr("(id * 617) % 1000 AS k")
    sinks.write_csv(df, str(tmp_path / "o"), order=["k"])
    lines = [x for f in sorted((tmp_path / "o").glob("*.csv")) for x in f.read_text().split()[1:]]
    assert [int(x) for x in lines] == list(range(1000))


def test_jdbc_reader_is_partitioned(spark):
    from unittest.mock import MagicMock

    session = MagicMock()
    tables.read_jdbc(session, "jdbc:x", "exposure", "expnum", (0, 100), 8, user="u")
    options = session.read.format.return_value.options.call_args.kwargs
    assert options["partitionColumn"] == "expnum" and options["numPartitions"] == "8" and options["user"] == "u"


def test_materialize_uses_the_session_folder(spark, tmp_path):
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert df.where("x = 6").count() == 1
    assert "FileScan parquet" in plan_of(df, "simple")
    assert shared_folder(spark) == shared_folder(spark)


# ---- FITS ----

def card(key, value):
    text = f"{key:<8}= '{value}'" if isinstance(value, str) else f"{key:<8}= {value:>20}"
    return f"{text} / note".ljust(80).encode()


def unit(cards, data=b""):
    head = b"".join(card(k, v) for k, v in cards) + b"END".ljust(80)
    pad = lambda b, fill: b + fill * (-len(b) % 2880)
    return pad(head, b" ") + pad(data, b"\0")


def fits_file(rows_):
    """A primary unit, a small image-header table, and a catalogue table, the layout catalogues come in."""
    fmt = ">i4dddd" + "ff" + "12f" + "12f" + "fff" + "h"
    names_ = ["NUMBER", "X_IMAGE", "Y_IMAGE", "ALPHAWIN_J2000", "DELTAWIN_J2000", "FLUX_PSF", "FLUXERR_PSF",
              "FLUX_APER", "FLUXERR_APER", "CLASS_STAR", "SPREAD_MODEL", "SPREADERR_MODEL", "FLAGS"]
    forms = ["1J", "1D", "1D", "1D", "1D", "1E", "1E", "12E", "12E", "1E", "1E", "1E", "1I"]
    s = struct.Struct(fmt.replace("i4", "i"))
    data = b"".join(s.pack(*r) for r in rows_)
    table = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", s.size), ("NAXIS2", len(rows_)),
             ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(names_))]
    for i, (n, f) in enumerate(zip(names_, forms), 1):
        table += [(f"TTYPE{i}", n), (f"TFORM{i}", f)]
    header = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", 100), ("NAXIS2", 1), ("PCOUNT", 0),
              ("GCOUNT", 1), ("TFIELDS", 1), ("TTYPE1", "Field Header Card"), ("TFORM1", "100A")]
    return unit([("SIMPLE", "T"), ("BITPIX", 16), ("NAXIS", 0)]) + unit(header, b"x" * 100) + unit(table, data)


def test_fits_catalogs(spark, tmp_path):
    make = lambda n, ra: (n, 1.5, 2.5, ra, -3.0, 11.0, float("nan"), *[float(k) for k in range(12)], *[0.25] * 12, 0.9, 0.001, 0.002, 3)
    (tmp_path / "D00000001_g_01_r1p1_fullcat.fits").write_bytes(fits_file([make(1, 10.0), make(2, 190.0)]))
    (tmp_path / "D00000002_g_01_r1p1_fullcat.fits").write_bytes(fits_file([make(7, 20.0)]))
    df = read_fits_catalogs(spark, str(tmp_path))
    flat = catalog.flatten_catalog(df)
    got = rows(flat.select("FILENAME", "NUMBER", "RA", "RA_WRAP", "FLUX_APER_08", "FLUXERR_PSF", "FLAGS"), "NUMBER")
    assert got == [("D00000001_g_01_r1p1_fullcat.fits", 1, 10.0, 10.0, 7.0, None, 3),
                   ("D00000001_g_01_r1p1_fullcat.fits", 2, 190.0, -170.0, 7.0, None, 3),
                   ("D00000002_g_01_r1p1_fullcat.fits", 7, 20.0, 20.0, 7.0, None, 3)]


def test_a_file_that_is_no_catalogue_raises(spark, tmp_path):
    (tmp_path / "x.fits.fz").write_bytes(b"not a table" * 100)
    with pytest.raises(Exception, match="header without END"):
        read_fits_catalogs(spark, str(tmp_path)).collect()


def test_fits_table_bytes():
    t = table_of(fits_file([]), 2)
    assert len(t) == 0 and t.dtype["FLUX_APER"].shape == (12,)
    assert table_of(fits_file([]), 1)["Field Header Card"][0] == b"x" * 100
    assert np.dtype(t.dtype["ALPHAWIN_J2000"]).byteorder == ">"
