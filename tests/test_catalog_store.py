import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import left_after, plan_of, rows, shuffle_blocks
from skycal.operators import catalog, refcat
from skycal.schemas import OBJECT_CATALOG
from skycal.sources import catalog_store as cs

FILES = [(f"/arch/{k % 3}/D{k:08d}_{'gr'[k % 2]}_01_r1p1_fullcat.fits", "gr"[k % 2], k % 5) for k in range(30)]


@pytest.fixture(scope="module")
def sky(spark):
    objects = [(f, n, 1.0, 2.0, 10.0 * k + n, -5.0, 10.0, 0.1, [1.0] * 12, [0.1] * 12, 1.0, 0.0, 0.0, 0)
               for k, (f, _, _) in enumerate(FILES) for n in range(4)]
    images = spark.createDataFrame([(f, b, t, k) for k, (f, b, t) in enumerate(FILES)], "FILEPATH string, BAND string, TILE int, EXPNUM bigint")
    return catalog.flatten_catalog(spark.createDataFrame(objects, OBJECT_CATALOG)), images


def test_only_listed_units_and_files_are_opened(spark, sky, tmp_path):
    objects, images = sky
    cs.write_unit_catalogs(objects, images, f"{tmp_path}/units")
    everything = spark.read.parquet(f"{tmp_path}/units")
    everything.collect()
    whole = cs.files_read(everything)
    assert whole >= 10 and everything.count() == 120
    listed = images.where("BAND = 'g' AND TILE = 2")
    found = cs.read_unit_catalogs(spark, f"{tmp_path}/units", listed)
    got = rows(found.select("EXPNUM", "NUMBER"), "EXPNUM", "NUMBER")
    assert got == [(k, n) for k, (_, b, t) in enumerate(FILES) if b == "g" and t == 2 for n in range(4)]
    assert len(found.collect()) == len(got)
    read = cs.files_read(found)
    assert 1 <= read <= 2 < whole
    plan = plan_of(found)
    assert "PartitionFilters" in plan and "GreaterThanOrEqual(FILENAME" in plan
    # one image of a unit; one that is not there; none at all
    one = cs.read_unit_catalogs(spark, f"{tmp_path}/units", images.where("EXPNUM = 12"))
    assert rows(one.select("NUMBER"), "NUMBER") == [(0,), (1,), (2,), (3,)]
    absent = cs.read_unit_catalogs(spark, f"{tmp_path}/units", spark.createDataFrame([("g", 99, "x.fits")], "BAND string, TILE int, FILENAME string"))
    assert absent.collect() == [] and cs.files_read(absent) == 0
    none = cs.read_unit_catalogs(spark, f"{tmp_path}/units", images.limit(0))
    assert none.collect() == [] and cs.files_read(none) == 0


def test_conditions_on_units(spark):
    df = spark.createDataFrame([("g", 1), ("g", 2), ("r", 1), ("r", None), (None, 1)], "BAND string, TILE int")
    chosen = lambda units: sorted(map(tuple, df.where(cs.in_units(units)).collect()), key=repr)
    assert chosen([("g", 1), ("r", None)]) == [("g", 1), ("r", None)]
    assert chosen([]) == [] and chosen([(None, 1)]) == [(None, 1)]
    assert cs.units_of(df) == [(None, 1), ("g", 1), ("g", 2), ("r", None), ("r", 1)]


def test_a_crowded_unit_has_several_files(spark, sky, tmp_path):
    objects, images = sky
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cs.write_unit_catalogs(objects, images.withColumn("TILE", F.lit(1)).withColumn("BAND", F.lit("g")), f"{tmp_path}/one")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    df = spark.read.parquet(f"{tmp_path}/one")
    ends = df.groupBy(F.input_file_name()).agg(F.min("FILENAME").alias("a"), F.max("FILENAME").alias("b")).orderBy("a").collect()
    assert len(ends) > 1 and all(x.b <= y.a for x, y in zip(ends, ends[1:]))


def test_named_files(spark, tmp_path):
    schema = OBJECT_CATALOG
    for k in range(6):
        spark.createDataFrame([(None, k, *[1.0] * 6, [1.0], [2.0], 1.0, 0.0, 0.0, 0)], schema).drop("FILENAME").coalesce(1).write.parquet(f"{tmp_path}/{k}")
    names = [r.f for r in spark.read.parquet(*[f"{tmp_path}/{k}" for k in range(6)]).select(F.col("_metadata.file_name").alias("f"), "NUMBER").orderBy("NUMBER").collect()]
    listed = spark.createDataFrame([(names[1],), (names[4],), (names[4],), ("gone.parquet",), (None,)], "FILENAME string")
    found, missing = cs.read_named_files(spark, str(tmp_path), listed, schema)
    assert rows(found.select("FILENAME", "NUMBER"), "NUMBER") == [(names[1], 1), (names[4], 4)]
    run = found.select("NUMBER")
    run.collect()
    assert cs.files_read(run) == 2 and rows(missing) == [("gone.parquet",)]
    found, missing = cs.read_named_files(spark, str(tmp_path), listed.where("FILENAME = 'gone.parquet'"), schema)
    assert found.collect() == [] and rows(missing) == [("gone.parquet",)]


def test_joins_of_buckets_move_no_object(spark, sky, tmp_path):
    objects, images = sky
    cs.write_bucketed(objects, "test_bucketed_objects", f"{tmp_path}/buckets", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = cs.attach_bucketed(spark, "test_bucketed_objects", images)
        plan = plan_of(joined, "simple")
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan
        objects_side = plan[plan.index("FileScan parquet") - 200:plan.index("FileScan parquet")]
        assert "Exchange" not in objects_side
        # Groups by image move nothing at all.
        assert "Exchange" not in plan_of(spark.table("test_bucketed_objects").groupBy("FILENAME").count(), "simple")
        assert joined.count() == 120 and joined.where("BAND = 'g'").count() == 60
        assert rows(cs.attach_bucketed(spark, "test_bucketed_objects", images, "r").select("NUMBER").distinct(), "NUMBER") == [(0,), (1,), (2,), (3,)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.sql("DROP TABLE test_bucketed_objects")


def test_a_table_of_many_buckets_is_dealt_in_rounds(spark, tmp_path):
    """All rows, those without a key and copies too, in one file for each bucket; each round is a write of its own, whose shuffle files go."""
    data = [(f"f{k % 50}.fits" if k % 11 else None, k // 2 % 97, float(k)) for k in range(3000)] + [("f1.fits", 1, 1.0)] * 40
    df = spark.createDataFrame(data, "FILENAME string, RA int, X double").repartition(3)
    before = shuffle_blocks(spark)
    try:
        cs.write_bucketed(df, "test_rounds", f"{tmp_path}/rounds", 48)
        assert left_after(spark, before) == set()
        assert sorted(map(tuple, spark.table("test_rounds").collect()), key=repr) == sorted(data, key=repr)
        files = [p.name for p in (tmp_path / "rounds").glob("*.parquet")]
        write, bucket = ({n[11:47] for n in files}, [n[48:53] for n in files])
        assert len(write) == 3 and len(set(bucket)) == len(bucket) > 16
        grouped = spark.table("test_rounds").groupBy("FILENAME").count()
        assert "Exchange" not in plan_of(grouped, "simple") and grouped.count() == 51
    finally:
        spark.sql("DROP TABLE IF EXISTS test_rounds")


def test_a_round_that_fails_takes_the_others_back(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").cast("string").alias("FILENAME"), F.col("id").alias("RA"))
    last = F.pmod(F.hash("FILENAME"), F.lit(32)) % 2 == 1
    broken = df.withColumn("RA", F.when(last, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("RA")))
    with pytest.raises(Exception, match="lost"):
        cs.write_bucketed(broken, "test_broken", f"{tmp_path}/broken", 32)
    assert not spark.catalog.tableExists("test_broken")
    cs.write_bucketed(df, "test_broken", f"{tmp_path}/broken", 32)
    cs.write_bucketed(df.limit(5), "test_broken", f"{tmp_path}/broken", 32, mode="append")
    assert spark.table("test_broken").count() == 2005
    spark.sql("DROP TABLE test_broken")


def test_pruning_by_objects_loses_no_match(spark):
    """Objects at the poles, over RA 0 and at borders and corners of pixels, each with a star within the tolerance."""
    rng = random.Random(3)
    spots = [(rng.uniform(0, 360), rng.uniform(-90, 90)) for _ in range(300)] + [(rng.uniform(0, 360), s * rng.uniform(86, 90)) for s in (1, -1) for _ in range(100)]
    spots += [(45.0 * k, 41.8103149) for k in range(8)] + [(0.0, float(d)) for d in range(-88, 90, 4)] + [(359.99999, 5.0), (1e-6, 5.0)]
    stars, objects = [], []
    for k, (ra, dec) in enumerate(spots):
        a, r = rng.uniform(0, 2 * math.pi), 1.9 / 3600
        objects.append((ra, dec, k))
        s_dec = max(-90.0, min(90.0, dec + r * math.sin(a)))
        stars.append(((ra + r * math.cos(a) / max(math.cos(math.radians(dec)), 1e-3)) % 360, s_dec, k))
    observed = spark.createDataFrame(objects, "RA double, DEC double, N int")
    catalogue = spark.createDataFrame(stars, "RA double, DEC double, N int")
    kept = refcat.prune_reference(catalogue, None, decimals=None, pixels=refcat.object_pixels(observed))
    assert kept.count() == len(stars)
    # Object by object, its own pixels hold its star.
    own = refcat.object_pixels(observed, ["N"])
    pairs = refcat.with_pixel(catalogue).select("N", "hpx8").join(own, ["N", "hpx8"], "left_semi")
    assert pairs.count() == len(stars)


def test_the_number_of_buckets_grows_with_the_table(spark):
    few, many = spark.range(1000).withColumn("x", F.lit(1.0)), spark.range(16_000).withColumn("x", F.lit(1.0))
    assert [cs.buckets_for(df, least=2, cells=100) for df in (few, many)] == [32, 512]
    assert cs.buckets_for(few, least=16) == 16 and cs.buckets_for(few.limit(0)) == 1
