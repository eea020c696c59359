"""Calibration that is kept by band and tile, and redone only where its input has changed."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skycal.functions.names import base_name
from skycal.operators.catalog import flatten_catalog
from skycal.operators.materialize import CODEC, compiled_methods, materialize, shuffles_dropped
from skycal.operators.refcat import PIXEL, object_pixels, with_pixel
from skycal.operators.selection import select_survey_images
from skycal.plans.calibrate import calibrate
from skycal.sources.catalog_store import in_units, units_of

UNIT = ["BAND", "TILE"]
STORED = ["BAND_2", "TILE_2"]


class Resumed(NamedTuple):
    zero_points: DataFrame     # one row per image of all units, kept and redone
    matched: DataFrame         # their matches; MATCHID counts in each unit
    units: DataFrame           # BAND, TILE, status: kept, new, changed or gone


def _told(df: DataFrame, *keys: str):
    """Number of rows and the sum of their hashes, by key: what changes if a row does, and not with their order."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return df.select(*keys, h.alias("_h")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_h").alias("s"))


def fingerprints(images: DataFrame, objects: DataFrame, refcat: DataFrame, options: dict, tol_arcsec: float = 2.0) -> DataFrame:
    """(BAND, TILE, fingerprint): a hash of everything that the results of a unit follow from: its images' rows, the objects of their
    catalogues, the reference stars of the pixels near them, and the options. Rows are hashed where they are read; what is
    shuffled is one sum per file, per pixel and per unit."""
    flat = flatten_catalog(objects)
    files = _told(flat, "FILENAME")
    pixels = _told(with_pixel(refcat.withColumnRenamed("Dec", "DEC")), PIXEL)
    own = _told(images, *UNIT).select(*UNIT, F.lit("images").alias("kind"), "n", "s")
    named = images.select(*UNIT, base_name(F.col("FILEPATH")).alias("FILENAME")).distinct()
    of_files = named.join(files, "FILENAME")
    near = object_pixels(flat, ["FILENAME"], tol_arcsec)
    of_pixels = named.join(near, "FILENAME").select(*UNIT, PIXEL).distinct().join(pixels, PIXEL)
    parts = own.union(of_files.select(*UNIT, F.lit("objects"), "n", "s")).union(of_pixels.select(*UNIT, F.lit("stars"), "n", "s"))
    sums = parts.groupBy(*UNIT, "kind").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    line = F.concat_ws(":", "kind", F.col("n").cast("string"), F.col("s").cast("string"))
    told = sums.groupBy(*UNIT).agg(F.array_join(F.sort_array(F.collect_list(line)), ";").alias("told"))
    return told.select(*UNIT, F.sha2(F.concat("told", F.lit(json.dumps(options, sort_keys=True, default=str))), 256).alias("fingerprint"))


class _Manifest:
    """Numbered tables of (BAND, TILE, fingerprint), of which the last whole one counts."""

    def __init__(self, spark: SparkSession, store: str) -> None:
        self.spark, self.folder = spark, f"{store}/manifest"
        self.fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(store).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self.fs.exists(self.fs_path(self.folder)):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.fs_path(self.folder))]
        return sorted(int(n) for n in names if n.isdigit() and self.fs.exists(self.fs_path(f"{self.folder}/{n}/_SUCCESS")))

    def read(self) -> DataFrame:
        kind = "BAND string, TILE int, fingerprint string"
        numbers = self.numbers()
        return self.spark.read.schema(kind).parquet(f"{self.folder}/{numbers[-1]}") if numbers else self.spark.createDataFrame([], kind)

    def write(self, df: DataFrame) -> None:
        number = (self.numbers() or [0])[-1] + 1
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{number}")

    def drop_units(self, table: str, units: list[tuple]) -> None:
        for band, tile in units:
            path = self.fs_path(f"{table}/BAND_2={band}/TILE_2={tile}")
            if self.fs.exists(path):
                self.fs.delete(path, True)


def _write_units(df: DataFrame, path: str) -> None:
    """Only the folders of the units in df are replaced. The rows of a unit should lie together, which makes about one file in
    each, more where it is large. The schema is kept beside them, as there may be none left to infer it from."""
    df.sparkSession.createDataFrame([(df.schema.json(),)], "json string").coalesce(1).write.mode("overwrite").parquet(f"{path}_schema")
    with compiled_methods(df.sparkSession), shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC).partitionBy(*STORED).parquet(path)


def _read(manifest: _Manifest, path: str) -> DataFrame:
    if not manifest.fs.exists(manifest.fs_path(f"{path}_schema/_SUCCESS")):
        return manifest.spark.createDataFrame([], "FILENAME_2 string, BAND_2 string, TILE_2 int")
    schema = manifest.spark.read.schema("json string").parquet(f"{path}_schema").first().json
    return manifest.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(path)


def calibrate_changed(exposure: DataFrame, archive: DataFrame, image: DataFrame, objects: DataFrame, refcat: DataFrame,
                      tiles: DataFrame, store: str, bands: tuple[str, ...] | None = None, tol_arcsec: float = 2.0, **options) -> Resumed:
    """calibrate(), kept in a folder by band and tile. A unit is run if its fingerprint is not the one it was last run
    with, or if it never was; the others are read back. Units that no image belongs to any more lose their rows. Stars
    are taken from around the objects, so that what a unit gives does not depend on which others are run with it.

    Before any folder is touched, a manifest without the units to be redone is written, and one with them when they
    are done. So a run that is broken off, at whatever place, leaves no unit that passes for what it is not: the
    next run does those again. Two runs must not work in one folder at once."""
    spark, store = exposure.sparkSession, store.rstrip("/")
    cuts = {} if bands is None else {"bands": tuple(bands)}
    images = materialize(select_survey_images(exposure, archive, image, tiles, **cuts), "images")
    now = materialize(fingerprints(images, objects, refcat, {**options, **cuts, "tol_arcsec": tol_arcsec}, tol_arcsec).withColumn("TILE", F.col("TILE").cast("int")), "fingerprints")
    manifest = _Manifest(spark, store)
    old = manifest.read()
    both = now.alias("a").join(old.alias("b"), UNIT, "full").select(*UNIT, F.col("a.fingerprint").alias("now"), F.col("b.fingerprint").alias("old"))
    status = F.when(F.col("now").isNull(), "gone").when(F.col("old").isNull(), "new").when(F.col("now") == F.col("old"), "kept").otherwise("changed")
    units = materialize(both.select(*UNIT, status.alias("status")), "units")
    todo = units_of(units.where("status IN ('new', 'changed')"))
    touched = todo + units_of(units.where("status = 'gone'"))
    matched_path, solved_path = f"{store}/matched", f"{store}/zero_points"
    if touched:
        keep = old.join(units.where("status = 'kept'"), UNIT, "left_semi")
        manifest.write(keep)
        for table in (matched_path, solved_path):
            manifest.drop_units(table, touched)
        if todo:
            # The other images are not even read again: their units' conditions choose image rows, and these the objects.
            run = calibrate(exposure, archive, image, objects, refcat, tiles, images=images.where(in_units(todo)),
                            bands=bands, tol_arcsec=tol_arcsec, prune="objects", number_per=STORED, keep_matched=lambda m: _stored(m, matched_path, todo), **options)
            _write_units(run.zero_points.hint("rebalance", *STORED), solved_path)
        manifest.write(now)
    return Resumed(_read(manifest, solved_path), _read(manifest, matched_path), units)


def _stored(matched: DataFrame, path: str, units: list[tuple]) -> DataFrame:
    _write_units(matched, path)    # numbered by unit: ranges of them
    chosen = in_units(units)
    rows = matched.sparkSession.read.schema(matched.schema).parquet(path)
    return rows.withColumns({"BAND": F.col("BAND_2"), "TILE": F.col("TILE_2")}).where(chosen).drop("BAND", "TILE")
