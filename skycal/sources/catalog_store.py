"""Object catalogues stored for the joins and scans that come after: by unit of calibration, or in buckets of images."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skycal.functions.names import base_name
from skycal.functions.numeric import nan_to_null
from skycal.operators.catalog import attach_metadata
from skycal.operators.materialize import CODEC, compiled_methods, delete, shuffles_dropped

UNIT = ["BAND", "TILE"]
BUCKET_CELLS = 8_000_000    # rows times columns of a bucket: about 64 MB of numbers
MAX_BUCKETS = 100_000   # of a table, by Spark's own default
ROUND_BUCKETS, MAX_ROUNDS = 16, 8    # buckets that are dealt at once, at least; each round reads the rows once more
MAX_UNITS = 20_000      # folders of a store: five bands of the survey's tiles are about a thousand


def write_unit_catalogs(objects: DataFrame, images: DataFrame, path: str, mode: str = "error") -> None:
    """Flattened objects with the metadata of their images, in one folder for each band and tile. Tasks get ranges of
    (band, tile, file name, RA), so a crowded unit has as many files as its size asks for, and each file a short
    range of names, which the statistics in it tell."""
    rows = attach_metadata(objects, images)
    order = [*UNIT, "FILENAME", "RA"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(*UNIT).parquet(path)


def units_of(images: DataFrame) -> list[tuple]:
    """The different (band, tile) of a table of images, in order. Fewer than MAX_UNITS, or it is no such table."""
    rows = images.select(*UNIT).distinct().orderBy(*UNIT).limit(MAX_UNITS + 1).collect()
    if len(rows) > MAX_UNITS:
        raise ValueError(f"more than {MAX_UNITS} units of {UNIT}")
    return [tuple(r) for r in rows]


def in_units(units: list[tuple]) -> Column:
    """A condition on BAND and TILE alone, so that it chooses folders before any file is opened."""
    bands: dict[object, list] = {}
    for band, tile in units:
        bands.setdefault(band, []).append(tile)

    def one(band, tiles) -> Column:
        told = F.col("TILE").isin([t for t in tiles if t is not None])
        return F.col("BAND").eqNullSafe(F.lit(band)) & (told | F.col("TILE").isNull() if None in tiles else told)

    return reduce(lambda a, b: a | b, (one(b, t) for b, t in bands.items()), F.lit(False))


def read_unit_catalogs(spark: SparkSession, path: str, listed: DataFrame) -> DataFrame:
    """Objects of the listed images (BAND, TILE, and FILENAME or FILEPATH) out of write_unit_catalogs' folders.

    Only the listed units' folders are opened. In them, the least and the greatest listed name skip files and row
    groups by their statistics; the list itself, however long, is a semi join. An empty list opens nothing."""
    name = F.col("FILENAME") if "FILENAME" in listed.columns else base_name(F.col("FILEPATH"))
    wanted = listed.select(*UNIT, name.alias("FILENAME")).where(F.col("FILENAME").isNotNull()).distinct()
    ends = wanted.agg(F.min("FILENAME").alias("low"), F.max("FILENAME").alias("high")).first()
    rows = spark.read.parquet(path).where(in_units(units_of(wanted)))
    if ends.low is not None:
        rows = rows.where(F.col("FILENAME").between(ends.low, ends.high))
    return rows.join(wanted.select("FILENAME").distinct(), "FILENAME", "left_semi")


def read_named_files(spark: SparkSession, path: str | list[str], listed: DataFrame, schema, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """(rows of the listed files, FILENAME of listed files that are not there), of a folder of one file per image. The
    folder is listed, the list decides which files the scan is given, and no other is opened. As for any scan of
    Spark, the paths to read are held by the driver; rows and the list are not."""
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        "path", base_name(F.col("path")).alias("FILENAME"))
    wanted = listed.select("FILENAME").where(F.col("FILENAME").isNotNull()).distinct()
    paths = [r.path for r in there.join(wanted, "FILENAME", "left_semi").select("path").distinct().toLocalIterator()]
    missing = wanted.join(there.select("FILENAME"), "FILENAME", "left_anti")
    if not paths:
        return spark.createDataFrame([], schema), missing
    rows = spark.read.format(fmt).schema(schema).load(sorted(paths)).drop("FILENAME")
    rows = rows.withColumn("FILENAME", base_name(F.col("_metadata.file_path")))
    return nan_to_null(rows.select(*[f.name for f in schema.fields], *([] if "FILENAME" in schema.names else ["FILENAME"]))), missing


def buckets_for(df: DataFrame, least: int = 1, cells: int = BUCKET_CELLS) -> int:
    """Number of buckets that have about so many cells (rows times columns) each: it grows with the table, and the task that
    writes or reads a bucket does not. A power of two times least, so that tables of other sizes divide it. Rows of one key
    stay in one bucket, however many they are."""
    need, buckets = -(-df.count() * len(df.columns) // cells), max(1, least)
    while buckets < need and 2 * buckets <= MAX_BUCKETS:
        buckets *= 2
    return buckets


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, keys: tuple[str, ...] = ("FILENAME",),
                   order: tuple[str, ...] = ("FILENAME", "RA"), mode: str = "error") -> None:
    """A table in buckets of its keys, each sorted, one file per bucket: joins and groups by the keys then move no row of it
    again. buckets_for tells a number that suits the size; it is part of the table, and both sides of a join should
    have the same, or one a multiple of the other.

    A new table of many buckets is dealt in rounds, some of its buckets in each, and the shuffle files of a round go when it ends: beside
    the table there is never more than a part of its rows on the disks. It is whole when the call returns; if a round fails, what the others
    wrote is taken back. The rows must be the same each time they are read."""
    spark = df.sparkSession
    rounds = min(MAX_ROUNDS, max(1, buckets // ROUND_BUCKETS)) if mode in ("error", "errorifexists", "overwrite") else 1
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    for k in range(rounds):
        some = df.where(bucket % rounds == k) if rounds > 1 else df
        writer = some.repartition(buckets, *keys).write.mode("append" if k else mode).option("path", path).option("compression", CODEC)
        try:
            with compiled_methods(spark), shuffles_dropped(spark):
                writer.bucketBy(buckets, *keys).sortBy(*order).format("parquet").saveAsTable(table)
        except BaseException:
            if k:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
                delete(spark, path)
            raise


def attach_bucketed(spark: SparkSession, objects_table: str, images: DataFrame, band: str | None = None) -> DataFrame:
    """attach_metadata over objects of write_bucketed. The images are dealt to the objects' buckets, or sent to all of
    them where they are few; the objects stay where they are."""
    return attach_metadata(spark.table(objects_table), images, band)


def files_read(df: DataFrame) -> int:
    """Number of files that the scans of an executed DataFrame opened, by Spark's own metrics."""
    plan = df._jdf.queryExecution().executedPlan()

    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(node.plan())
        metrics = node.metrics()
        own = [metrics.apply("numFiles").value()] if name == "FileSourceScanExec" and metrics.contains("numFiles") else []
        inner = [node.child()] if name in ("InputAdapter", "WholeStageCodegenExec") else [node.children().apply(k) for k in range(node.children().size())]
        return own + [n for c in inner for n in scans(c)]

    return sum(scans(plan))
