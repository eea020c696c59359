"""Readers. All of them are lazy scans with declared schemas, so filters and column choice reach the files."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skycal.functions.names import base_name
from skycal.functions.numeric import nan_to_null
from skycal.operators.tiles import distinct_tiles
from skycal.schemas import TILES


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Parquet, ORC, JSON or header CSV. Text formats need a schema unless inference is wanted."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        reader = reader.option("nanValue", "NaN") if schema is not None else reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.load(path))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int,
              **options: str) -> DataFrame:
    """Archive table over JDBC, read in parallel ranges of an integer key; filters are pushed to it."""
    return (spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
        numPartitions=str(partitions), **options).load())


def read_tiles(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A tile table with the columns of schemas.TILES, each box once."""
    return distinct_tiles(read_table(spark, path, TILES, fmt))


def read_catalogs(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """All per-image object catalogues under a path in one scan, FILENAME taken from the file. The schema is declared, so
    no footer is read to find it; columns a file lacks are NULL. A path that is not there raises, as does a file that
    goes missing while it is read."""
    df = spark.read.format(fmt).schema(schema).load(path)
    df = df.drop("FILENAME").withColumn("FILENAME", base_name(F.col("_metadata.file_path")))
    return nan_to_null(df)


class Listed(NamedTuple):
    rows: DataFrame          # of the listed files that are there
    missing: DataFrame       # FILENAME of those that are not


def read_listed_catalogs(spark: SparkSession, path: str | list[str], listed: DataFrame, schema: T.StructType,
                         fmt: str = "parquet") -> Listed:
    """Catalogues that a frame lists (column FILENAME), out of a folder, and a report of those that are not in it.
    The folder is listed without opening a file; the list takes part as a join, so it may be of any length."""
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        base_name(F.col("path")).alias("FILENAME")).distinct()
    wanted = listed.select("FILENAME").where(F.col("FILENAME").isNotNull()).distinct()
    rows = read_catalogs(spark, path, schema, fmt).join(wanted, "FILENAME", "left_semi")
    return Listed(rows, wanted.join(there, "FILENAME", "left_anti"))
