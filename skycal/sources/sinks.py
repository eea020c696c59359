"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.functions.decimals import with_fixed_text
from skycal.functions.numeric import FRACTIONAL
from skycal.operators.refcat import PIXEL, with_pixel


def fixed_decimals(df: DataFrame, decimals: int) -> DataFrame:
    """Fractional columns as text with a fixed number of decimals, rounded as printf does; NULL stays NULL, NaN becomes it."""
    return with_fixed_text(df, [f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL)], decimals)


def write_csv(df: DataFrame, path: str, decimals: int | None = None, partition_by: list[str] | None = None,
              mode: str = "error", order: list[str] | None = None) -> None:
    """Header CSV; partition_by takes the place of band and tile in file names, order makes the files, by name, one
    ordered list."""
    df = _dealt(df, partition_by) if partition_by else df
    if order:
        df = df.sortWithinPartitions(*partition_by, *order) if partition_by else df.orderBy(*order)
    out = df if decimals is None else fixed_decimals(df, decimals)
    writer = out.write.mode(mode).option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "error") -> None:
    """Parquet. With partition_by, rows of one folder are brought together first: about one file in each, more where
    it is large, instead of one from every task."""
    writer = (_dealt(df, partition_by) if partition_by else df).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _dealt(df: DataFrame, by: list[str]) -> DataFrame:
    return df.hint("rebalance", *by)


def write_refcat(stars: DataFrame, path: str, mode: str = "error") -> None:
    """Store a reference catalogue partitioned by sky pixel and sorted by RA, the layout that prune_reference reads
    selectively. Tasks get ranges of (pixel, RA), so a crowded pixel has as many files as its size asks for, each with
    its own range of RA."""
    ordered = with_pixel(stars).repartitionByRange(PIXEL, "RA")
    ordered.sortWithinPartitions(PIXEL, "RA").write.mode(mode).partitionBy(PIXEL).parquet(path)
