"""Column-name and file-name helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c.upper() + suffix for c in df.columns])


def first_of_duplicates(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name (case-insensitive, as Spark resolves them)."""
    seen, keep = set(), []
    for i, c in enumerate(df.columns):
        if c.lower() not in seen:
            seen.add(c.lower())
            keep.append((f"_{i}", c))
    positional = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return positional.select(*[F.col(p).alias(c) for p, c in keep])


def merge_keep_left(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join that takes a column present on both sides from the left."""
    have = {c.lower() for c in left.columns} - {c.lower() for c in on}
    return left.join(right.drop(*[c for c in right.columns if c.lower() in have]), on=on, how="inner")


def without_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(" "))


def file_path(path: Column, name: Column, compression: Column) -> Column:
    """Full path; NULL as soon as one part is NULL, as SQL concatenation has it."""
    return F.concat(path, F.lit("/"), name, compression)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def strip_extension(name: Column) -> Column:
    """Drop the last dot suffix; a leading dot is no extension."""
    return F.regexp_replace(name, r"^(.*?[^./][^/]*)\.[^./]*$", "$1")


def band_from_path(path: Column) -> Column:
    """Character 22 from the end, where uncompressed catalogue names carry the band."""
    return F.when(F.length(path) >= 22, F.substring(path, -22, 1))


def expnum_from_name(name: Column) -> Column:
    """Exposure number in characters 3 to 8, counted from 0; NULL where they are no number."""
    return F.substring(name, 4, 6).try_cast("int")
