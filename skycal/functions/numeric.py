"""Missing values, schema checks and rounding over whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skycal.functions.decimals import with_rounded

FRACTIONAL = (T.DoubleType, T.FloatType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in fractional columns and in arrays of them. Spark sorts NaN above every
    number and lets it through averages, so it must not survive ingest."""
    def clean(f: T.StructField):
        if isinstance(f.dataType, FRACTIONAL):
            return F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, FRACTIONAL):
            return F.transform(f.name, lambda x: F.when(~F.isnan(x), x)).alias(f.name)
        return F.col(f.name)

    return df.select(*[clean(f) for f in df.schema.fields])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Fail at plan time with every missing column named."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))


def round_fractions(df: DataFrame, decimals: int, skip: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """Fractional columns rounded to decimals: half up as Spark rounds, or, with exact, to what printf writes and a
    reader gets back."""
    chosen = [f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL) and f.name not in skip]
    if exact:
        return with_rounded(df, chosen, decimals)
    return df.select(*[F.round(c, decimals).alias(c) if c in chosen else F.col(c) for c in df.columns])
