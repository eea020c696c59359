"""The survey's tile table and the assignment of positions to tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skycal.functions.sky import linspace, ra_limit

# Dec bands of the survey's ~100 square degree tiles. Each row is
# (first tile index, dec min, dec max, RA width in degrees).
DEC_BANDS = [
    (0, -7.315642, 2.705224, 10),
    (36, -15.82973, -7.315642, 12),
    (96, -24.72249, -15.82973, 12),
    (126, -32.31536, -24.72249, 15),
    (150, -40.61207, -32.31536, 15),
    (174, -47.57836, -40.61207, 20),
    (192, -55.63587, -47.57836, 20),
    (228, -62.08519, -55.63587, 30),
    (240, -70.35988, -62.08519, 30),
    (252, -90.0, -70.35988, 30),
]


def survey_tiles(spark: SparkSession) -> DataFrame:
    """(index, ramin, ramax, decmin, decmax) of the survey's boxes, each once, from its Dec bands. Any other table is an
    input: sources.tables.read_tiles."""
    bands = spark.createDataFrame(DEC_BANDS, "first int, decmin double, decmax double, width int")
    strips = (360 / F.col("width")).cast("int")
    return (
        bands
        .withColumn("i", F.explode(F.sequence(F.lit(0), strips - 1)))
        .withColumn("ramax", 360.0 - F.col("width") * F.col("i"))
        .select((F.col("first") + F.col("i")).cast("int").alias("index"),
                (F.col("ramax") - F.col("width")).alias("ramin"), "ramax", "decmin", "decmax")
    )


def distinct_tiles(tiles: DataFrame) -> DataFrame:
    """Each box once, under its smallest index."""
    box = ["ramin", "ramax", "decmin", "decmax"]
    return tiles.groupBy(*box).agg(F.min("index").alias("index")).select("index", *box)


def make_tiles(bands: DataFrame, area: float = 100.0) -> DataFrame:
    """Tiles of nearly equal area for any frame of (decmin, decmax) bands: the RA width that gives
    the wanted area, stretched to divide the circle evenly. Numbered within the band. A band without height raises."""
    width = ra_limit(F.lit(0.0), F.col("decmin"), F.col("decmax"), F.lit(float(area)))
    strips = F.when(F.col("decmin") < F.col("decmax"), F.greatest(F.lit(1), F.round(360 / width)).cast("int")).otherwise(
        F.raise_error(F.lit("a band of tiles needs decmin < decmax")).cast("int"))
    return (
        bands.select("decmin", "decmax", strips.alias("strips"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("strip"))
        .select("strip", (F.col("strip") * 360.0 / F.col("strips")).alias("ramin"),
                ((F.col("strip") + 1) * 360.0 / F.col("strips")).alias("ramax"), "decmin", "decmax")
    )


def sky_grid(spark: SparkSession, ra: tuple[float, float], dec: tuple[float, float], num: int) -> DataFrame:
    """All num x num grid points over a box, end points included, from one range (no cross join)."""
    return spark.range(num * num).select(linspace(F.floor(F.col("id") / num), *ra, num).alias("ra"),
                                         linspace(F.pmod("id", F.lit(num)), *dec, num).alias("dec"))


def footprint_grid(df: DataFrame, ra: tuple[str, str], dec: tuple[str, str], num: int) -> DataFrame:
    """Each row repeated for num x num grid points (ra, dec) between its own corner columns. RA goes the short
    way round the circle, so a footprint over RA 0 stays where it is; it comes out in [0, 360)."""
    step = lambda i: i / F.lit(float(num - 1))
    arc = F.pmod(F.col(ra[1]) - F.col(ra[0]) + 180, F.lit(360.0)) - 180
    return (
        df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(num * num - 1))))
        .withColumn("ra", F.pmod(F.col(ra[0]) + arc * step(F.floor(F.col("_k") / num)), F.lit(360.0)))
        .withColumn("dec", F.col(dec[0]) + (F.col(dec[1]) - F.col(dec[0])) * step(F.pmod("_k", F.lit(num))))
        .drop("_k")
    )


def in_box(ra: Column, dec: Column, box: tuple[float, float, float, float], bounds: str = "half_open") -> Column:
    """Box predicate on (ramin, ramax, decmin, decmax), half open or open at both ends."""
    ramin, ramax, decmin, decmax = (F.lit(float(v)) for v in box)
    if bounds == "open":
        return (ra > ramin) & (ra < ramax) & (dec > decmin) & (dec < decmax)
    if bounds != "half_open":
        raise ValueError("bounds must be 'half_open' or 'open'")
    return (ra >= ramin) & (ra < ramax) & (dec >= decmin) & (dec < decmax)


def assign_tiles(df: DataFrame, tiles: DataFrame, ra: str = "radeg", dec: str = "decdeg") -> DataFrame:
    """Add tile (the tile's index) to rows whose position lies in a tile's half-open box; others drop.

    Tiles are spread over one-degree sky cells, so this is an equi-join on the cell with the box as a residual
    test. How many tiles there are is up to the table, so their side is broadcast only if Spark finds it small."""
    cells = (
        tiles.select(F.col("index").alias("tile"), "ramin", "ramax", "decmin", "decmax")
        .withColumn("ra_cell", F.explode(F.sequence(F.floor("ramin"), F.ceil("ramax") - 1)))
        .withColumn("dec_cell", F.explode(F.sequence(F.floor("decmin"), F.ceil("decmax") - 1)))
    )
    inside = ((F.col(ra) >= F.col("ramin")) & (F.col(ra) < F.col("ramax"))
              & (F.col(dec) >= F.col("decmin")) & (F.col(dec) < F.col("decmax")))
    return (
        df.withColumn("ra_cell", F.floor(ra)).withColumn("dec_cell", F.floor(dec))
        .join(cells, ["ra_cell", "dec_cell"])
        .where(inside)
        .select(*df.columns, "tile")
    )
