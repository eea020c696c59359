"""Positional cross-match of observed objects and reference stars.

The sky is cut into declination zones and each zone into RA cells (the zones algorithm of Gray,
Nieto-Santisteban and Szalay), so a radius search becomes an equi-join on (zone, cell) with the
exact distance as a residual test. A star is copied only into the cells its match circle touches
(2.25 cells on average at the default size); every position is in exactly one cell.

What is matched is the set of distinct observed positions, not the observations:

* copies of a position collapse in the map-side half of the distinct, however many there are;
* both sides of the zone join are bare positions; the columns of a star, and then the wide observation
  rows, are joined to the finished matches, each by one shuffle;
* no row id is needed, and repeated observations all keep their own output row.

Copies of a star position likewise collapse to the one that comes first in order: all of them are
within reach of the same observations, so no other copy could be picked. A crowded cell (many
different positions in one place) is split by adaptive skew-join handling, which is free to do so
because the step after the join groups by position, not by cell; candidate pairs are reduced to one per
position before they are shuffled. On a catalogue rounded to 6 decimals the positions within reach of
an observation are finite in number, and in real ones they are a few.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skycal.functions.names import suffix_columns
from skycal.functions.sky import ra_wrap, sep_sq

def _zone_cells(zone: Column, height: float) -> tuple[Column, Column]:
    """Number of RA cells of a zone, and the smallest cos(dec) in it."""
    edge = F.greatest(F.abs(zone * height - 90), F.abs((zone + 1) * height - 90))
    cosmin = F.cos(F.radians(F.least(edge, F.lit(90.0))))
    return F.greatest(F.lit(1), F.floor(360 * cosmin / height)), cosmin


def _position_cells(pos: DataFrame, height: float) -> DataFrame:
    n, _ = _zone_cells(F.col("_zone"), height)
    cell = F.floor(F.pmod("_ra", F.lit(360.0)) * F.col("_n") / 360)
    return (
        pos.withColumn("_zone", F.floor((F.col("_dec") + 90) / height))
        .withColumn("_n", n)
        .withColumn("_cell", F.least(cell, F.col("_n") - 1))
        .drop("_n")
    )


def _star_cells(stars: DataFrame, tol: float, height: float) -> DataFrame:
    """One row per cell that the match circle of a star touches. The circle is taken slightly too
    large, so rounding at a cell edge can only add a candidate, which the distance test removes."""
    reach = tol * (1 + 1e-6) + 1e-9
    n, cosmin = _zone_cells(F.col("_zone"), height)
    zone_of = lambda d: F.floor((F.col("_sdec") + 90 + d) / height)
    cell_of = lambda sign: F.floor((F.col("_sra") + sign * reach / F.col("_cos")) * F.col("_n") / 360)
    # A zone of one cell needs no RA arithmetic, and near the pole its 1/cos would overflow.
    cells = F.when(F.col("_n") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.array_distinct(F.transform(F.sequence(cell_of(-1), cell_of(1)), lambda c: F.pmod(c, F.col("_n")))))
    return (
        stars.withColumn("_zone", F.explode(F.sequence(zone_of(-reach), zone_of(reach))))
        .withColumn("_n", n).withColumn("_cos", cosmin)
        .withColumn("_cell", F.explode(cells))
        .drop("_n", "_cos")
    )


def _positioned(df: DataFrame, ra: str, dec: str) -> DataFrame:
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    return df.where(ok(ra) & ok(dec))


def crossmatch(std: DataFrame, obs: DataFrame, tol_arcsec: float = 2.0, pick: str = "first",
               std_pos: tuple[str, str] = ("RA", "DEC"), obs_pos: tuple[str, str] = ("RA", "DEC"),
               tie_break: list[str] | None = None, cell_tols: float = 4.0) -> DataFrame:
    """Match every observation to at most one star closer than tol_arcsec; a star may take many.

    pick="first" takes the first star within reach in (wrapped RA, Dec, tie_break) order,
    pick="nearest" the closest one. tie_break orders stars at one position (default: all columns).
    Columns come out upper-cased with suffix _1 for the star and _2 for the observation."""
    if pick not in ("first", "nearest"):
        raise ValueError("pick must be 'first' or 'nearest'")
    tol = tol_arcsec / 3600.0
    height = cell_tols * tol
    if not 0 < tol < 1 or cell_tols < 1:
        raise ValueError("the tolerance must be under a degree and a cell at least one tolerance wide")

    left = suffix_columns(_positioned(std, *std_pos), "_1")
    sra, sdec = (F.col(c.upper() + "_1") for c in std_pos)
    ties = [c.upper() + "_1" for c in (tie_break or std.columns)]
    stars = (
        left.groupBy(_turn(sra).alias("_sra"), sdec.alias("_sdec"))
        .agg(F.min_by(F.struct(*left.columns), F.struct(*ties)).alias("_star"))
    )

    right = suffix_columns(_positioned(obs, *obs_pos), "_2")
    ora, odec = (F.col(c.upper() + "_2") for c in obs_pos)
    positions = right.select(ora.alias("_ra"), odec.alias("_dec")).distinct()

    distance = sep_sq(F.col("_ra"), F.col("_dec"), F.col("_sra"), F.col("_sdec"))
    order = [ra_wrap(F.col("_sra")).alias("_w"), "_sdec", "_sra"]
    rank = F.struct(*order) if pick == "first" else F.struct(distance.alias("_d2"), *order)
    best = (
        _position_cells(positions, height)
        .join(_star_cells(stars.select("_sra", "_sdec"), tol, height), ["_zone", "_cell"])
        .where(distance < tol * tol)
        .groupBy("_ra", "_dec").agg(F.min(rank).alias("_best"))
        .select("_ra", "_dec", "_best._sra", "_best._sdec")
        .join(stars, ["_sra", "_sdec"])
    )
    return right.join(best, (ora == F.col("_ra")) & (odec == F.col("_dec"))).select("_star.*", *right.columns)


def _turn(ra: Column) -> Column:
    """RA in [0, 360); unchanged where it already is."""
    turned = F.pmod(ra, F.lit(360.0))
    return F.when(turned >= 360, 0.0).otherwise(turned)


def expected_copies(cell_tols: float) -> float:
    """Average number of cells a star is copied into."""
    return math.pow(1 + 2 / cell_tols, 2)
