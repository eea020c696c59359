"""Sky geometry in built-in expressions: no UDF, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ra_wrap(ra: Column) -> Column:
    """Right ascension moved to (-180, 180]."""
    return F.when(ra > 180, ra - 360).otherwise(ra)


def delta_ra(a: Column, b: Column) -> Column:
    """a - b on the circle, in [-180, 180], for inputs in either RA convention."""
    d = a - b
    return F.when(d > 180, d - 360).when(d < -180, d + 360).otherwise(d)


def sep_sq(ra_obs: Column, dec_obs: Column, ra_std: Column, dec_std: Column) -> Column:
    """Squared flat-sky separation in square degrees, scaled at the observed declination."""
    dx = delta_ra(ra_obs, ra_std) * F.cos(F.radians(dec_obs))
    dy = dec_obs - dec_std
    return dx * dx + dy * dy


def box_area(ra1: Column, ra2: Column, dec1: Column, dec2: Column) -> Column:
    """Area in square degrees of an RA/Dec box; the sign follows dec1 - dec2."""
    return F.degrees(F.lit(1.0)) * F.abs(ra1 - ra2) * (F.sin(F.radians(dec1)) - F.sin(F.radians(dec2)))


def ra_limit(ra1: Column, dec1: Column, dec2: Column, area: Column) -> Column:
    """RA at which a box that starts at ra1 between two declinations reaches the given area;
    NULL if the box has no height."""
    return F.try_divide(F.radians(area), F.abs(F.sin(F.radians(dec1)) - F.sin(F.radians(dec2)))) + ra1


def linspace(i: Column, start: float, stop: float, num: int) -> Column:
    """The i-th of num evenly spaced points, both ends included."""
    return F.lit(float(start)) + F.lit(float(stop - start)) * i / F.lit(float(num - 1))


def add_healpix(df: DataFrame, nside: int, ra: str, dec: str, name: str) -> DataFrame:
    """Add the HEALPix pixel number in the RING scheme (Gorski et al. 2005); NULL without a position.

    Built as a chain of small projections: each intermediate is computed once per row, where one nested
    expression would repeat it in every branch and grow too large for the JIT."""
    n, ncap, npix = nside, 2 * nside * (nside - 1), 12 * nside * nside
    z, t, up, down, ring, cap_ring = (F.col(f"_h{i}") for i in range(6))
    step = df.withColumns({
        "_h0": F.sin(F.radians(dec)),
        "_h1": F.pmod(F.col(ra), F.lit(360.0)) / 90,
    })
    width = n * F.sqrt(3 * (1 - F.abs(z)))
    frac = t - F.floor(t)
    step = step.withColumns({
        "_h2": F.floor(n * (t + 0.5) - 0.75 * n * z),
        "_h3": F.floor(n * (t + 0.5) + 0.75 * n * z),
        "_h5": F.floor(frac * width) + F.floor((1 - frac) * width) + 1,
    }).withColumn("_h4", n + 1 + up - down)

    shift = 1 - F.pmod(ring, F.lit(2))
    belt = ncap + (ring - 1) * (4 * n) + F.pmod(F.floor((up + down - n + shift + 1) / 2), F.lit(4 * n))
    in_cap = F.pmod(F.floor(t * cap_ring), 4 * cap_ring)
    north = 2 * cap_ring * (cap_ring - 1) + in_cap
    south = npix - 2 * cap_ring * (cap_ring + 1) + in_cap
    pixel = F.when(z.isNull() | t.isNull(), None).when(F.abs(z) <= 2.0 / 3.0, belt).when(z > 0, north).otherwise(south)
    return step.withColumn(name, pixel.cast("bigint")).drop(*[f"_h{i}" for i in range(6)])


def _spread(x: Column) -> Column:
    """The bits of a number below 2^29 with a zero between each and the next."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def add_healpix_nested(df: DataFrame, nside: int, ra: str, dec: str, name: str) -> DataFrame:
    """Add the HEALPix pixel number in the NESTED scheme (Gorski et al. 2005); NULL without a position. nside is a power
    of two up to 2^29.

    A pixel is a place (x, y) on one of twelve faces, and its number the face followed by the bits of y and x in turn.
    So the pixels of a coarser grid are whole ranges of numbers, see nested_parent and nested_range."""
    if nside < 1 or nside & (nside - 1) or nside > 1 << 29:
        raise ValueError(f"nside: {nside} is no power of two up to 2^29")
    z, t, up, down, quarter, face, x, y = (F.col(f"_h{i}") for i in range(8))
    step = df.withColumns({"_h0": F.sin(F.radians(dec)), "_h1": F.pmod(F.col(ra), F.lit(360.0)) / 90})
    belt = F.abs(z) <= 2.0 / 3.0
    part = t - F.floor(t)
    width = nside * F.sqrt(3 * (1 - F.abs(z)))
    most = F.lit(nside - 1).cast("bigint")
    # Lines that rise and that fall through the place: whole numbers of them from the start of the belt, or from the pole.
    step = step.withColumns({
        "_h2": F.when(belt, F.floor(nside * (0.5 + t) - nside * z * 0.75)).otherwise(F.least(F.floor(part * width), most)),
        "_h3": F.when(belt, F.floor(nside * (0.5 + t) + nside * z * 0.75)).otherwise(F.least(F.floor((1 - part) * width), most)),
        "_h4": F.least(F.floor(t), F.lit(3).cast("bigint")),
    })
    rising, falling = F.floor(up / F.lit(nside)), F.floor(down / F.lit(nside))
    step = step.withColumns({
        "_h5": F.when(~belt, F.when(z > 0, quarter).otherwise(quarter + 8)).when(rising == falling, F.pmod(rising, F.lit(4)) + 4).when(
            rising < falling, F.pmod(rising, F.lit(4))).otherwise(F.pmod(falling, F.lit(4)) + 8),
        "_h6": F.when(belt, F.pmod(down, F.lit(nside))).when(z > 0, most - down).otherwise(up),
        "_h7": F.when(belt, most - F.pmod(up, F.lit(nside))).when(z > 0, most - up).otherwise(down),
    })
    pixel = face * F.lit(nside * nside) + _spread(x.cast("bigint")) + F.shiftleft(_spread(y.cast("bigint")), 1)
    return step.withColumn(name, F.when(z.isNotNull() & t.isNotNull(), pixel.cast("bigint"))).drop(*[f"_h{i}" for i in range(8)])


def nested_parent(pixel: Column, nside: int, coarser: int) -> Column:
    """The pixel of a coarser grid that a NESTED pixel lies in."""
    return F.shiftright(pixel, 2 * (nside.bit_length() - coarser.bit_length()))


def nested_range(pixel: Column, nside: int, finer: int) -> tuple[Column, Column]:
    """First and last pixel of a finer grid that a NESTED pixel is made of: a condition on a sorted column that skips
    files and row groups by their statistics."""
    bits = 2 * (finer.bit_length() - nside.bit_length())
    return F.shiftleft(pixel, bits), F.shiftleft(pixel + 1, bits) - 1


def add_healpix_center(df: DataFrame, nside: int, pix: str, ra: str, dec: str) -> DataFrame:
    """Add the position in degrees of the centre of a RING pixel."""
    n, ncap, npix = nside, 2 * nside * (nside - 1), 12 * nside * nside
    p, i, j, cap, north = (F.col(f"_h{k}") for k in range(5))
    # In a polar cap, r counts pixels from the pole; the square root gives the ring. Arguments stay far
    # below 2**53, where the floor of a double root is exact.
    r = F.when(north, p + 1).otherwise(npix - p)
    ring = F.floor((1 + F.floor(F.sqrt((2 * r - 1).cast("double")))) / 2)
    q = p - ncap
    step = (
        df.withColumn("_h0", F.col(pix).cast("bigint"))
        .withColumn("_h4", p < ncap).withColumn("_h3", north | (p >= npix - ncap))
        .withColumn("_h1", F.when(cap, ring).otherwise(F.floor(q / F.lit(4 * n)) + n))
        .withColumn("_h2", F.when(north, p + 1 - 2 * i * (i - 1))
                    .when(cap, 4 * i + 1 - (npix - p - 2 * i * (i - 1)))
                    .otherwise(F.pmod(q, F.lit(4 * n)) + 1))
    )
    z_cap = 1 - i * i / F.lit(3.0 * n * n)
    z = F.when(north, z_cap).when(cap, -z_cap).otherwise((2 * n - i) * 2 / F.lit(3.0 * n))
    in_cap = (j - 0.5) * 90 / F.greatest(i, F.lit(1))
    in_belt = (j - 0.5 * (1 + F.pmod(i + n, F.lit(2)))) * 90 / F.lit(float(n))
    return step.withColumns({ra: F.when(cap, in_cap).otherwise(in_belt), dec: F.degrees(F.asin(z))}).drop(
        *[f"_h{k}" for k in range(5)])
