"""DuckDB SQL building blocks for the side-by-side check: the same questions asked the plain way,
by brute force where the engine under test is clever."""

from __future__ import annotations

from skycal.plans.proxy import ctes

TOL2 = "(2e0/3600e0)*(2e0/3600e0)"


def with_tables(tables: list[str], body: str, extra: list[tuple[str, str]] = ()) -> str:
    parts = [ctes(*tables)] if ctes(*tables) else []
    parts += [f"{n} AS ({t.strip()})" for n, t in extra]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def wrap(ra: str) -> str:
    return f"CASE WHEN {ra} > 180 THEN {ra}-360 ELSE {ra} END"


def sep_sq(ora: str, odec: str, sra: str, sdec: str) -> str:
    d = f"({ora}-{sra})"
    dra = f"(CASE WHEN {d} > 180 THEN {d}-360 WHEN {d} < -180 THEN {d}+360 ELSE {d} END)"
    return (f"({dra}*cos(radians({odec}))*({dra}*cos(radians({odec})))"
            f" + ({odec}-{sdec})*({odec}-{sdec}))")


def pmod(a: str, n: str) -> str:
    return f"(({a}) - floor(({a})/({n}))*({n}))"


def pixel_columns(source: str, nside: int, ra: str, dec: str, out: str, keep: str = "*") -> str:
    """SELECT adding a RING pixel column to a table, step by step in nested derived tables."""
    n, ncap, npix = nside, 2 * nside * (nside - 1), 12 * nside * nside
    ring_mod = pmod("h_ring", "2")
    return f"""SELECT * EXCLUDE (h_z, h_t, h_up, h_down, h_w, h_ring, h_cap), CAST(CASE
        WHEN h_z IS NULL OR h_t IS NULL THEN NULL
        WHEN abs(h_z) <= 2e0/3e0 THEN {ncap} + (h_ring-1)*{4 * n}
          + {pmod(f"floor((h_up+h_down-{n}+(1-{ring_mod})+1)/2e0)", str(4 * n))}
        WHEN h_z > 0 THEN 2*h_cap*(h_cap-1) + {pmod("floor(h_t*h_cap)", "4*h_cap")}
        ELSE {npix} - 2*h_cap*(h_cap+1) + {pmod("floor(h_t*h_cap)", "4*h_cap")} END AS BIGINT) AS {out}
      FROM (SELECT *, {n}+1+h_up-h_down AS h_ring,
          floor((h_t-floor(h_t))*h_w) + floor((1-(h_t-floor(h_t)))*h_w) + 1 AS h_cap
        FROM (SELECT *, floor({n}*(h_t+5e-1)-75e-2*{n}*h_z) AS h_up, floor({n}*(h_t+5e-1)+75e-2*{n}*h_z) AS h_down,
            {n}*sqrt(3*(1-abs(h_z))) AS h_w
          FROM (SELECT {keep}, sin(radians({dec})) AS h_z, {pmod(ra, '360e0')}/90e0 AS h_t FROM {source})))"""


# Every pair within reach: a Dec band join, then the distance. Stars are rounded as they are stored.
STARS6 = """SELECT star_id, round(ra, 6) AS ra, round(dec, 6) AS dec, round(g, 6) AS g, round(r, 6) AS r,
  round(i, 6) AS i, round(z, 6) AS z, round(dg, 6) AS dg, round(dr, 6) AS dr, round(di, 6) AS di, round(dz, 6) AS dz
FROM star"""

PAIRS = f"""SELECT o.obs_id, s.star_id, s.ra AS ra_1, s.dec AS dec_1, {wrap('s.ra')} AS ra_wrap_1,
  {sep_sq('o.ra', 'o.dec', 's.ra', 's.dec')} AS d2
FROM {{obs}} AS o JOIN stars6 AS s ON s.dec BETWEEN o.dec-1e-3 AND o.dec+1e-3
WHERE {sep_sq('o.ra', 'o.dec', 's.ra', 's.dec')} < {TOL2}"""


def match(order: str = "ra_wrap_1, dec_1, star_id", obs: str = "obs", stars: str = STARS6) -> list[tuple[str, str]]:
    """CTEs ending in best(obs_id, star_id, ra_wrap_1): one star per observation."""
    return [
        ("stars6", stars),
        ("pairs", PAIRS.format(obs=obs)),
        ("best", f"""SELECT obs_id, star_id, ra_wrap_1 FROM (SELECT *, row_number() OVER
          (PARTITION BY obs_id ORDER BY {order}) AS rn FROM pairs) AS p WHERE rn = 1"""),
        ("matched", f"""SELECT row_number() OVER (ORDER BY b.ra_wrap_1, s.dec, b.star_id, {wrap('o.ra')}, o.dec, o.obs_id)
            AS matchid, b.star_id, b.ra_wrap_1, s.ra AS ra_1, s.dec AS dec_1, s.g, s.r, s.i, s.z,
          s.dg, s.dr, s.di, s.dz, o.*
          FROM best AS b JOIN stars6 AS s ON b.star_id = s.star_id JOIN {obs} AS o ON b.obs_id = o.obs_id"""),
    ]


# The survey's tiles, each box once.
TILES = """SELECT b.first_idx + t.i AS tile, 360e0 - b.width*t.i - b.width AS ramin, 360e0 - b.width*t.i AS ramax,
    b.decmin, b.decmax
  FROM (VALUES
    (0, -7.315642e0, 2.705224e0, 10), (36, -15.82973e0, -7.315642e0, 12),
    (96, -24.72249e0, -15.82973e0, 12), (126, -32.31536e0, -24.72249e0, 15),
    (150, -40.61207e0, -32.31536e0, 15), (174, -47.57836e0, -40.61207e0, 20),
    (192, -55.63587e0, -47.57836e0, 20), (228, -62.08519e0, -55.63587e0, 30),
    (240, -70.35988e0, -62.08519e0, 30), (252, -90.0e0, -70.35988e0, 30)
  ) AS b(first_idx, decmin, decmax, width)
  JOIN (SELECT CAST(unnest(range(36)) AS BIGINT) AS i) AS t ON t.i < 360/b.width"""


def in_tile(table: str, ra: str = "radeg", dec: str = "decdeg", columns: str = "e.*, t.tile") -> str:
    return f"""SELECT {columns} FROM {table} AS e JOIN tiles AS t
      ON e.{ra} >= t.ramin AND e.{ra} < t.ramax AND e.{dec} >= t.decmin AND e.{dec} < t.decmax"""


USABLE = """radeg IS NOT NULL AND decdeg IS NOT NULL AND abs(glat) > 10 AND exptime > 1
  AND band IN ('g', 'r', 'i', 'z')"""

# Fixed values. band: (base, blue, red, slope, offset, error, lower limit, upper limit)
COLOUR = {
    "g": ("g", "g", "r", "0.0994e0", "-0.0076e0", "dg", "-0.2e0", "1.2e0"),
    "r": ("r", "g", "r", "-0.1335e0", "0.0189e0", "dr", "-0.2e0", "1.2e0"),
    "i": ("i", "i", "z", "-0.3407e0", "0.0026e0", "di", "-0.2e0", "0.3e0"),
    "z": ("z", "i", "z", "-0.2575e0", "-0.0074e0", "dz", "-0.2e0", "0.3e0"),
    "Y": ("z", "i", "z", "-0.6032e0", "0.0185e0", "dz", "-0.2e0", "0.3e0"),
}
MAG_OBS = "CASE WHEN flux > 0 THEN -2.5e0*log10(flux) WHEN flux = 0 THEN CAST('inf' AS DOUBLE) END"


def magnitudes(source: str, band: str) -> str:
    base, blue, red, slope, offset, err, lo, hi = COLOUR[band]
    return f"""SELECT *, mag_std - mag_obs AS mag_diff FROM (
      SELECT *, {base} + ({slope})*({blue}-{red}) + ({offset}) AS mag_std, {err} AS magerr_std, {MAG_OBS} AS mag_obs
      FROM {source} WHERE {blue}-{red} > {lo} AND {blue}-{red} <= {hi}) AS c"""


QUALITY = """SELECT * FROM mags WHERE mag_std >= 0 AND mag_std <= 25 AND flux_psf > 10 AND flags < 2
  AND abs(spread) < 1e-2 AND magerr_std < 1e-1"""


def median(column: str) -> str:
    """Exact median as the mean of the middle rows, also over infinities."""
    return f"quantile_cont({column}, 0.5)"


def clip_ctes(key: str, per: str | None = None, nsigma: str = "3e0", passes: int = 3) -> list[tuple[str, str]]:
    """CTEs quality, med, near, then clip1..clipN; clipN carries the flags of pass N unapplied."""
    out = [("quality", QUALITY)]
    if per is None:
        out += [("med", f"SELECT {median('mag_diff')} AS m FROM quality"),
                ("near", """SELECT * FROM quality WHERE mag_diff > (SELECT m FROM med)-5
                   AND mag_diff < (SELECT m FROM med)+5""")]
    else:
        out += [("med", f"SELECT {per}, {median('mag_diff')} AS m FROM quality GROUP BY {per}"),
                ("near", f"""SELECT q.* FROM quality AS q JOIN med USING ({per})
                   WHERE mag_diff > m-5 AND mag_diff < m+5""")]
    source = "near"
    for k in range(1, passes + 1):
        flag = (f"coalesce(abs(mag_diff - avg(mag_diff) OVER (PARTITION BY {key})) > "
                f"{nsigma}*stddev_samp(mag_diff) OVER (PARTITION BY {key}) "
                f"+ 1e-12*abs(avg(mag_diff) OVER (PARTITION BY {key})), false)")
        rows = source if source == "near" else f"(SELECT * EXCLUDE (outlier) FROM {source} WHERE NOT outlier) AS p"
        out.append((f"clip{k}", f"SELECT *, {flag} AS outlier FROM {rows} WHERE {key} IS NOT NULL"))
        source = f"clip{k}"
    return out


def zp_select(key: str, source: str = "clip3", decimals: int | None = 6) -> str:
    r = lambda e: e if decimals is None else f"round({e}, {decimals})"
    return f"""SELECT {key}, {r("quantile_cont(mag_diff, 0.5)")} AS mag_zero_median,
      {r("avg(mag_diff)")} AS mag_zero_mean, {r("stddev_samp(mag_diff)")} AS mag_zero_std,
      {r("CASE WHEN count(mag_diff) > 1 THEN stddev_samp(mag_diff)/sqrt(count(mag_diff)-1) END")} AS mag_zero_mean_err,
      count(mag_diff) AS mag_zero_num FROM {source} GROUP BY {key}"""


def zp_ctes() -> list[tuple[str, str]]:
    """The zero points of the derived sky per catalogue file, as the quality reports read them."""
    return [*match(), ("mags", magnitudes("matched", "g")), *clip_ctes("filename"),
            ("zp", zp_select("filename", decimals=None)),
            ("zpx", "SELECT *, TRY_CAST(substring(filename, 4, 6) AS BIGINT) AS expnum FROM zp")]
