"""Decimals of doubles as C's printf gives them: the exact binary value, rounded half to even. Spark's own round and
format_string round the shortest decimal text of a double half up, which differs wherever that text ends in a 5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 15                      # decimals: a fraction times its power of ten has fewer than 52 bits
_SPLIT = float((1 << 27) + 1)  # cuts a double into two halves whose products are exact


def _names(df: DataFrame, number: int) -> list[str]:
    """Column names that the frame does not have."""
    have, k = {c.lower() for c in df.columns}, 0
    while any(c.startswith(f"_d{k}_") for c in have):
        k += 1
    return [f"_d{k}_{n}" for n in range(number)]


def _with_parts(df: DataFrame, columns: list[str], decimals: int) -> tuple[DataFrame, list[tuple[Column, Column]]]:
    """df, and for each column the whole part and the rounded fraction, in units of the last decimal, of its size below 2^63.

    The fraction times the power of ten is rounded to a double p, whose error e the products of halves give exactly. p is
    rounded half to even; where p is a half and e is not zero, e tells on which side of the half the value lies. Each step is
    a projection of its own, so that none is computed twice or makes the code too long to compile."""
    power = 10.0 ** decimals
    head = power * _SPLIT - (power * _SPLIT - power)
    tail = power - head
    names = _names(df, 9 * len(columns))
    cells = [[F.col(n) for n in names[9 * k:9 * k + 9]] for k in range(len(columns))]
    steps: list[dict[str, Column]] = [{} for _ in range(8)]
    for k, column in enumerate(columns):
        size, whole, rest, p, high, near, low, error, _ = cells[k]
        x = F.abs(F.col(f"`{column}`").cast("double"))
        made = [
            {0: F.when(x < 2.0 ** 63, x)}, {1: F.floor(size)}, {2: size - whole.cast("double")}, {3: rest * power, 4: rest * _SPLIT},
            {4: high - (high - rest), 5: F.rint(p)}, {6: rest - high}, {7: ((high * head - p) + high * tail + low * head) + low * tail},
            {8: F.when((p - near == 0.5) & (error > 0), near + 1).when((p - near == -0.5) & (error < 0), near - 1).otherwise(near)}]
        for step, own in zip(steps, made):
            step.update({names[9 * k + n]: value for n, value in own.items()})
    for step in steps:
        df = df.withColumns(step)
    full = lambda units: units >= power
    if decimals == 0:
        return df, [(F.rint(c[0]).cast("bigint"), F.lit(0).cast("bigint")) for c in cells]
    return df, [(F.when(full(c[8]), c[1] + 1).otherwise(c[1]), F.when(full(c[8]), 0).otherwise(c[8]).cast("bigint")) for c in cells]


def with_fixed_text(df: DataFrame, columns: list[str], decimals: int) -> DataFrame:
    """The columns as printf's %.<decimals>f, the others as they are. NULL and NaN give NULL, infinities inf and -inf, and
    what rounds to zero from below -0. Numbers of 2^63 and more, which have no fraction, get the digits of their
    shortest text."""
    if not 0 <= decimals <= MOST:
        raise ValueError(f"decimals: {decimals} is not between 0 and {MOST}")
    if not columns:
        return df
    parted, parts = _with_parts(df, columns, decimals)
    texts = {}
    for column, (whole, units) in zip(columns, parts):
        x = F.col(f"`{column}`").cast("double")
        sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
        digits = whole.cast("string") if decimals == 0 else F.concat(whole.cast("string"), F.lit("."), F.lpad(units.cast("string"), decimals, "0"))
        texts[column] = F.when(F.isnan(x), F.lit(None)).when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf"))).when(
            F.abs(x) >= 2.0 ** 63, F.format_string(f"%.{decimals}f", x)).otherwise(F.concat(sign, digits)).alias(column)
    return parted.select(*[texts.get(c, F.col(f"`{c}`")) for c in df.columns])


def with_rounded(df: DataFrame, columns: list[str], decimals: int) -> DataFrame:
    """The columns as the doubles that are read back from with_fixed_text: what a table holds after it was written with so
    many decimals. NaN stays NaN."""
    kept = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})
    nan = _names(kept, len(columns))
    kept = kept.withColumns({n: F.isnan(F.col(f"`{c}`")) for n, c in zip(nan, columns)})
    flags = dict(zip(columns, nan))
    infinite = lambda c: F.regexp_replace(F.col(f"`{c}`"), "inf", "Infinity").cast("double")
    return with_fixed_text(kept, columns, decimals).select(*[
        F.when(F.col(flags[c]), F.lit(float("nan"))).otherwise(infinite(c)).alias(c) if c in flags else F.col(f"`{c}`") for c in df.columns])
