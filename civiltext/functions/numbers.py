"""Number helpers that keep scores equal to the last printed digit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_exact(x: Column, digits: int) -> Column:
    """Round a non-negative double to ``digits`` places by its exact binary value.

    Spark's ``round`` and ``bround`` look at the shortest decimal text of a double, so
    0.1455 (really 0.14549999...) rounds up. Here the distance to the midpoint is taken
    without rounding error: the double is split in two halves whose products are exact.
    Exact ties go to the even neighbour. ``x`` is used several times; pass a plain column.
    """
    scale, five = float(10 ** digits), float(5 ** digits)
    below = F.floor(x * scale).cast("double")
    spread = x * F.lit(134217729.0)
    high = spread - (spread - x)
    low = x - high
    midpoint = (below * 2 + 1) / F.lit(float(2 ** (digits + 1)))
    side = (high * five - midpoint) + low * five
    nearest = (F.when(side > 0, below + 1)
               .when(side < 0, below)
               .otherwise(below + F.pmod(below, F.lit(2.0))))
    return nearest / F.lit(scale)


def repeated_sum(step: float, times: Column) -> Column:
    """``step`` added up ``times`` times, one after the other."""
    return F.aggregate(F.array_repeat(F.lit(step), times.cast("int")), F.lit(0.0),
                       lambda acc, s: acc + s)


def percent_text(share: Column) -> Column:
    """A share as whole percent, such as ``67%`` (ties to even)."""
    return F.concat(F.rint(share * 100).cast("int").cast("string"), F.lit("%"))
