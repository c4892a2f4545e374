"""Ratios and means whose rounding does not depend on binary fractions.

Sums are kept as decimals or integers, so they do not depend on the order in
which partitions are merged, and a result is rounded half away from zero by
integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def whole_div(numerator: Column, denominator: Column) -> Column:
    """Integer division; null when the denominator is zero."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0).cast(_WIDE)))


def floor_div(numerator: Column, denominator: Column) -> Column:
    """The largest whole number that is not above the quotient, for a positive denominator; null when it is zero.

    A whole number exceeds a mean exactly when it exceeds the mean's floor, so one number stands for sum and count.
    """
    num, den = numerator.cast(_WIDE), F.nullif(denominator.cast(_WIDE), F.lit(0).cast(_WIDE))
    return ((num - F.pmod(num, den)) / den).cast(_WIDE)


def half_up(numerator: Column, denominator: Column, places: int) -> Column:
    """``numerator / denominator`` of two whole numbers, rounded half away from zero, as double."""
    num, den = numerator.cast(_WIDE), denominator.cast(_WIDE)
    twice = F.abs(num) * F.lit(2 * 10**places) + den
    return F.signum(num.cast("double")) * whole_div(twice, den * 2) / F.lit(10.0**places)


def half_up_percent(part: Column, total: Column, places: int) -> Column:
    return half_up(part.cast(_WIDE) * 100, total, places)


def half_up_mean(total: Column, count: Column, scale: int, places: int) -> Column:
    """Mean of decimals that have ``scale`` digits, from their sum and count."""
    units = F.lit(10**scale)
    return half_up((total * units).cast(_WIDE), count.cast(_WIDE) * units, places)


def scaled_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` in units of 10^-12, with six more digits; null when divided by zero.

    For comparing and ranking ratios as decimals: equal ratios are equal, and
    sums do not depend on their order.
    """
    return numerator.cast(_WIDE) * F.lit(10**12).cast(_WIDE) / F.nullif(denominator.cast(_WIDE), F.lit(0).cast(_WIDE))
