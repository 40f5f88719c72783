"""Number and name expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """First and last name with a blank between; null if either is null."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def rounded_ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` rounded half up, null for a zero denominator.

    Both are whole numbers. The quotient is rounded in whole numbers, away from
    zero where it lies in the middle, so no digits are cut off first. A quotient
    that is too large for a double to tell its last place is divided as double.
    """
    top = F.abs(numerator.cast("decimal(28,0)"))
    bottom = F.abs(F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")))
    unit = F.lit(Decimal(2 * 10**scale))
    units = F.call_function("div", top * unit + bottom, bottom * F.lit(Decimal(2)))
    negative = (numerator < 0) != (denominator < 0)
    signed = F.when(negative, -units).otherwise(units).cast("decimal(19,0)")
    exact = (signed * F.lit(Decimal(1).scaleb(-scale))).cast("double")
    plain = numerator.cast("double") / bottom.cast("double")
    large = F.abs(plain) * 10**scale >= 1e18
    return F.when(large, F.when(denominator < 0, -plain).otherwise(plain)).otherwise(exact)


def row_count() -> Column:
    """Number of rows of the group."""
    return F.count(F.lit(1))
